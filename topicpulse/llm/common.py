"""Small helpers the operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from topicpulse.operators.lineage import cut  # noqa: F401

# Words are maximal runs of other characters than these six (Java regular expression).
WORD_SPLIT = r"[\x20\x09-\x0D]+"

# Texts are handed to a task function in portions of about so many bytes.
PORTION_BYTES = 4 << 20

# Texts that are handed to a worker at a time: it holds them beside what it makes of a portion,
# and the executor holds them twice while it fills their buffer.
SENT = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}

# A space before a character that is no white space.  The word patterns of the byte-level
# vocabularies start a word there whatever stands before or after, so a text may be cut there.
STABLE_CUT = re.compile(r" (?=\S)")


# Rows of a table that is broadcast, at most; larger ones are joined by a shuffle.
BROADCAST_ROWS = 50_000


def small(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """A table with a broadcast hint if it has few enough rows."""
    rows = frame.count() if rows is None else rows
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")
    return words


def _portions(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    sizes = batch.column(column)
    start, held = 0, 0
    for at, size in enumerate(_byte_sizes(sizes)):
        if held and held + size > most:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _byte_sizes(values: pa.Array) -> Iterable[int]:
    import pyarrow.compute as pc

    return (n or 0 for n in pc.binary_length(values).to_pylist())


def hand_back() -> None:
    """Give memory that a task has freed back to the system.

    A worker stays for later tasks and stages; else it keeps what the largest one took.
    """
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # glibc's, others have none
        trim(0)


def map_rows(
    frame: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, list]]],
    schema: StructType | str,
    heavy: str,
    portion_bytes: int = PORTION_BYTES,
) -> DataFrame:
    """Map every row of ``frame`` to one row of ``schema``, in portions of bounded size.

    ``make`` runs once per task and returns the function for a portion; it gets the columns
    of ``frame`` as an Arrow batch and returns the output columns as lists or Arrow arrays.
    ``heavy`` is the column whose bytes bound a portion.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for part in _portions(batch, heavy, portion_bytes):
                out = apply(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        c if isinstance(c, pa.Array) else pa.array(c, type=field.type)
                        for c, field in ((out[f.name], f) for f in target)
                    ],
                    schema=target,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from mapped(batches)
        hand_back()

    return frame.mapInArrow(run, schema)


def split_long(text: str, most: int) -> Iterator[str]:
    """Cut a text at stable places into parts of about ``most`` characters.

    A part that starts with a space keeps it.  A text without a stable place stays whole.
    """
    start = 0
    while len(text) - start > most:
        found = STABLE_CUT.search(text, start + most)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def segments(text: str) -> tuple[str, list[str]]:
    """The first unit of a text and the other units without the space they start with.

    Units are parts between stable places: word splitting and merging never cross them.
    """
    units = text.split(" ")
    if "" in units or any(u[0].isspace() for u in units if not u[0].isalnum()):
        units = STABLE_CUT.split(text)
    return units[0], units[1:]
