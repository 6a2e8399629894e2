"""Repeated line runs by a suffix array over line ids.

The lines of all texts are numbered in the order of the documents: one long sequence of line
ids, in which a comparison ends with its document.  Prefix doubling ranks all suffixes by their
first 1, 2, 4, ... lines: the pair of the ranks at a place and so many lines further gives the
rank for twice the length.  Ranks keep the order of the pairs, so those of the last round are
the suffix array.  A group of equal rank after k lines is an interval of the array with a common
prefix of k lines or more.  Only places in such a group go on: a suffix whose prefix is unique
shares no longer one either.

Of every group the first place, by document and line, is the copy that stays.  The k lines at
any later place are a repeated run; two overlapping runs of the largest k cover a maximal run.
A repeated run of at least ``min_words`` words is deleted.  Two runs of k lines that cover one
of fewer words may have too few each, which can only be if k is below ``min_words``: up to there
the intervals of all lengths are looked at and not only those of the powers of two, again by
pairs of ranks, which then overlap.

No text moves before the last join.  Lines move once as hashes, to be numbered; from then on
rows are a number, a rank and what is left of the document, and a round moves repeated places
only.  Groups are reduced to one row before they are ranked, however many places they have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from topicpulse.llm import common
from topicpulse.llm.common import cut
from topicpulse.operators.lineage import Stages, settings

MIN_WORDS = 5

# A line ends where the next line with a word begins; blank lines go with the line before.
_LINE_END = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"
DOC = ["doc_order", "text_key"]
LINE = "doc_order bigint, text_key bigint, at int, rest int, need int, id_high bigint, id_low bigint"


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents are told apart by id and text; null ids come last."""
    text = F.col("text").cast("string")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    return docs.select(order.alias("doc_order"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def hashed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_order, text_key, at, rest, need, id_high, id_low``: a row for each line with a word.

    ``rest`` lines are left in the text from there on, and ``need`` of them have at least
    ``min_words`` words, more than ``rest`` if all have fewer.
    """

    def lines_of(text: str, split: re.Pattern) -> tuple[list[int], list[int], list[bytes]]:
        import xxhash

        lines = [x.strip(b" \t\n\x0b\x0c\r") for x in split.split(text.encode("utf-8", "surrogatepass"))]
        words = [len(x.split()) for x in lines]
        need, held, end = [], 0, 0
        for at, own in enumerate(words):
            while held < min_words and end < len(words):
                held += words[end]
                end += 1
            need.append(max(end - at, 1) if held >= min_words else len(words) + 1)
            held -= own
        told = [at for at, own in enumerate(words) if own]
        return told, need, [xxhash.xxh3_128_digest(lines[at]) for at in told], len(lines)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        split = re.compile(_LINE_END.encode())
        for batch in batches:
            for part in common._portions(batch, "text", common.PORTION_BYTES):
                at, rest, need, ids, counts = [], [], [], [], []
                for text in part.column("text").to_pylist():
                    told, needs, hashes, total = lines_of(text or "", split)
                    at += told
                    rest += [total - k for k in told]
                    need += [needs[k] for k in told]
                    ids += hashes
                    counts.append(len(told))
                both = np.frombuffer(b"".join(ids), dtype=">i8").astype(np.int64)
                numbers = [part.column(c).to_numpy() for c in DOC]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(np.repeat(n, counts)) for n in numbers],
                        *[pa.array(x, type=pa.int32()) for x in (at, rest, need)],
                        pa.array(both[0::2]),
                        pa.array(both[1::2]),
                    ],
                    names=[*DOC, "at", "rest", "need", "id_high", "id_low"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from hashed(batches)
        common.hand_back()

    return _keyed(docs).mapInArrow(run, LINE)


def line_places(docs: DataFrame, stages: Stages, min_words: int = MIN_WORDS) -> DataFrame:
    """The hashed lines with ``p``, their number in the order of documents and lines.

    Rows equal in id and text are one document.
    """
    order = [*DOC, "at"]
    with settings(docs.sparkSession, common.SENT):
        lines = stages.keep(hashed_lines(docs, min_words))
    sorted_lines = lines.repartitionByRange(*order).dropDuplicates(order).sortWithinPartitions(*order)
    numbered = sorted_lines.withColumn("_id", F.monotonically_increasing_id())
    numbered = stages.keep(numbered.withColumn("_part", F.shiftright("_id", 33).cast("int")))
    # One row for each partition, so this is small whatever the number of lines.
    sizes = sorted(tuple(r) for r in numbered.groupBy("_part").count().collect())
    starts, total = [], 0
    for part, count in sizes:
        starts.append(total - (part << 33))
        total += count
    # Executors would start Python workers of their own for a list of rows, which then stay.
    parts = pa.array([part for part, _ in sizes], type=pa.int32())
    offsets = docs.sparkSession.createDataFrame(
        pa.table({"_part": parts, "_from": pa.array(starts, type=pa.int64())})
    )
    placed = numbered.join(F.broadcast(offsets), "_part")
    return placed.select(*order, "rest", "need", "id_high", "id_low", (F.col("_id") + F.col("_from")).alias("p"))


def groups_of(places: DataFrame, pair: list[str]) -> DataFrame:
    """``pair, first``: pairs at more than one place, with the first of them."""
    found = places.groupBy(*pair).agg(F.min("p").alias("first"), F.max("p").alias("last"))
    return found.filter("first < last").select(*pair, "first")


def ranked(places: DataFrame, pair: list[str], stages: Stages) -> DataFrame:
    """Places whose pair occurs elsewhere: ``p, rest, need, rank, later``.

    Ranks order the pairs; ``later`` tells all places of a pair but the first.  Tables of a
    round are written, not checkpointed: the sizes that Spark estimates for a join are products,
    a checkpoint keeps them, and over the rounds they grow to numbers of millions of digits.
    """
    ordered = groups_of(places, pair).orderBy(*pair)
    ordered = stages.keep(ordered.withColumn("_rank", F.monotonically_increasing_id()))
    # A shuffle join: the groups are too many for the driver, and adaptive execution splits
    # the places of a frequent line.
    joined = places.join(ordered, pair)
    later = F.col("p") > F.col("first")
    return stages.keep(
        joined.select("p", "rest", "need", F.col("_rank").alias("rank"), later.alias("later"))
    )


def paired(places: DataFrame, length: int, apart: int) -> DataFrame:
    """Places with their ranks for ``length`` lines and those ``apart`` lines further on."""
    following = places.select((F.col("p") - apart).alias("p"), F.col("rank").alias("next_rank"))
    # The lines must be of one document.
    return places.filter(F.col("rest") >= apart + length).join(following, "p")


def _runs(places: DataFrame, length: int) -> DataFrame:
    """``p, rest, length`` of the later copies that have words enough."""
    found = places.filter(F.col("later") & (F.col("need") <= length))
    return found.select("p", "rest", F.lit(length).alias("length"))


def repeated_runs(docs: DataFrame, stages: Stages, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_order, text_key, start, end``: the stretches of lines to delete, end exclusive."""
    lines = line_places(docs, stages, min_words)
    places = ranked(lines, ["id_high", "id_low"], stages)
    length, runs = 1, _runs(places, 1)
    while not places.isEmpty():
        if length < min_words:
            for apart in range(1, length):
                both = paired(places, length, apart)
                groups = groups_of(both, ["rank", "next_rank"])
                later = both.join(groups, ["rank", "next_rank"]).withColumn("later", F.col("p") > F.col("first"))
                runs = runs.unionByName(stages.keep(_runs(later, length + apart)))
        places = ranked(paired(places, length, length), ["rank", "next_rank"], stages)
        length *= 2
        runs = runs.unionByName(_runs(places, length))
    # The number after the last line of a document tells it from others.
    longest = runs.groupBy("p", (F.col("p") + F.col("rest")).alias("doc")).agg(
        (F.col("p") + F.max("length")).alias("end")
    )
    before = Window.partitionBy("doc").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    reached = longest.withColumn("reached", F.max("end").over(before))
    opens = F.when(F.col("reached") >= F.col("p"), 0).otherwise(1)
    up_to = Window.partitionBy("doc").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    stretches = reached.withColumn("stretch", F.sum(opens).over(up_to))
    merged = stretches.groupBy("doc", "stretch").agg(F.min("p").alias("p"), F.max("end").alias("end"))
    last = lines.filter("rest = 1").select((F.col("p") + 1).alias("doc"), *DOC, (F.col("at") + 1).alias("_lines"))
    back = lambda c: (F.col("_lines") - (F.col("doc") - F.col(c))).cast("int")
    return merged.join(last, "doc").select(*DOC, back("p").alias("start"), back("end").alias("end"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs``, with ``text`` shortened, ``n_lines`` and ``n_removed``.

    Lines are equal if they are without the white space at their ends.  Documents come in the
    order of ``doc_id``, null last; rows equal in id and text are one document and come out
    alike.  A null text stays null.  Columns of ``docs`` named as the two new ones give way.
    """
    stages = Stages(docs.sparkSession)
    runs = repeated_runs(docs, stages, min_words).groupBy(*DOC).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_runs")
    )
    runs = cut(runs.withColumnsRenamed({c: f"_{c}" for c in DOC}))
    stages.release()
    text = F.col("text").cast("string")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    docs = docs.drop("n_lines", "n_removed")
    # The only time that texts move, whatever the number of runs.
    joined = docs.join(
        runs,
        (order == F.col("_doc_order")) & (F.xxhash64(text) == F.col("_text_key")),
        "left",
    )
    split = joined.withColumn("_lines", F.split(text, _LINE_END))
    gone = F.flatten(F.transform("_runs", lambda r: F.sequence(r["start"], r["end"] - 1)))
    rest = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone)
    left = split.withColumn("_rest", F.when(F.col("_runs").isNotNull(), rest))
    # The lines are looked up by number; a line may end in the blank lines after it.
    shortened = F.array_join(F.transform("_rest", lambda i: F.get("_lines", i)), "\n")
    n_lines = F.greatest(F.size("_lines"), F.lit(0)).cast("long")
    return left.select(
        *[
            F.coalesce(shortened, text).alias("text") if c == "text" else F.col(c)
            for c in docs.columns
        ],
        n_lines.alias("n_lines"),
        F.when(F.col("_rest").isNull(), F.lit(0))
        .otherwise(n_lines - F.size("_rest"))
        .cast("long")
        .alias("n_removed"),
    )
