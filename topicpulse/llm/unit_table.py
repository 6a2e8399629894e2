"""The distinct units of a corpus and their token ids, as sorted arrays that workers map.

A unit is a part of a text between two stable places, see ``common.segments``; neither word
splitting nor merging crosses its ends.  Tasks gather the distinct units of their texts and
deal them out by hash, so each unit of the corpus meets in one bucket and is encoded there
once.  The bucket is written as arrays: hashes in order, and the ids one after another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicpulse.llm import common
from topicpulse.llm.common import segments
from topicpulse.llm.shared_arrays import ArrayStore
from topicpulse.operators.lineage import Stages

# Units that a task gathers before it deals them out, and that are encoded at a time.
UNITS_HELD = 150_000
UNITS_ENCODED = 10_000
# Bytes of text that are split into units at a time.
GATHER_BYTES = 1 << 20
# Bytes of text for a bucket; distinct units are far fewer.
BUCKET_BYTES = 16 << 20
# White space after a space, or a space at the end: units need a closer look there.
_ODD = (
    " (?:[ \\t\\n\\x0b\\f\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]|\\z)"
)


def coded_units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units, the unit at each place of all texts, and the number of each text's units."""
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    looked_at = []
    for text in texts.filter(pa.array(odd)).to_pylist():
        first, rest = segments(text)
        looked_at.append([first, *rest])
    lists = pa.concat_arrays([plain, pa.array(looked_at, type=plain.type)])
    coded = lists.flatten().dictionary_encode()
    indices = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # The first unit of a text has no space before it, so it counts as another one.
    indices *= 2
    indices += 1
    indices[np.cumsum(counts) - counts] -= 1
    used, indices = np.unique(indices, return_inverse=True)
    names = coded.dictionary.take(pa.array(used // 2)).to_pylist()
    units = [f" {n}" if k else n for n, k in zip(names, (used & 1).tolist())]
    # The texts that were looked at stand behind the others.
    of = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
    order = np.argsort(of)
    starts = np.cumsum(counts) - counts
    return units, indices[ragged(starts[order], counts[order])], counts[order]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of all stretches, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def unit_hashes(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    import xxhash

    digest = xxhash.xxh3_128_digest
    both = np.frombuffer(b"".join([digest(u) for u in units]), dtype=">u8").astype(np.uint64)
    return both[0::2], both[1::2]


def _dealt(units: set[str], buckets: int) -> pa.RecordBatch:
    data = [u.encode("utf-8", "surrogatepass") for u in units]
    high, _ = unit_hashes(data)
    bucket = (high % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rows = []
    for places in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
        own = [data[n] for n in places]
        rows.append((bucket[places[0]], [len(u) for u in own], b"".join(own)))
    types = [pa.int32(), pa.list_(pa.int32()), pa.binary()]
    columns = zip(*rows) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=t) for c, t in zip(columns, types)], names=["bucket", "lengths", "data"]
    )


def write_unit_table(
    texts: DataFrame, stages: Stages, make_encoder: Callable[[], Callable[[list[bytes]], list[bytes]]]
) -> tuple[str, int]:
    """Write the arrays for the column ``text``; the folder and the number of buckets.

    ``make_encoder`` gives, in a task, a function from units to their ids as packed
    little-endian 32-bit integers.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))
    folder = f"{stages.folder}/units"

    def units_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[str] = set()
        for batch in batches:
            for part in common._portions(batch, "text", GATHER_BYTES):
                held.update(coded_units(part.column("text"))[0])
                if len(held) > UNITS_HELD:
                    yield _dealt(held, buckets)
                    held = set()
        yield _dealt(held, buckets)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from units_of(batches)
        common.hand_back()

    def write_bucket(table: pa.Table) -> int:
        units: set[bytes] = set()
        for n in range(table.num_rows):
            data, at = table.column("data")[n].as_py(), 0
            for length in table.column("lengths")[n].values.to_pylist():
                units.add(data[at : at + length])
                at += length
        high, low = unit_hashes(found := list(units))
        order = np.lexsort((low, high))
        encode = make_encoder()
        ids, lengths = [], []
        for k in range(0, len(order), UNITS_ENCODED):
            coded = encode([found[n] for n in order[k : k + UNITS_ENCODED]])
            lengths += [len(c) // 4 for c in coded]
            ids.append(np.frombuffer(b"".join(coded), dtype="<u4"))
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        narrow = np.uint16 if len(flat) and flat.max() < 1 << 16 else np.uint32
        store, bucket = ArrayStore(folder), table.column("bucket")[0].as_py()
        store.save(f"{bucket}-high", high[order])
        store.save(f"{bucket}-low", low[order])
        store.save(f"{bucket}-start", np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]))
        store.save(f"{bucket}-ids", flat.astype(narrow))
        return len(order)

    def encoded(table: pa.Table) -> pa.Table:
        written = write_bucket(table)
        common.hand_back()
        return pa.table({"units": pa.array([written], type=pa.int64())})

    rows = texts.mapInArrow(gathered, "bucket int, lengths array<int>, data binary")
    done = rows.groupBy("bucket").applyInArrow(encoded, "units bigint")
    stages.keep(done).count()
    return folder, buckets


class UnitTable:
    """The table in a worker."""

    def __init__(self, folder: str, buckets: int):
        self.store, self.buckets = ArrayStore(folder), buckets

    def ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each unit has, and all of them one after another."""
        high, low = unit_hashes([u.encode("utf-8", "surrogatepass") for u in units])
        bucket = (high % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((high, bucket))
        parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
        found = []
        lengths = np.zeros(len(units), dtype=np.int64)
        for own in parts:
            name = bucket[own[0]]
            at = self._places(name, high[own], low[own])
            starts = self.store.load(f"{name}-start")
            lengths[own] = starts[at + 1] - starts[at]
            found.append((own, name, starts[at]))
        out = np.empty(int(lengths.sum()), dtype=np.uint32)
        places = np.cumsum(lengths) - lengths
        for own, name, starts in found:
            out[ragged(places[own], lengths[own])] = self.store.load(f"{name}-ids")[ragged(starts, lengths[own])]
        return lengths, out

    def _places(self, name: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        highs, lows = self.store.load(f"{name}-high"), self.store.load(f"{name}-low")
        at = np.searchsorted(highs, high)
        # Equal first halves follow each other, in the order of the second ones.
        while len(other := np.flatnonzero(lows[at] < low)):
            at[other] += 1
        if not (np.array_equal(highs[at], high) and np.array_equal(lows[at], low)):
            raise ValueError("a unit is not in the table: the texts have changed since it was made")
        return at
