"""Byte-level BPE by corpus-level merge replay.

Words repeat, so merges are applied to the distinct words of a portion of the corpus and not
to texts.  The symbols of all these words stand in one array, linked to their neighbours, and
an inverted index leads from a pair (by the rank of what it merges to) to its places.  The
merges are replayed over the whole array in rank order: each takes its places from the index,
joins the symbols there, and enters only the pairs with the two touched neighbours anew.  A
new pair of a lower rank is replayed before the rest of the current one, which makes each word
come out as if it had been encoded alone.

``round_trip`` replays over the distinct units of the whole corpus, see ``unit_table``, and
puts the texts together from the table, which workers map: no text is moved.  ``encode`` is
for frames that are read once: it replays over the words of a portion of the texts, and what
a worker has encoded stays in a memo of bounded size.
"""

from __future__ import annotations

import base64
import heapq
import struct

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicpulse.llm.common import SENT, cut, map_rows, segments, split_long
from topicpulse.llm.unit_table import UnitTable, coded_units, ragged, write_unit_table
from topicpulse.operators.lineage import Stages, settings

MEMO_ENTRIES = 200_000
PAIRS_HELD = 500_000
# Units over this length are not kept in the memo.
MEMO_LENGTH = 64
PART_CHARS = 1 << 19
# Texts that are split into units at a time.
PORTION_BYTES = 1 << 20
# Texts that are put together at a time.  Each time looks at every bucket of the table.
JOINED_BYTES = 2 << 20


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {
        base64.b64decode(token): int(rank)
        for token, rank in (line.split() for line in content.splitlines() if line)
    }


class MergeReplay:
    """Encodes many distinct words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pair_ranks: dict[tuple[int, int], int] = {}

    def _pair_rank(self, left: int, right: int) -> int:
        """The rank of what a pair merges to, -1 if it doesn't merge."""
        pair = (left, right)
        found = self.pair_ranks.get(pair)
        if found is None:
            if len(self.pair_ranks) > PAIRS_HELD:
                self.pair_ranks.clear()
            found = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
            self.pair_ranks[pair] = found
        return found

    def encode(self, words: Iterable[bytes]) -> list[list[int]]:
        words = list(words)
        single, known, pair_rank = self.single, self.pair_ranks, self._pair_rank
        # One array for all words.  -1 ends a word, and stands for a symbol that is gone.
        symbols: list[int] = [-1]
        starts: list[int] = []
        whole: dict[int, int] = {}
        for n, word in enumerate(words):
            starts.append(len(symbols))
            rank = self.ranks.get(word)
            if rank is not None:
                whole[n] = rank
                symbols.append(rank)
            else:
                symbols.extend([single[b] for b in word])
            symbols.append(-1)
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        index: dict[int, list[int]] = {}
        left = -1
        for at, right in enumerate(symbols):
            if left >= 0 and right >= 0:
                rank = known.get((left, right))
                if rank is None:
                    rank = pair_rank(left, right)
                if rank >= 0:
                    places = index.get(rank)
                    if places is None:
                        index[rank] = [at - 1]
                    else:
                        places.append(at - 1)
            left = right
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            for n, at in enumerate(places):
                here = symbols[at]
                if here < 0:
                    continue
                other = after[at]
                right = symbols[other]
                if right < 0 or known.get((here, right)) != rank:
                    if right < 0 or pair_rank(here, right) != rank:
                        continue
                symbols[at] = rank
                symbols[other] = -1
                following = after[other]
                after[at] = following
                before[following] = at
                earlier = False
                right = symbols[following]
                if right >= 0:
                    new = known.get((rank, right))
                    if new is None:
                        new = pair_rank(rank, right)
                    if new >= 0:
                        if new in index:
                            index[new].append(at)
                        else:
                            index[new] = [at]
                            heapq.heappush(heap, new)
                        earlier = new < rank
                previous = before[at]
                left = symbols[previous]
                if left >= 0:
                    new = known.get((left, rank))
                    if new is None:
                        new = pair_rank(left, rank)
                    if new >= 0:
                        if new in index:
                            index[new].append(previous)
                        else:
                            index[new] = [previous]
                            heapq.heappush(heap, new)
                        earlier = earlier or new < rank
                if earlier:
                    rest = places[n + 1 :]
                    if rest:
                        index.setdefault(rank, []).extend(rest)
                        heapq.heappush(heap, rank)
                    break
        starts.append(len(symbols))
        return [
            [s for s in symbols[a : b - 1] if s >= 0]
            for a, b in zip(starts, starts[1:])
        ]


class TextEncoder:
    """Texts to packed ids: a memo of units and of words in front of the replay."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.replay = MergeReplay(ranks)
        self.find = regex.compile(pattern).findall
        self.units: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Packed ids of units (with their leading space)."""
        found = [self.find(u) for u in units]
        words = self.words
        missing = list({w: None for ws in found for w in ws if w not in words})
        encoded = self.replay.encode([w.encode("utf-8", "surrogatepass") for w in missing])
        fresh = {
            w: struct.pack(f"<{len(ids)}I", *ids) for w, ids in zip(missing, encoded)
        }
        out = [b"".join([words.get(w) or fresh[w] for w in ws]) for ws in found]
        if len(words) + len(fresh) > MEMO_ENTRIES:
            words.clear()
        words.update((w, p) for w, p in fresh.items() if len(w) <= MEMO_LENGTH)
        return out

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text; empty for null."""
        memo = self.units
        firsts: list[str] = []
        parts: list[tuple[int, list[str]]] = []
        for n, text in enumerate(texts):
            for k, part in enumerate(split_long(text or "", PART_CHARS)):
                first, units = segments(part)
                firsts.append(first)
                parts.append((n, units))
        missing = list({u: None for _, units in parts for u in units if u not in memo})
        coded = self._encode_units(firsts + [" " + u for u in missing])
        fresh = dict(zip(missing, coded[len(firsts) :]))
        packed = [[] for _ in range(parts[-1][0] + 1)] if parts else []
        for (n, units), first in zip(parts, coded):
            packed[n].append(first)
            packed[n].extend([memo.get(u) or fresh[u] for u in units])
        if len(memo) + len(fresh) > MEMO_ENTRIES:
            memo.clear()
        memo.update((u, p) for u, p in fresh.items() if len(u) <= MEMO_LENGTH)
        return [b"".join(p) for p in packed]


def _default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _share(frame: DataFrame, path: str | None, pattern: str | None):
    """The vocabulary file, sent to the executors once; they needn't have the file."""
    default = _default_vocabulary() if path is None or pattern is None else ("", "")
    with open(path or default[0], "rb") as file:
        content = file.read()
    held = {"content": content, "pattern": pattern or default[1]}
    return frame.sparkSession.sparkContext.broadcast(held)


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """``id_col, ids`` of every row, ``ids`` packed as little-endian 32-bit integers.

    ``vocabulary`` is a rank file, ``pattern`` splits a text into words.  A null or empty
    text has no ids.  Other columns are not looked at, repeated rows come out repeatedly.
    """
    shared = _share(docs, vocabulary, pattern)

    def make() -> Callable[[pa.RecordBatch], dict]:
        held = shared.value  # stays in the worker, and with it the memo
        encoder = held.get("encoder")
        if encoder is None:
            encoder = held["encoder"] = TextEncoder(read_ranks(held["content"]), held["pattern"])

        def apply(batch: pa.RecordBatch) -> dict:
            return {
                id_col: batch.column(0),
                "ids": encoder.encode(batch.column(1).to_pylist()),
            }

        return apply

    frame = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    kind = frame.schema[id_col].dataType.simpleString()
    return map_rows(frame, make, f"`{id_col}` {kind}, ids binary", text_col, PORTION_BYTES)


def decode(
    encoded: DataFrame, id_col: str = "doc_id", vocabulary: str | None = None
) -> DataFrame:
    """``id_col, ids, decoded``: the bytes that packed ``ids`` stand for; null ids give none."""
    shared = _share(encoded, vocabulary, None)

    def make() -> Callable[[pa.RecordBatch], dict]:
        import numpy as np

        held = shared.value
        tokens = held.get("tokens")
        if tokens is None:
            ranks = read_ranks(held["content"])
            tokens = held["tokens"] = {rank: token for token, rank in ranks.items()}
        token = tokens.__getitem__

        def apply(batch: pa.RecordBatch) -> dict:
            packed = batch.column(1)
            return {
                id_col: batch.column(0),
                "ids": packed,
                "decoded": [
                    b"".join(map(token, np.frombuffer(p or b"", "<u4").tolist()))
                    for p in packed.to_pylist()
                ],
            }

        return apply

    frame = encoded.select(F.col(id_col), F.col("ids"))
    kind = frame.schema[id_col].dataType.simpleString()
    return map_rows(frame, make, f"`{id_col}` {kind}, ids binary, decoded binary", "ids")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row.

    The merges are replayed once over the distinct units of the corpus; texts are put together
    from the table of their ids, and decoded from the ids.
    """
    spark = docs.sparkSession
    shared = _share(docs, vocabulary, None)
    frame = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    stages = Stages(spark)

    def make_encoder() -> Callable[[list[bytes]], list[bytes]]:
        import regex

        held = shared.value
        if "replay" not in held:
            held["replay"] = MergeReplay(read_ranks(held["content"]))
        replay, find = held["replay"], regex.compile(held["pattern"]).findall

        def encode_units(units: list[bytes]) -> list[bytes]:
            split = [find(u.decode("utf-8", "surrogatepass")) for u in units]
            words = list({w: None for ws in split for w in ws})
            coded = replay.encode([w.encode("utf-8", "surrogatepass") for w in words])
            packed = {w: struct.pack(f"<{len(ids)}I", *ids) for w, ids in zip(words, coded)}
            return [b"".join([packed[w] for w in ws]) for ws in split]

        return encode_units

    with settings(spark, SENT):
        folder, buckets = write_unit_table(frame, stages, make_encoder)

    def make() -> Callable[[pa.RecordBatch], dict]:
        import hashlib

        import numpy as np

        held = shared.value
        held.pop("replay", None)  # this worker may have encoded units before
        if "token_bytes" not in held:
            ranks = read_ranks(held["content"])
            of = {rank: token for token, rank in ranks.items()}
            tokens = [of.get(n, b"") for n in range(max(of) + 1)]
            lengths = np.array([len(t) for t in tokens], dtype=np.int64)
            flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
            held["token_bytes"] = flat, np.cumsum(lengths) - lengths, lengths
        flat, token_starts, token_lengths = held["token_bytes"]
        table = UnitTable(folder, buckets)

        def digests(ids) -> tuple[str, str]:
            # One text at a time: the places of its bytes take many times its size.
            decoded = flat[ragged(token_starts[ids], token_lengths[ids])]
            return hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

        def apply(batch: pa.RecordBatch) -> dict:
            units, at, counts = coded_units(batch.column(1))
            lengths, known = table.ids(units)
            starts = np.cumsum(lengths) - lengths
            ids = known[ragged(starts[at], lengths[at])].astype("<u4", copy=False)
            ends = np.concatenate([[0], np.cumsum(lengths[at])])[np.cumsum(counts)]
            found = [digests(own) for own in np.split(ids, ends[:-1])]
            return {
                "doc_id": batch.column(0),
                "n_tokens": np.diff(ends, prepend=0).tolist(),
                "ids_sha256": [of_ids for of_ids, _ in found],
                "decoded_sha256": [of_bytes for _, of_bytes in found],
            }

        return apply

    kind = frame.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    with settings(spark, SENT):
        found = cut(map_rows(frame, make, schema, "text", JOINED_BYTES))
    stages.release()
    return found
