"""Token counts with the tokenizer library, huge documents in overlapping chunks.

A huge document is encoded in chunks that overlap.  Two chunks are spliced at a place in the
overlap that is proven stable: a space before a character that is no white space starts a new
word whatever surrounds it, no special string holds a space, and both encodings must start a
token there.  Tokens before the place count from the first chunk, those after it from the
second.  Where an overlap has no such place it is doubled, up to the rest of the document.

Other documents are cut at all their stable places, and each distinct unit is encoded once in
a worker and its count kept in a memo of bounded size.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicpulse.llm.common import STABLE_CUT, map_rows, segments

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 256
MEMO_ENTRIES = 500_000
MEMO_LENGTH = 64


class TokenCounter:
    def __init__(self, tokenizer, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        self.tokenizer = tokenizer
        self.chunk_chars = chunk_chars
        self.overlap = overlap
        self.units: dict[str, int] = {}

    def _lengths(self, texts: list[str]) -> list[int]:
        return [
            len(e)
            for k in range(0, len(texts), 10_000)
            for e in self.tokenizer.encode_batch_fast(
                texts[k : k + 10_000], add_special_tokens=False
            )
        ]

    def _starts(self, chunk: str) -> list[int]:
        """Offsets in the chunk at which its tokens start."""
        coded = self.tokenizer.encode(chunk, add_special_tokens=False)
        return [start for start, _ in coded.offsets]

    def count_huge(self, text: str) -> int:
        start, total, size = 0, 0, self.chunk_chars
        held, end = self._starts(text[:size]), min(size, len(text))
        counted = 0  # tokens of the current chunk that the chunk before has already
        while end < len(text):
            overlap = self.overlap
            while True:
                begin = max(start, end - overlap)
                stop = min(len(text), begin + max(size, 2 * overlap))
                following = self._starts(text[begin:stop])
                cut = self._common_start(text, begin, end, start, held, following)
                if cut is not None or begin == start:
                    break
                overlap *= 2
            if cut is None:
                # No stable place in the whole chunk: it grows instead.
                size *= 2
                end = min(len(text), start + size)
                held = self._starts(text[start:end])
                # The tokens before the last splice are still those before it.
                continue
            at_left, at_right = cut
            total += at_left - counted
            start, end, held, counted = begin, stop, following, at_right
            size = self.chunk_chars
        return total + len(held) - counted

    @staticmethod
    def _common_start(text, begin, end, start, left, right) -> tuple[int, int] | None:
        """Token numbers, in both chunks, of the first stable place in ``begin .. end``.

        A place at the very start of the second chunk won't do: its left side is cut off.
        The place must lie a character inside the first chunk, to see what follows it.
        """
        for found in STABLE_CUT.finditer(text, begin + 1, end):
            place = found.start()
            if place + 1 >= end:
                break
            a = bisect_left(left, place - start)
            b = bisect_left(right, place - begin)
            if a < len(left) and b < len(right):
                if left[a] == place - start and right[b] == place - begin:
                    return a, b
        return None

    def count(self, texts: Iterable[str | None]) -> list[int]:
        memo = self.units
        out: list[int] = []
        firsts: list[str] = []
        parts: list[tuple[int, list[str]]] = []
        for n, text in enumerate(texts):
            out.append(0)
            if not text:
                continue
            if len(text) > self.chunk_chars:
                out[n] = self.count_huge(text)
                continue
            first, units = segments(text)
            firsts.append(first)
            parts.append((n, units))
        missing = list({u: None for _, units in parts for u in units if u not in memo})
        lengths = self._lengths(firsts + [" " + u for u in missing])
        fresh = dict(zip(missing, lengths[len(firsts) :]))
        if len(memo) + len(fresh) > MEMO_ENTRIES:
            memo.clear()
            again = {u for _, units in parts for u in units if u not in fresh}
            again = list(again)
            fresh.update(zip(again, self._lengths([" " + u for u in again])))
        memo.update((u, c) for u, c in fresh.items() if len(u) <= MEMO_LENGTH)
        rare = {u: c for u, c in fresh.items() if len(u) > MEMO_LENGTH}
        for (n, units), first in zip(parts, lengths):
            if rare:
                out[n] = first + sum([memo[u] if u in memo else rare[u] for u in units])
            else:
                out[n] = first + sum(map(memo.__getitem__, units))
        return out


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_file: str | None = None,
    limit: int = 1024,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row.

    ``tokenizer_file`` is a tokenizer of the library, byte-level and splitting words before
    spaces.  A null or empty text has no bytes and no tokens.  Other columns are not looked
    at, repeated rows come out repeatedly.
    """
    if tokenizer_file is None:
        import public_tokenizers

        tokenizer_file = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer_file, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast({"content": file.read()})

    def make() -> Callable[[pa.RecordBatch], dict]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        held = shared.value  # stays in the worker, and with it the memo
        counter = held.get("counter")
        if counter is None:
            tokenizer = Tokenizer.from_str(held["content"])
            tokenizer.no_truncation()
            tokenizer.no_padding()
            counter = held["counter"] = TokenCounter(tokenizer, chunk_chars, overlap_chars)

        def apply(batch: pa.RecordBatch) -> dict:
            return {
                id_col: batch.column(0),
                "n_bytes": batch.column(1),
                "n_tokens": counter.count(batch.column(2).to_pylist()),
            }

        return apply

    text = F.col(text_col).cast("string")
    frame = docs.select(
        F.col(id_col),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        text.alias("_text"),
    )
    kind = frame.schema[id_col].dataType.simpleString()
    counted = map_rows(
        frame, make, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint", "_text"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
