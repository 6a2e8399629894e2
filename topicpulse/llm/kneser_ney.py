"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, mapped by the workers.

Words are 64-bit hashes, and so are the contexts of a word (the words before it, the nearest
first) and the n-grams.  Counting goes level by level, from the longest n-grams down:

* Tasks add up the n-grams of some million tokens and send them, packed by context, to the
  bucket of the context.  A context with more than ``1 / PARTS`` of all tokens would make its
  bucket heavy: such contexts are found by a pass before, and their n-grams are dealt out by
  their own hash instead.
* The task of a bucket adds up its n-grams and writes them as sorted arrays: hashes and counts,
  and for every context its total and how many n-grams after it have the counts 1, 2, 3 or more.
  What is left of an n-gram without its first word goes to the bucket of the next level, where
  the number of such n-grams is the count (the number of different words before).
* Words come last: their counts, and the number of words before them.

The discounts come from the numbers of n-grams with the counts 1 to 4 at a level.  To score,
workers map the arrays into memory and look up the sorted n-grams of a portion of documents, so
pages are read in order and only where something is asked for.  On the driver are the numbers
of a level and the totals of the heavy contexts, ``2 * PARTS`` at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from topicpulse.llm import common
from topicpulse.llm.common import cut, map_rows
from topicpulse.llm.shared_arrays import ArrayStore
from topicpulse.operators.lineage import Stages

ORDER = 2
# Documents whose CRC-32 of the id leaves no remainder by this are not learnt from.
HELD_OUT_PART = 10
BASE_ADDED = 0.1
PARTS = 5000
# Tokens that are counted together in a task, and tokens of a bucket.
TOKENS_HELD = 1_500_000
BUCKET_TOKENS = 1_500_000
PORTION_BYTES = 4 << 20
# N-grams of a row on their way to a bucket: its numbers fit into 16 bits.
ROW_GRAMS = 32_000
# Discounts where a level has no n-gram of one of the counts 1 to 4.
FALLBACK = (0.5, 1.0, 1.5)

PACKED = (
    "kind string, bucket int, chain array<bigint>, runs array<smallint>, words array<bigint>, "
    "nth array<smallint>, seen array<int>, counts array<bigint>, more array<bigint>"
)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of ``a`` followed by ``b``."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


# No word has white space in it.
START, END = b" ", b"\n"


def token_rows(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts as hashes, and how many rows each text has.

    A text is ``order - 1`` starts, its words and an end.
    """
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.array([_word_hash(w) for w in distinct], dtype=np.uint64)
    indices = coded.indices.to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    if b"" in distinct:  # white space at an end of a text
        real = indices != distinct.index(b"")
        indices, text_of = indices[real], text_of[real]
        lengths = np.bincount(text_of, minlength=len(lengths))
    rows = lengths + order
    starts = np.cumsum(rows) - rows
    tokens = np.full(int(rows.sum()), _word_hash(START), dtype=np.uint64)
    tokens[starts + rows - 1] = _word_hash(END)
    # The words of a text stand behind its starts, and behind the texts before it.
    tokens[np.arange(len(indices)) + text_of * order + order - 1] = hashes[indices]
    return tokens, rows


def contexts(tokens: np.ndarray, places: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of the 1, 2, ... tokens before each place."""
    found = []
    for k in range(1, longest + 1):
        before = tokens[places - k]
        found.append(before if k == 1 else mixed(found[-1], before))
    return found


def predicted(tokens: np.ndarray, rows: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all tokens but the starts, and the number of the text of each."""
    starts = np.cumsum(rows) - rows
    real = np.ones(len(tokens), dtype=bool)
    for k in range(order - 1):
        real[starts + k] = False
    return np.flatnonzero(real), np.repeat(np.arange(len(rows)), rows - (order - 1))


def held_in(sorted_keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each asked key stands among the sorted ones; -1 if it doesn't."""
    if not len(sorted_keys):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(sorted_keys, asked), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == asked, at, -1)


def bucket_of(context: np.ndarray, gram: np.ndarray, heavy: np.ndarray, buckets: int) -> np.ndarray:
    dealt = np.where(held_in(heavy, context) >= 0, gram, context)
    return (mixed(dealt, np.uint64(1)) % np.uint64(buckets)).astype(np.int32)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where each distinct key first stands, and the sums of the values for the sorted keys."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else order
    return order[first], *[np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]


def packed(kind: str, chain: list[np.ndarray], word, count, heavy, buckets: int) -> list[dict]:
    """N-grams with counts as rows of one bucket each; ``chain`` has the longest context last."""
    gram = mixed(chain[-1], word)
    at, count = summed(gram, count)
    chain, word = [c[at] for c in chain], word[at]
    bucket = bucket_of(chain[-1], gram[at], heavy, buckets)
    order = np.lexsort((chain[-1], bucket))
    chain, word, count, bucket = [c[order] for c in chain], word[order], count[order], bucket[order]
    ends = np.flatnonzero(np.concatenate([bucket[1:] != bucket[:-1], [True]])) + 1 if len(word) else []
    rows, start = [], 0
    pieces = [p for a, b in zip([0, *ends], ends) for p in [*range(a + ROW_GRAMS, b, ROW_GRAMS), b]]
    for end in pieces:
        own = chain[-1][start:end]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        words, nth = np.unique(word[start:end], return_inverse=True)
        rows.append(
            {
                "kind": kind,
                "bucket": bucket[start],
                "chain": np.concatenate([c[start:end][first] for c in chain]).view(np.int64),
                "runs": np.diff(np.append(first, end - start)).astype(np.int16),
                "words": words.view(np.int64),
                "nth": nth.astype(np.int16),
                "seen": count[start:end].astype(np.int32),
            }
        )
        start = end
    return rows


def _unpacked(table: pa.Table, levels: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    chain, words, counts = [[] for _ in range(levels)], [], []
    flat = lambda c, n: table.column(c)[n].values.to_numpy(zero_copy_only=False)
    for n in range(table.num_rows):
        runs = flat("runs", n)
        for k, one in enumerate(flat("chain", n).view(np.uint64).reshape(levels, len(runs))):
            chain[k].append(np.repeat(one, runs))
        words.append(flat("words", n).view(np.uint64)[flat("nth", n)])
        counts.append(flat("seen", n).astype(np.int64))
    return [np.concatenate(c) for c in chain], np.concatenate(words), np.concatenate(counts)


def _rows(found: list[dict]) -> pa.RecordBatch:
    wide, narrow = pa.list_(pa.int64()), pa.list_(pa.int16())
    types = {
        "kind": pa.string(), "bucket": pa.int32(), "chain": wide, "runs": narrow, "words": wide,
        "nth": narrow, "seen": pa.list_(pa.int32()), "counts": wide, "more": wide,
    }
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(c) for r in found], type=t) for c, t in types.items()], names=list(types)
    )


def _least(values: np.ndarray) -> np.ndarray:
    """The values in the narrowest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)


def _word_rows(words: np.ndarray, counts: np.ndarray, before: np.ndarray, buckets: int) -> list[dict]:
    at, counts, before = summed(words, counts, before)
    words = words[at]
    bucket = (mixed(words, np.uint64(1)) % np.uint64(buckets)).astype(np.int32)
    return [
        {"kind": "word", "bucket": b, "words": words[own].view(np.int64), "counts": counts[own], "more": before[own]}
        for b in np.unique(bucket)
        for own in [np.flatnonzero(bucket == b)]
    ]


def _of_four(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5] if len(counts) else np.zeros(4, np.int64)


class Model:
    """What the driver knows of a fitted model: numbers, heavy contexts, and where the arrays are."""

    def __init__(self, order: int, buckets: int, folder: str):
        self.order, self.buckets, self.folder = order, buckets, folder
        self.heavy = {k: np.array([], dtype=np.uint64) for k in range(2, order + 1)}
        self.heavy_sums = {k: np.zeros((0, 4), dtype=np.int64) for k in range(2, order + 1)}
        self.discounts: dict[int, tuple[float, float, float]] = {}
        self.tokens = self.words = self.before = 0
        self.left_over = 1.0

    def taken(self, level: int, counts: np.ndarray) -> np.ndarray:
        return np.array([0.0, *self.discounts[level]])[np.minimum(counts, 3).astype(np.int64)]


def discounts(of_four: list[int]) -> tuple[float, float, float]:
    """The modified Kneser-Ney discounts of the counts 1, 2, and 3 or more."""
    n1, n2, n3, n4 = of_four
    if not all(of_four):
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return found if all(0 <= d <= n + 1 for n, d in enumerate(found)) else FALLBACK


def _portions(batches: Iterator[pa.RecordBatch], order: int):
    """``tokens, rows`` of portions of some million tokens."""
    held, size = [], 0
    for batch in batches:
        for part in common._portions(batch, "text", PORTION_BYTES):
            held.append(token_rows(part.column("text"), order))
            size += len(held[-1][0])
            if size >= TOKENS_HELD:
                yield [np.concatenate(x) for x in zip(*held)]
                held, size = [], 0
                pa.default_memory_pool().release_unused()
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _heavy_contexts(texts: DataFrame, model: Model) -> None:
    """Set the heavy contexts and the buckets of a model.

    A portion tells its contexts with half of the share asked for, 2 * PARTS at most.  A
    context with that share of all tokens has at least half of it in what is told.
    """
    order = model.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, rows in _portions(batches, order):
            places, _ = predicted(tokens, rows, order)
            out = [(0, 0, len(places))]
            for k, context in enumerate(contexts(tokens, places, order - 1), 2):
                keys, counts = np.unique(context, return_counts=True)
                many = counts * 2 * PARTS >= len(places)
                out += [(k, h, n) for h, n in zip(keys[many].view(np.int64).tolist(), counts[many].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in zip(*out)], names=["level", "context", "n"]
            )

    told = texts.mapInArrow(run, "level bigint, context bigint, n bigint").groupBy("level", "context")
    told = cut(told.agg(F.sum("n").alias("n")))
    total = told.filter("level = 0").agg(F.sum("n")).first()[0] or 0
    model.buckets = max(model.buckets, -(-total // BUCKET_TOKENS))
    least = max(total // (2 * PARTS), 1)
    for level in model.heavy:
        many = told.filter((F.col("level") == level) & (F.col("n") > least)).select("context").collect()
        model.heavy[level] = np.sort(np.array([r.context for r in many], dtype=np.int64).view(np.uint64))


def _counted(texts: DataFrame, model: Model) -> DataFrame:
    order, heavy, buckets = model.order, model.heavy[model.order], model.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, rows in _portions(batches, order):
            places, _ = predicted(tokens, rows, order)
            chain = contexts(tokens, places, order - 1)
            ones = np.ones(len(places), dtype=np.int64)
            yield _rows(packed("gram", chain, tokens[places], ones, heavy, buckets))

    return texts.mapInArrow(run, PACKED)


def _one_level(rows: DataFrame, model: Model, level: int) -> DataFrame:
    """Write the arrays of a level; rows for the next one, for words, and sums."""
    folder, buckets, heavy, top = model.folder, model.buckets, model.heavy[level], level == model.order
    below = model.heavy.get(level - 1)

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        chain, word, count = _unpacked(table, level - 1)
        at, count = summed(mixed(chain[-1], word), count)
        chain, word = [c[at] for c in chain], word[at]
        store = ArrayStore(folder)
        store.save(f"gram{level}-{bucket}-key", mixed(chain[-1], word))
        store.save(f"gram{level}-{bucket}-count", _least(count))
        kinds = [count, *[(np.minimum(count, 3) == n).astype(np.int64) for n in (1, 2, 3)]]
        first, *sums = summed(chain[-1], *kinds)
        context = chain[-1][first]
        whole = held_in(heavy, context) < 0
        store.save(f"context{level}-{bucket}-key", context[whole])
        for n, values in enumerate(sums):
            store.save(f"context{level}-{bucket}-{n}", _least(values[whole]))
        out = [{"kind": "sizes", "more": _of_four(count)}]
        for n in np.flatnonzero(~whole):
            out.append({"kind": "heavy", "chain": context[[n]].view(np.int64), "more": np.array([v[n] for v in sums])})
        ones = np.ones(len(word), dtype=np.int64)
        if level > 2:
            out += packed("gram", chain[:-1], word, ones, below, buckets)
        if top or level == 2:
            nothing = np.zeros_like(ones)
            out += _word_rows(word, count if top else nothing, ones if level == 2 else nothing, buckets)
        return pa.Table.from_batches([_rows(out)])

    return rows.filter("kind = 'gram'").groupBy("bucket").applyInArrow(run, PACKED)


def _words(rows: DataFrame, model: Model) -> DataFrame:
    """Write the arrays of words; their number, their tokens and the numbers of words before."""
    folder = model.folder

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        words = flat("words").view(np.uint64)
        at, counts, before = summed(words, flat("counts"), flat("more"))
        store = ArrayStore(folder)
        store.save(f"word-{bucket}-key", words[at])
        store.save(f"word-{bucket}-count", _least(counts))
        store.save(f"word-{bucket}-before", _least(before))
        several = np.count_nonzero(before >= 3)
        found = [len(at), int(counts.sum()), int(before.sum()), several, *_of_four(before).tolist()]
        return pa.table({"sizes": pa.array([found], type=pa.list_(pa.int64()))})

    return rows.filter("kind = 'word'").select("bucket", "words", "counts", "more").groupBy(
        "bucket"
    ).applyInArrow(run, "sizes array<bigint>")


def fit(docs: DataFrame, stages: Stages, order: int = ORDER, buckets: int = 8) -> Model:
    """A model of the column ``text`` of all rows, with its arrays in the folder of ``stages``.

    Null texts are empty ones: a document of an end only.  ``order`` is 2 or more.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"))
    model = Model(order, buckets, f"{stages.folder}/arrays")
    _heavy_contexts(texts, model)
    rows, words = _counted(texts, model), []
    for level in range(order, 1, -1):
        rows = stages.keep(_one_level(rows, model, level))
        words.append(rows.filter("kind = 'word'"))
        sizes = rows.filter("kind = 'sizes'").agg(*[F.sum(F.get("more", F.lit(n))) for n in range(4)])
        model.discounts[level] = discounts([n or 0 for n in sizes.first()])
        sums = [F.sum(F.get("more", F.lit(n))) for n in range(4)]
        heavy = rows.filter("kind = 'heavy'").groupBy(F.get("chain", F.lit(0)).alias("c")).agg(*sums).collect()
        keys = np.array([r[0] for r in heavy], dtype=np.int64).view(np.uint64)
        by = np.argsort(keys)
        model.heavy_sums[level] = np.array([r[1:] for r in heavy], dtype=np.int64).reshape(-1, 4)[by]
        model.heavy[level] = keys[by]
    every = words[0] if order == 2 else words[0].unionByName(words[-1])
    sizes = stages.keep(_words(every, model)).agg(*[F.sum(F.get("sizes", F.lit(n))) for n in range(8)])
    model.words, model.tokens, model.before, several, *of_four = [n or 0 for n in sizes.first()]
    model.discounts[1] = discounts(of_four)
    if model.before:
        d = model.discounts[1]
        model.left_over = (d[0] * of_four[0] + d[1] * of_four[1] + d[2] * several) / model.before
    return model


class Scorer:
    """A model in a worker."""

    def __init__(self, model: Model):
        self.model, self.store = model, ArrayStore(model.folder)

    def _asked(self, name: str, keys, bucket, columns: list[str]) -> tuple[np.ndarray, ...]:
        """The columns of each key, 0 where it isn't held, and whether it is."""
        out = [np.zeros(len(keys), dtype=np.int64) for _ in columns]
        there = np.zeros(len(keys), dtype=bool)
        order = np.lexsort((keys, bucket))
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for own in np.split(order, cuts) if len(order) else []:
            of = f"{name}-{bucket[own[0]]}"
            held = self.store.load(f"{of}-key")
            if held is None:
                continue
            at = held_in(held, keys[own])
            mine = own[at >= 0]
            there[mine] = True
            for values, c in zip(out, columns):
                values[mine] = self.store.load(f"{of}-{c}")[at[at >= 0]]
        return *out, there

    def words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and chances by the lowest level of distinct words."""
        m = self.model
        bucket = (mixed(words, np.uint64(1)) % np.uint64(m.buckets)).astype(np.int32)
        counts, before, _ = self._asked("word", words, bucket, ["count", "before"])
        chance = np.maximum(before - m.taken(1, before), 0) / max(m.before, 1)
        return counts, chance + m.left_over / (m.words + 1)

    def follow(self, level: int, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Totals of distinct contexts, 0 if not seen, and the share left for shorter ones."""
        m = self.model
        bucket = bucket_of(context, context, m.heavy[level], m.buckets)
        *sums, there = self._asked(f"context{level}", context, bucket, ["0", "1", "2", "3"])
        heavy = held_in(m.heavy[level], context)
        for n, values in enumerate(sums):
            values[heavy >= 0] = m.heavy_sums[level][heavy[heavy >= 0], n]
        total, *kinds = sums
        left = sum(d * n for d, n in zip(m.discounts[level], kinds)) / np.maximum(total, 1)
        return total, np.where(total > 0, left, 1.0)

    def chances(self, tokens: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of the token at each place, and its chance after those before it."""
        m = self.model
        distinct, nth = np.unique(tokens[places], return_inverse=True)
        counts, chance = (x[nth] for x in self.words(distinct))
        for level, context in enumerate(contexts(tokens, places, m.order - 1), 2):
            own, nth = np.unique(context, return_inverse=True)
            total, left = (x[nth] for x in self.follow(level, own))
            grams, first, nth = np.unique(mixed(context, tokens[places]), return_index=True, return_inverse=True)
            bucket = bucket_of(context[first], grams, m.heavy[level], m.buckets)
            found, _ = self._asked(f"gram{level}", grams, bucket, ["count"])
            kept = np.maximum(found - m.taken(level, found), 0)[nth] / np.maximum(total, 1)
            chance = kept + left * chance
        return counts, chance


RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``doc_id, held_out, text`` with its tokens and its log10 chances."""

    def make():
        scorer = Scorer(model)
        spread = math.log10(model.tokens + BASE_ADDED * (model.words + 1))

        def apply(part: pa.RecordBatch) -> dict[str, list]:
            tokens, rows = token_rows(part.column("text"), model.order)
            places, text_of = predicted(tokens, rows, model.order)
            counts, chance = scorer.chances(tokens, places)
            total = lambda values: np.bincount(text_of, values, minlength=len(rows))
            return {
                "doc_id": part.column("doc_id"),
                "held_out": part.column("held_out"),
                "n_tokens": pa.array(rows - (model.order - 1)),
                "n_known": pa.array(total(counts > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(rows), model.tokens, dtype=np.int64)),
                "base_score": pa.array(total(np.log10(counts + BASE_ADDED) - spread)),
                "score": pa.array(total(np.log10(chance))),
            }

        return apply

    return map_rows(docs, make, RESULT, "text", PORTION_BYTES)


def held_out(doc_id: Column) -> Column:
    """Documents that are only scored; those without an id are learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_PART == 0, F.lit(False))


def score_corpus(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Scores of all documents by a model of those that are not held out.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: the tokens are
    the words of the text in lower case (A to Z) and an end; ``base_score`` is by single words
    with 0.1 added to every count, ``score`` by the model.  Null texts are empty, repeated rows
    count as often as they stand there, and only ``doc_id`` and ``text`` are read.  If nothing
    is learnt, the only token known has a chance of 1.
    """
    told = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    stages = Stages(docs.sparkSession)
    model = fit(told.filter("NOT held_out"), stages, order)
    found = cut(scores(told, model))
    stages.release()
    return found
