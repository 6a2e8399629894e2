"""Near-duplicates by banded MinHash, odd sketches and exact confirmation.

A document is the set of its distinct shingles, of two words each unless told otherwise.  Documents of equal sets are one
class, and from there on only classes count.

* Each class has ``BANDS * ROWS`` MinHash samples.  Classes that agree in a band share a bucket;
  at the least similarity two classes miss all bands with a chance of about 1e-7.
* The samples are folded into a bitmap of ``SKETCH_BITS`` parities.  The number of ones in the
  XOR of two bitmaps tells how many samples differ, most precisely for similar classes.  Pairs
  beyond ``SKETCH_LIMIT`` are no candidates; that loses a link with a chance of about 1e-6.
* Candidates are confirmed on their full sets.

Only the components are wanted, so a bucket is never expanded into its pairs.  First each
class is compared with the most promising of the representatives of its buckets.  A bucket has
two: a random one, and the most central one, which agrees with the most others in their bands
and so is likely what they are copies of.  What is linked is merged.  Then the shingles that
occur in several components are counted for each class: a pair across components has no others
in common, so a class with too few of them has no link to find, and in a bucket only those
pairs meet that have enough for their sizes, whose sketches allow it and that share no earlier
bucket.  So no link between components is left out, and few pairs are tested in vain.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from topicpulse.llm.common import SENT, cut, map_rows, small
from topicpulse.operators.lineage import Stages, settings

BANDS, ROWS = 30, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
SKETCH_WORDS = SKETCH_BITS // 64
SIMILARITY_PERCENT = 80
SHINGLE_WORDS = 2
# Representatives a class is compared with, the most promising first.
COMPARED = 2
WORDS_HELD = 300_000


def _sketch_limit(percent: int) -> int:
    """Differing bits that a pair at the least similarity exceeds with a chance of 1e-6."""
    similarity = percent / 100
    differing = 2 * SAMPLES * (1 - similarity)
    spread = 2 * math.sqrt(SAMPLES * similarity * (1 - similarity))
    ones = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (differing + 4.8 * spread))
    return math.ceil(ones + 4)


SKETCH_LIMIT = _sketch_limit(SIMILARITY_PERCENT)


class Shingler:
    """Texts to sets of shingles of so many words, samples and sketches."""

    def __init__(self, words: int = SHINGLE_WORDS):
        import numpy as np
        import xxhash

        self.np, self.words = np, words
        self.digest = xxhash.xxh3_64_intdigest
        self.wide = xxhash.xxh3_128_intdigest
        self.held: dict[bytes, int] = {}
        draw = np.random.RandomState(20240229)
        high, low = (draw.randint(0, 1 << 32, SAMPLES, dtype=np.uint64) for _ in range(2))
        self.factors = (high << np.uint64(32) | low | np.uint64(1))[:, None]
        self.numbers = np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def _mix(self, x):
        np = self.np
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))

    def shingles(self, text: bytes | None):
        """Sorted hashes of the distinct shingles; one for a text of fewer words."""
        np, held = self.np, self.held
        # Of bytes, lower() changes A-Z only and split() knows the six characters only.
        words = (text or b"").lower().split()
        if len(held) > WORDS_HELD:
            held.clear()
        for word in set(words).difference(held):
            held[word] = self.digest(word)
        hashes = np.fromiter(map(held.__getitem__, words), np.uint64, len(words))
        length = min(self.words, len(hashes))
        many = len(hashes) - length + 1
        found = hashes[:many]
        for k in range(1, length):
            after = hashes[k : k + many]
            first = found * np.uint64(0xD6E8FEB86659FD93)
            found = self._mix(first ^ (after >> np.uint64(17)) ^ (after << np.uint64(47)))
        return np.unique(found)

    def samples(self, shingles):
        """The least hash of a set under each of the functions."""
        np = self.np
        least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
        for k in range(0, len(shingles), 4096):
            np.minimum(least, (self.factors * shingles[None, k : k + 4096]).min(1), out=least)
        return least

    def bands(self, samples):
        np = self.np
        keys = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
        for column in samples.reshape(BANDS, ROWS).T:
            keys = self._mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ column)
        return keys.view(np.int64)

    def sketch(self, samples):
        np = self.np
        bits = self._mix(samples ^ self.numbers) % np.uint64(SKETCH_BITS)
        parity = np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS) & 1
        return np.packbits(parity.astype(np.uint8)).view(np.int64)

    def set_key(self, shingles) -> tuple[int, int]:
        wide = self.wide(shingles.tobytes())
        low, high = wide & (1 << 64) - 1, wide >> 64
        return low - (1 << 63), high - (1 << 63)


def signatures(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_low, set_high, bands, sketch`` of every row.

    A text without words has no shingles, and neither bands nor a sketch.
    """

    def make() -> Callable[[pa.RecordBatch], dict]:
        shingler = Shingler(words)

        def apply(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in ("n_shingles", "set_low", "set_high", "bands", "sketch")}
            for value in batch.column(2):
                shingles = shingler.shingles(value.as_py())
                low, high = shingler.set_key(shingles)
                found = len(shingles) > 0
                samples = shingler.samples(shingles) if found else None
                out["n_shingles"].append(len(shingles))
                out["set_low"].append(low)
                out["set_high"].append(high)
                out["bands"].append(shingler.bands(samples) if found else None)
                out["sketch"].append(shingler.sketch(samples) if found else None)
            return {"doc_id": batch.column(0), "text_key": batch.column(1)} | out

        return apply

    text = F.col("text").cast("string")
    frame = docs.select(
        "doc_id", F.xxhash64(text).alias("text_key"), text.cast("binary").alias("_text")
    )
    kind = frame.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, text_key bigint, n_shingles bigint, set_low bigint, set_high bigint, "
        "bands array<bigint>, sketch array<bigint>"
    )
    return map_rows(frame, make, schema, "_text")


def shingle_sets(texts: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``cid, shingles`` of rows ``cid, _text``: sorted hashes."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        shingler = Shingler(words)

        def apply(batch: pa.RecordBatch) -> dict:
            import numpy as np

            sets = [shingler.shingles(v.as_py()).view(np.int64) for v in batch.column(1)]
            ends = np.cumsum([0] + [len(s) for s in sets])
            values = np.concatenate(sets) if sets else np.array([], np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
            return {"cid": batch.column(0), "shingles": lists.cast(pa.list_(pa.int64()))}

        return apply

    return map_rows(texts, make, "cid bigint, shingles array<bigint>", "_text")


def differing_bits(one: Column, other: Column) -> Column:
    bits = [F.bit_count(F.get(one, i).bitwiseXOR(F.get(other, i))) for i in range(SKETCH_WORDS)]
    total = bits[0]
    for b in bits[1:]:
        total = total + b
    return total


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of all nodes of the edges ``a, b``: the least node of their component.

    A round takes the least root among the neighbours and then the root of that root.  The
    rounds end when nothing changes any more.
    """
    # Tables of a round are written: a checkpoint keeps the sizes that Spark estimates for joins,
    # products that grow over the rounds to numbers of millions of digits on the driver.
    stages = Stages(edges.sparkSession)
    both = stages.keep(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    state = both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("a"), F.min("b")).alias("root")
    )
    total = None
    while True:
        offered = (
            both.join(state, both["b"] == state["node"])
            .groupBy("a")
            .agg(F.min("root").alias("offered"))
        )
        lower = state.join(offered, state["node"] == offered["a"], "left").select(
            "node", F.least("root", F.coalesce("offered", "root")).alias("root")
        )
        above = lower.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        state = stages.keep(
            lower.join(above, lower["root"] == above["_node"]).select(
                "node", F.least("root", "_root").alias("root")
            )
        )
        now = state.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
        if now == total or now is None:
            state = cut(state)
            stages.release()
            return state
        total = now


class Linker:
    """The rounds over the classes of one table."""

    def __init__(self, docs: DataFrame, classes: DataFrame, percent: int, words: int):
        self.percent = percent
        entries = classes.select("cid", F.posexplode("bands").alias("band", "key"))
        shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        found = cut(entries.join(shared, "key").select("key", "band", "cid", "n"))
        self.nodes = cut(found.groupBy("cid").agg(F.sum("n").alias("central")))
        self.size = self.nodes.count()
        self.members = found.select("key", "band", "cid")
        held = classes.join(small(self.nodes.select("cid"), self.size), "cid", "left_semi")
        self.sketches = cut(held.select("cid", "sketch", "bands"))
        self.tested: DataFrame | None = None
        picked = held.select("cid", "pick.doc_id", "pick.text_key").select(
            "cid", F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key")
        )
        text = F.col("text").cast("string")
        texts = docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("_text"))
        same = texts["doc_id"].eqNullSafe(picked["_doc_id"]) & (
            texts["text_key"] == picked["_text_key"]
        )
        chosen = texts.join(small(picked, self.size), same).select(
            "cid", F.col("_text").cast("binary").alias("_text")
        )
        # Rows that repeat in id and text give a set several times.
        with settings(docs.sparkSession, SENT):
            self.sets = cut(shingle_sets(chosen, words).dropDuplicates(["cid"]))
        self.roots = cut(self.nodes.select("cid", F.col("cid").alias("root")))

    def placed(self) -> DataFrame:
        """``key, band, cid, root`` in buckets that hold several components."""
        rooted = self.members.join(self.roots, "cid").select("key", "band", "cid", "root")
        mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        mixed = mixed.filter("low < high").select("key")
        return cut(rooted.join(mixed, "key"))

    def star(self) -> DataFrame:
        """``a, b``: each member with the representatives of its bucket."""
        central = self.members.join(self.nodes, "cid")
        random = F.struct(F.xxhash64("cid", "key").alias("o"), "cid")
        chosen = central.groupBy("key").agg(
            F.min(random).alias("random"), F.max(F.struct("central", "cid")).alias("best")
        )
        chosen = chosen.select("key", F.explode(F.array("random.cid", "best.cid")).alias("rep"))
        paired = self.members.join(chosen, "key").filter("cid <> rep")
        return paired.select(F.col("cid").alias("a"), F.col("rep").alias("b")).distinct()

    def outer_shingles(self, placed: DataFrame) -> DataFrame:
        """``cid, n_shingles, outer``: how many shingles occur in other components too."""
        rooted = placed.select("cid", "root").distinct().join(self.sets, "cid")
        listed = rooted.select("cid", "root", F.explode("shingles").alias("shingle"))
        across = listed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        shared = across.filter("lo < hi").select("shingle")
        outer = listed.join(shared, "shingle").groupBy("cid").agg(F.count(F.lit(1)).alias("outer"))
        sizes = rooted.select("cid", F.size("shingles").alias("n_shingles"))
        return sizes.join(outer, "cid")

    def across(self, placed: DataFrame) -> DataFrame:
        """``a, b``: pairs across the components of a bucket that the sketches allow.

        Those in the largest component of a bucket don't meet each other, and a pair comes
        from the first of the bands it shares.  Both bring half of the bits of their shingles,
        so that the join gives pairs that are links, but for equal halves of unequal shingles:
        near copies just below the least similarity are many pairs and few links.
        """
        counts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
        major = counts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("m"))
        enough = self.outer_shingles(placed)
        # With J = percent / 100, common shingles are at least J of either set.
        possible = cut(enough.filter(100 * F.col("outer") >= self.percent * F.col("n_shingles")))
        halves = F.transform("shingles", lambda x: F.shiftright(x, 32).cast("int"))
        short = self.sets.join(possible.select("cid"), "cid", "left_semi").select(
            "cid", halves.alias("short"), (F.size("shingles") - F.size(F.array_distinct(halves))).alias("lost")
        )
        held = placed.join(possible, "cid").join(self.sketches, "cid").join(cut(short), "cid")
        outside = held.join(major.select("key", F.col("m.root").alias("major")), "key")
        outside = outside.filter("root <> major").select(
            F.col("key").alias("_key"), F.col("cid").alias("a"), F.col("root").alias("_root"),
            "major", F.col("sketch").alias("_sketch"), F.col("bands").alias("_bands"),
            F.col("outer").alias("_outer"), F.col("n_shingles").alias("_n"), F.col("short").alias("_short"),
        )
        # ... and at least J / (1 + J) of the sum of both sizes.
        fewer = F.least("outer", "_outer") * (100 + self.percent)
        fits = fewer >= self.percent * (F.col("n_shingles") + F.col("_n"))
        # Two outside the largest component meet from both sides; one is enough.
        once = (F.col("root") == F.col("major")) | (F.col("a") < F.col("cid"))
        near = differing_bits(F.col("sketch"), F.col("_sketch")) <= SKETCH_LIMIT
        earlier = F.zip_with(
            F.slice("bands", F.lit(1), F.col("band")),
            F.slice("_bands", F.lit(1), F.col("band")),
            lambda x, y: x == y,
        )
        first = ~F.exists(earlier, lambda same: same)
        differ = F.col("root") != F.col("_root")
        # Shingles of one set with equal halves count once, so they are added: no link is lost.
        common = F.size(F.array_intersect("short", "_short")) + F.col("lost")
        linked = common * (100 + self.percent) >= self.percent * (F.col("n_shingles") + F.col("_n"))
        paired = held.join(
            outside, (F.col("key") == F.col("_key")) & differ & once & fits & near & first & linked
        )
        return paired.select("a", F.col("cid").alias("b"))

    def untested(self, pairs: DataFrame) -> DataFrame:
        """``a, b`` of the pairs that weren't tested yet."""
        if self.tested is None:
            return pairs
        ordered = pairs.select("a", "b", F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        return ordered.join(self.tested, ["x", "y"], "left_anti").select("a", "b")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """``a, b, bits`` of the pairs that the sketches allow and that weren't tested yet."""
        one = self.sketches.select(F.col("cid").alias("a"), F.col("sketch").alias("sa"))
        other = self.sketches.select(F.col("cid").alias("b"), F.col("sketch").alias("sb"))
        both = self.untested(pairs).join(small(one, self.size), "a")
        both = both.join(small(other, self.size), "b")
        bits = differing_bits(F.col("sa"), F.col("sb")).alias("bits")
        return both.select("a", "b", bits).filter(F.col("bits") <= SKETCH_LIMIT)

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` whose sets are similar enough; remembers what was tested."""
        pairs = cut(pairs.select("a", "b"))
        new = pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        self.tested = new if self.tested is None else cut(self.tested.union(new))
        one = self.sets.select(F.col("cid").alias("a"), F.col("shingles").alias("va"))
        other = self.sets.select(F.col("cid").alias("b"), F.col("shingles").alias("vb"))
        joined = pairs.join(one, "a").join(other, "b")
        common = F.size(F.array_intersect("va", "vb"))
        counted = joined.select(
            "a", "b", common.alias("common"), (F.size("va") + F.size("vb")).alias("sum")
        )
        return cut(
            counted.filter(100 * F.col("common") >= self.percent * (F.col("sum") - F.col("common")))
            .select("a", "b")
        )

    def merge(self, links: DataFrame) -> None:
        """Join the components that the links connect."""
        ra = self.roots.select(F.col("cid").alias("a"), F.col("root").alias("ra"))
        rb = self.roots.select(F.col("cid").alias("b"), F.col("root").alias("rb"))
        edges = links.join(ra, "a").join(rb, "b").filter("ra <> rb")
        edges = cut(edges.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
        if edges.isEmpty():
            return
        moved = connected(edges).withColumnRenamed("root", "_root")
        self.roots = cut(
            self.roots.join(moved, self.roots["root"] == moved["node"], "left").select(
                "cid", F.coalesce("_root", "root").alias("root")
            )
        )

    def run(self) -> DataFrame:
        """``cid, root`` of the classes that share a bucket with others."""
        if not self.size:
            return self.roots
        # A class has two representatives for each of its bands at most.
        order = Window.partitionBy("a").orderBy("bits", "b")
        best = self.estimated(self.star()).withColumn("place", F.row_number().over(order))
        self.merge(self.confirm(best.filter(F.col("place") <= COMPARED)))
        placed = self.placed()
        if not placed.isEmpty():
            self.merge(self.confirm(self.untested(self.across(placed))))
        return self.roots


def components(
    docs: DataFrame, percent: int = SIMILARITY_PERCENT, words: int = SHINGLE_WORDS
) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` of every row of ``docs``.

    ``component_id`` is the least id reachable over links, the row's own included; null ids
    are never the least unless there is no other.  ``kept`` says whether it is the row's own
    id, so rows that repeat a kept id are all kept.  A row without words is linked with
    nothing, not even with its like.  Other columns are not looked at.
    """
    with settings(docs.sparkSession, SENT):
        signed = cut(signatures(docs, words))
    grouped = (
        signed.filter("n_shingles > 0")
        .groupBy("set_low", "set_high")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "text_key")).alias("pick"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
    )
    classes = cut(grouped.withColumn("cid", F.monotonically_increasing_id()))
    roots = Linker(docs, classes, percent, words).run()
    rooted = classes.select("cid", "set_low", "set_high", "least").join(roots, "cid", "left")
    rooted = cut(rooted.select("set_low", "set_high", "least", F.coalesce("root", "cid").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("set_low", "set_high", "component_id")
    named = named.withColumnsRenamed({"set_low": "_low", "set_high": "_high"})
    worded = signed.select("doc_id", "text_key", "n_shingles", "set_low", "set_high").join(
        named,
        (F.col("set_low") == F.col("_low"))
        & (F.col("set_high") == F.col("_high"))
        & (F.col("n_shingles") > 0),
        "left",
    )
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return worded.select("doc_id", "text_key", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one(
    docs: DataFrame, percent: int = SIMILARITY_PERCENT, words: int = SHINGLE_WORDS
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    dropped = components(docs, percent, words).filter(~F.col("kept")).select("doc_id", "text_key")
    dropped = cut(dropped.distinct()).toDF("_dropped_id", "_dropped_key")
    dropped = small(dropped, dropped.count())
    key = F.xxhash64(docs["text"].cast("string"))
    same = docs["doc_id"].eqNullSafe(dropped["_dropped_id"]) & (key == dropped["_dropped_key"])
    return docs.join(dropped, same, "left_anti")
