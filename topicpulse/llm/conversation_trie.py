"""The trie of conversation prefixes, and subtree totals by parallel tree contraction.

A turn gets its place in its conversation without one task seeing a whole conversation: the
turns are sorted over all partitions, and the places before a partition are added up from one
row for each conversation in a partition.  The key of a prefix is the sum of 128 hashed bits of
its turns and their places, in chunks of bounded length, so equal prefixes have equal keys.

Totals of subtrees come from contraction, in rounds that bring together what
meets at the key of a node:

* *Rake*: a leaf is finished.  It is taken out, and what it holds is added to its parent.
* *Compress*: of a chain of nodes with one child each, those that come before their neighbours
  in an order by the last set bit of the depth are taken out.  The child moves up to the
  grandparent with what the node between held, and the node is written down with its child.

A chain loses half of its nodes in a round, so the rounds follow the logarithm of the number of
nodes, however deep the trie is.  Then the rounds are gone through backwards: the total of a
compressed node is what was written down plus the total of its child.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from topicpulse.llm.common import cut
from topicpulse.operators.lineage import partitions_for
from topicpulse.operators.skew import HEAVY_ROWS, heaviest, salted_join

# A conversation shares its first turns with the one whose id is its own less the remainder by
# FAMILY: so many as the CRC-32 of its id leaves by HEADS.
FAMILY, HEADS = 5, 9
# Turns of a conversation whose hashes are added up in one window.
CHUNK = 1024
# Characters of a list of ids that are hashed as one row.
IDS = 1 << 16

# Rows of a task in the tables of the rounds: their partitions follow the data.
ROWS_PER_PARTITION = 200_000

KEY, UP = ["k1", "k2"], ["p1", "p2"]
TOTALS = ["leaves", "saved"]
# What a node gets from several children in a round.
SUMMED = ["children", *[f"g_{t}" for t in TOTALS]]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, i, t1, t2, bytes``: each turn with its place from 1 and hashes of its content.

    Turns come in the order of ``turn``, null first, and then of role and text; equal rows are
    turns of their own.  Null roles and texts are empty.  Rows without ``conv_id`` belong to no
    conversation and are left out.
    """
    told = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    # Equal rows may lie in several partitions: which of them comes first makes no difference.
    spread = told.withColumn("_any", F.xxhash64(F.monotonically_increasing_id()))
    placed = spread.repartitionByRange(*order, "_any").sortWithinPartitions(*order)
    # The id grows along the sorted partitions, by one within each of them.
    rows = cut(
        placed.select(
            "conv_id",
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64("role", "text").alias("t1"),
            F.xxhash64(F.lit(1), "role", "text").alias("t2"),
            F.octet_length("text").cast("bigint").alias("bytes"),
        ).withColumn("part", F.shiftright("at", 33))
    )
    groups = rows.groupBy("conv_id", "part").agg(
        F.min("at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    starts = groups.select("conv_id", "part", before.alias("_from"))
    return rows.join(starts, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") + F.col("_from")).alias("i"), "t1", "t2", "bytes"
    )


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns ``conv_id, pos, t1, t2, bytes`` of the rebuilt conversations, and their lengths.

    Lengths are ``conv_id, length``, a row for each conversation; ``length`` may be 0.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    of = F.col("conv_id") - F.col("conv_id") % FAMILY
    mine = sizes.select("conv_id", "n", of.alias("head"), shared_turns(F.col("conv_id")).alias("h"))
    theirs = sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("_theirs"))
    given = F.least("h", F.coalesce("_theirs", F.lit(0)))
    known = cut(
        mine.join(theirs, "head", "left").select(
            "conv_id", "head", "h", given.alias("given"), (given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
        )
    )
    heads = turns.filter(F.col("i") < HEADS).withColumnRenamed("conv_id", "head")
    first = known.select("conv_id", "head", "given").join(heads, "head").filter("i <= given")
    own = turns.join(known.select("conv_id", "h", "given"), "conv_id").filter("i > h")
    columns = ["t1", "t2", "bytes"]
    rows = first.select("conv_id", F.col("i").alias("pos"), *columns).unionByName(
        own.select("conv_id", (F.col("given") + F.col("i") - F.col("h")).alias("pos"), *columns)
    )
    return rows, known.select("conv_id", "length")


def _halves(t: str, name: str) -> list[Column]:
    mixed = F.xxhash64("pos", t)
    low = F.lit(0xFFFFFFFF).cast("bigint")
    return [
        F.shiftrightunsigned(mixed, 32).alias(f"{name}h"),
        mixed.bitwiseAND(low).alias(f"{name}l"),
    ]


def _joined(high: Column, low: Column) -> Column:
    mask = F.lit(0xFFFFFFFF).cast("bigint")
    return F.shiftleft(high.bitwiseAND(mask), 32).bitwiseOR(low.bitwiseAND(mask))


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id, pos, k1, k2, p1, p2, bytes``: the key of each prefix and of the one before.

    The empty prefix has the keys 0, 0.  Sums of 32 bits don't overflow below 2 ** 31 turns.
    """
    parts = ["ah", "al", "bh", "bl"]
    chunk = F.floor((F.col("pos") - 1) / CHUNK).cast("bigint").alias("chunk")
    hashed = rows.select("conv_id", "pos", chunk, "bytes", *_halves("t1", "a"), *_halves("t2", "b"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = hashed.withColumns({f"s_{c}": F.sum(c).over(inside) for c in parts})
    sums = hashed.groupBy("conv_id", "chunk").agg(*[F.sum(c).alias(c) for c in parts])
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "conv_id", "chunk", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"e_{c}") for c in parts]
    )
    whole = local.join(before, ["conv_id", "chunk"])
    up_to = {c: F.col(f"s_{c}") + F.col(f"e_{c}") for c in parts}
    until = {c: up_to[c] - F.col(c) for c in parts}
    return whole.select(
        "conv_id",
        "pos",
        _joined(up_to["ah"], up_to["al"]).alias("k1"),
        _joined(up_to["bh"], up_to["bl"]).alias("k2"),
        _joined(until["ah"], until["al"]).alias("p1"),
        _joined(until["bh"], until["bl"]).alias("p2"),
        "bytes",
    )


def _text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``k1, k2, conv_id`` to ``k1, k2, at, ids`` of bounded length."""
    key, at, ids, size = None, 0, [], 0
    for batch in batches:
        out = []
        for k1, k2, conv in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv_id"))):
            if (k1, k2) != key or size > IDS:
                if ids:
                    out.append((*key, at, ",".join(ids)))
                key, at, ids, size = (k1, k2), conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield _batch(out, _TEXT)
    yield _batch([(*key, at, ",".join(ids))] if ids else [], _TEXT)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``k1, k2, at, ids`` to ``k1, k2, ends_sha256``."""
    key, running = None, None
    for batch in batches:
        out = []
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
            if (k1, k2) != key:
                if key:
                    out.append((*key, running.hexdigest()))
                key, running = (k1, k2), hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield _batch(out, _HASH)
    yield _batch([(*key, running.hexdigest())] if key else [], _HASH)


_TEXT = {"k1": pa.int64(), "k2": pa.int64(), "at": pa.int64(), "ids": pa.string()}
_HASH = {"k1": pa.int64(), "k2": pa.int64(), "ends_sha256": pa.string()}


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(types)
    arrays = [pa.array(list(c), type=t) for c, t in zip(columns, types.values())]
    return pa.RecordBatch.from_arrays(arrays, names=list(types))


def end_hashes(ends: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256`` of the ids ``conv_id`` at each key, ascending, joined by commas.

    Ids are sorted over all partitions and joined to texts there; only the texts of a key meet
    in one task, which reads them one after another.
    """
    spread = ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id")
    texts = spread.sortWithinPartitions(*KEY, "conv_id").mapInArrow(
        _text_blocks, "k1 bigint, k2 bigint, at bigint, ids string"
    )
    placed = texts.repartition(*KEY).sortWithinPartitions(*KEY, "at")
    return placed.mapInArrow(_hashes, "k1 bigint, k2 bigint, ends_sha256 string")


def _order(depth: str) -> Column:
    """The last set bit of the depth, then the depth: neighbours of a chain always differ."""
    d = F.col(depth)
    return F.struct(d.bitwiseAND(-d), d)


def _by_key(rows: list[DataFrame]) -> DataFrame:
    """Rows of several tables that meet at a node: one row of what each of them has for it.

    A sum and a group, and no join: what a common prefix is told by very many children is
    reduced before it moves.
    """
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    values = [c for c in both.columns if c not in KEY]
    found = both.groupBy(*KEY).agg(*[(F.sum if c in SUMMED else F.max)(c).alias(c) for c in values])
    return found


def _keyed(frame: DataFrame, key: list[str], **values: Column) -> DataFrame:
    """Messages to the nodes whose key is in the columns ``key``."""
    named = [F.col(c).alias(k) for c, k in zip(key, KEY)]
    return frame.select(*named, *[v.alias(c) for c, v in values.items()])


def _contract(live: DataFrame, parts: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: the nodes that stay, the raked ones, and the compressed ones with their child.

    ``live`` is ``k1, k2, p1, p2, depth`` with ``leaves, saved``, what a node holds so far, and
    ``up_leaves, up_saved``, what compressed nodes between it and its parent held.
    """
    one = F.lit(1).cast("bigint")
    child = F.struct(*KEY, F.col("depth"), *[f"up_{t}" for t in TOTALS])
    to_parent = _keyed(live.filter("depth > 0"), UP, children=one, child=child)
    marked = cut(_by_key([live, to_parent]).coalesce(parts))
    raked = marked.filter("depth > 0 AND children IS NULL")
    alone = (F.col("depth") > 0) & (F.col("children") == 1)
    # A node of a chain hears of its parent, if that is in the chain too, and of its child.
    below = marked.filter(alone).select(F.col("child.k1").alias("b1"), F.col("child.k2").alias("b2"), "depth")
    from_parent = _keyed(below, ["b1", "b2"], a_depth=F.col("depth"))
    from_child = _keyed(marked.filter("depth > 0"), UP, grand=F.coalesce("children", F.lit(0)))
    known = cut(_by_key([marked, from_parent, from_child]).coalesce(parts))
    before = F.col("a_depth").isNull() | (_order("depth") < _order("a_depth"))
    after = (F.col("grand") > 1) | (_order("depth") < _order("child.depth"))
    # Its child is no leaf, as that is raked now.
    out = alone & (F.col("grand") > 0) & before & after
    packed = known.filter(out)
    given = {f"g_{t}": F.col(t) + F.col(f"up_{t}") for t in TOTALS}
    lifted = {f"l_{t}": F.col(t) + F.col(f"up_{t}") for t in TOTALS} | {"n1": F.col("p1"), "n2": F.col("p2")}
    moved = _by_key(
        [
            known.filter("depth = 0 OR children IS NOT NULL").filter(~out).select(*KEY, *UP, "depth", *TOTALS, *[f"up_{t}" for t in TOTALS]),
            _keyed(known.filter("depth > 0 AND children IS NULL"), UP, **given),
            _keyed(packed.withColumns({"b1": F.col("child.k1"), "b2": F.col("child.k2")}), ["b1", "b2"], **lifted),
        ]
    ).select(
        *KEY,
        *[F.coalesce(f"n{i}", f"p{i}").alias(f"p{i}") for i in (1, 2)],
        "depth",
        *[(F.col(t) + F.coalesce(f"g_{t}", F.lit(0))).alias(t) for t in TOTALS],
        *[(F.col(f"up_{t}") + F.coalesce(f"l_{t}", F.lit(0))).alias(f"up_{t}") for t in TOTALS],
    )
    kept = packed.select(
        *KEY,
        F.col("child.k1").alias("c1"),
        F.col("child.k2").alias("c2"),
        *[(F.col(t) + F.col(f"child.up_{t}")).alias(t) for t in TOTALS],
    )
    return cut(moved.coalesce(parts)), raked.select(*KEY, *TOTALS), kept


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """``k1, k2, leaves, saved`` of nodes ``k1, k2, p1, p2, depth, leaves, saved``, summed.

    ``p1, p2`` is the key of the parent, whose depth is less by one; the root has depth 0.
    """
    live = nodes.select(*KEY, *UP, F.col("depth").cast("bigint").alias("depth"), *TOTALS)
    live = cut(live.withColumns({f"up_{t}": F.lit(0).cast("bigint") for t in TOTALS}))
    parts = partitions_for(live.count(), ROWS_PER_PARTITION, least=8)
    done, packed = [], []
    while live.filter("depth > 0").limit(1).count():
        live, raked, chain = _contract(live, parts)
        done.append(raked)
        packed.append(chain)
    totals = live.select(*KEY, *TOTALS)
    for raked in done:
        totals = totals.unionByName(raked)
    totals = cut(totals.coalesce(parts))
    for chain in reversed(packed):
        # A node is the child of one compressed node in a round.
        parent = F.struct(*KEY, *TOTALS)
        met = _by_key([totals, _keyed(chain, ["c1", "c2"], parent=parent)]).filter("parent IS NOT NULL")
        found = met.select(
            *[F.col(f"parent.{k}").alias(k) for k in KEY],
            *[(F.col(t) + F.col(f"parent.{t}")).alias(t) for t in TOTALS],
        )
        totals = cut(totals.unionByName(found).coalesce(parts))
    return totals


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations, the empty one included.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent (null at the
    root), ``n_leaves`` and ``saved_tokens`` are sums over the subtree with the node itself.
    Columns other than ``conv_id, turn, role, text`` are not read.  Without a conversation
    there is no node, not even a root.
    """
    turns = cut(numbered_turns(conversations))
    parts = partitions_for(turns.count(), ROWS_PER_PARTITION, least=8)
    rows, lengths = rebuilt(turns.coalesce(parts))
    lengths = cut(lengths.coalesce(parts))
    steps = cut(prefixes(rows).coalesce(parts))
    zero = F.lit(0).cast("bigint")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    inner = steps.groupBy(*KEY, *UP, F.col("pos").alias("depth")).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes")
    )
    top = root.select(
        *[zero.alias(c) for c in (*KEY, *UP, "depth")], "conv_id", "n_convs", zero.alias("bytes")
    )
    plain = cut(inner.unionByName(top).coalesce(parts))
    counts = plain.filter("depth > 0").groupBy(*UP).agg(F.count(F.lit(1)).alias("n_children"))
    counts = cut(counts)
    below = counts.withColumnsRenamed({"p1": "k1", "p2": "k2"})
    nodes = cut(
        plain.join(below, KEY, "left").withColumns(
            {
                "n_children": F.coalesce("n_children", zero),
                "leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint"),
                "saved": (F.col("n_convs") - 1) * F.col("bytes"),
            }
        ).coalesce(parts)
    )
    totals = subtree_totals(nodes)
    at_end = steps.join(lengths, "conv_id").filter("pos = length").select(*KEY, "conv_id")
    none = lengths.filter("length = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id")
    ends = end_hashes(at_end.unionByName(none))
    full = nodes.drop(*TOTALS).join(totals, KEY).join(ends, KEY, "left")
    # A very common prefix is the parent of very many nodes; its row is repeated for the salts.
    parents = nodes.select(*[F.col(k).alias(p) for k, p in zip(KEY, UP)], F.col("conv_id").alias("parent_conv_id"))
    heavy = heaviest(counts, UP, "n_children", HEAVY_ROWS)
    inner = salted_join(full.filter("depth > 0"), parents, UP, "left", KEY, heavy)
    whole = inner.unionByName(full.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    return cut(
        whole.select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
