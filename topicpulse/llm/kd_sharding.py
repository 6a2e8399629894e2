"""Shards of near equal bytes by a k-d tree over document metadata.

Documents of equal text are one point: their bytes together, and of each metadata column the
least value.  A node of the tree is split at the weighted median of the column that is widest
in it, until every leaf holds the target bytes.  No point is divided, so equal texts share a
shard.

All medians of a level are found together and without moving points: the values of a column
are whole numbers, spread over a fixed range, with a hash of the text in the low bits that
orders equal values.  A pass adds up the bytes of each node in buckets of the interval that
still holds its median and goes on with the one bucket in which it lies.  What the driver sees
of a pass is nodes x buckets sums.

All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from topicpulse.llm.common import cut

# A value has VALUE_BITS of the column and TIE_BITS of the hash.
VALUE_BITS = 31
TIE_BITS = 31
BUCKET_BITS = 10
# A split is good enough if it misses its share by less than this part of the node's bytes.
TOLERANCE = 1e-4
ROWS_PER_SLOT_BUCKET = 20_000


def _number(column: Column, kind: str) -> Column:
    """A column as a number that keeps the order: text by its first seven bytes."""
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(column, 1, 7)), 14, "0"), 16, 10).cast("double")
    return column.cast("double")


def points_of(docs: DataFrame, dims: list[str]) -> DataFrame:
    """One row for each text: ``key, bytes, tie`` and ``d0, d1, ...`` scaled to whole numbers."""
    kinds = dict(docs.dtypes)
    rows = docs.select(
        F.col("_key").alias("key"),
        F.col("_size").alias("bytes"),
        *[_number(F.col(d), kinds[d]).alias(f"d{i}") for i, d in enumerate(dims)],
    )
    names = [f"d{i}" for i in range(len(dims))]
    least = [F.min(d).alias(d) for d in names]
    points = cut(rows.groupBy("key").agg(F.sum("bytes").alias("bytes"), *least))
    bounds = points.agg(*[f(d).alias(f"{d}_{f.__name__}") for d in names for f in (F.min, F.max)])
    row = bounds.first()
    top = (1 << VALUE_BITS) - 1

    def scaled(d: str) -> Column:
        low, high = row[f"{d}_min"], row[f"{d}_max"]
        if low is None or high <= low:
            return F.lit(0).cast("long")
        share = (F.coalesce(F.col(d), F.lit(low)) - F.lit(low)) / F.lit(high - low)
        return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * top).cast("long")

    tie = F.shiftrightunsigned(F.xxhash64("key"), 64 - TIE_BITS)
    return points.select("key", "bytes", tie.alias("tie"), *[scaled(d).alias(d) for d in names])


def _by_node(nodes: dict, value_of, missing) -> Column:
    """A value that depends on the node."""
    value = missing
    for node, held in nodes.items():
        value = F.when(F.col("node") == node, F.lit(value_of(held))).otherwise(value)
    return value


def build_tree(points: DataFrame, n_dims: int, leaves: int) -> list[dict]:
    """The splits, level by level: ``node, dim, at, left, right``; values over ``at`` go right.

    Nodes are numbered as in a heap, from 1.  A node that is to have L leaves gives L // 2 of
    them, and that share of its bytes, to the left.
    """
    splits: list[dict] = []
    open_nodes = {1: leaves}
    while any(n > 1 for n in open_nodes.values()):
        placed = points.withColumn("node", node_column(splits))
        widths = placed.groupBy("node").agg(
            F.sum("bytes").alias("bytes"),
            *[(F.max(f"d{i}") - F.min(f"d{i}")).alias(f"w{i}") for i in range(n_dims)],
        )
        found = {r["node"]: r for r in widths.collect() if open_nodes.get(r["node"], 1) > 1}
        searched = {}
        for node, r in found.items():
            dim = max(range(n_dims), key=lambda i: (r[f"w{i}"], -i))
            share = open_nodes[node] // 2 / open_nodes[node]
            searched[node] = {
                "dim": dim, "low": 0, "shift": VALUE_BITS + TIE_BITS, "below": 0,
                "want": r["bytes"] * share, "bytes": r["bytes"],
            }
        medians = _medians(placed, searched, n_dims)
        following = {}
        for node, n in open_nodes.items():
            if n < 2 or node not in medians:
                continue
            splits.append({"node": node, "dim": searched[node]["dim"], "at": medians[node]})
            following[2 * node], following[2 * node + 1] = n // 2, n - n // 2
        open_nodes = following
    return splits


def _value(dim: Column, n_dims: int) -> Column:
    """The value of a point along a dimension, ties ordered by the hash."""
    value = F.lit(None).cast("long")
    for i in reversed(range(n_dims)):
        value = F.when(dim == i, F.col(f"d{i}")).otherwise(value)
    return F.shiftleft(value, TIE_BITS).bitwiseOR(F.col("tie"))


def _medians(placed: DataFrame, searched: dict[int, dict], n_dims: int) -> dict[int, int]:
    """The largest value that goes left, for each node searched."""
    done: dict[int, int] = {}
    while len(done) < len(searched):
        active = {n: s for n, s in searched.items() if n not in done}
        none = F.lit(None).cast("long")
        valued = placed.filter(F.col("node").isin(*active)).select(
            "node",
            "bytes",
            _value(_by_node(active, lambda s: s["dim"], F.lit(-1)), n_dims).alias("value"),
            _by_node(active, lambda s: s["low"], none).cast("long").alias("low"),
            _by_node(active, lambda s: s["shift"], F.lit(0)).alias("shift"),
        )
        inside = valued.filter(
            (F.col("value") >= F.col("low"))
            & (F.col("value") - F.col("low") < F.expr("shiftleft(1L, shift)"))
        )
        bucket = F.expr(f"shiftright(value - low, greatest(0, shift - {BUCKET_BITS}))")
        sums = (
            inside.select("node", "bytes", bucket.alias("bucket"))
            .groupBy("node", "bucket")
            .agg(F.sum("bytes").alias("bytes"))
            .collect()
        )
        for node, s in active.items():
            width = max(0, s["shift"] - BUCKET_BITS)
            below = s["below"]
            best = None
            for bucket, size in sorted((r["bucket"], r["bytes"]) for r in sums if r["node"] == node):
                if below + size >= s["want"]:
                    best = (bucket, size)
                    break
                below += size
            if best is None:
                done[node] = s["low"] + (1 << s["shift"]) - 1
                continue
            bucket, size = best
            start = s["low"] + (bucket << width)
            over, under = below + size - s["want"], s["want"] - below
            fits = min(over, under) <= TOLERANCE * s["bytes"]
            if width == 0 or fits:
                done[node] = start + (1 << width) - 1 if over <= under else start - 1
            else:
                s.update(low=start, shift=width, below=below)
    return done


def node_column(splits: list[dict]) -> Column:
    """The node of a point below all splits."""
    node = F.lit(1).cast("long")
    for split in splits:  # parents come before their children
        value = F.shiftleft(F.col(f"d{split['dim']}"), TIE_BITS).bitwiseOR(F.col("tie"))
        down = F.lit(2 * split["node"]) + F.when(value > split["at"], 1).otherwise(0)
        node = F.when(node == split["node"], down.cast("long")).otherwise(node)
    return node


def leaf_numbers(splits: list[dict], leaves: int) -> dict[int, int]:
    """Shard numbers of the leaves, from left to right."""
    inner = {s["node"] for s in splits}
    order: list[int] = []

    def walk(node: int) -> None:
        if node in inner:
            walk(2 * node)
            walk(2 * node + 1)
        else:
            order.append(node)

    walk(1)
    return {node: shard for shard, node in enumerate(order)}


def gapless_slots(rows: DataFrame, group: str, order: list[str], count: int) -> DataFrame:
    """``rows`` with ``slot``, numbers from 0 without gaps in each group.

    A group is numbered in buckets of bounded size, each from where those before it end.
    """
    buckets = max(1, -(-count // ROWS_PER_SLOT_BUCKET))
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = placed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    offsets = sizes.select(group, "_bucket", offset)
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    numbered = placed.withColumn("_at", F.row_number().over(inside) - 1)
    return numbered.join(offsets, [group, "_bucket"]).select(
        *rows.columns, (F.col("_offset") + F.col("_at")).cast("long").alias("slot")
    )


def shard(
    docs: DataFrame,
    dims: tuple[str, ...] = ("source", "lang", "doc_id", "n_chars"),
    leaves: int = 8,
    target_bytes: int | None = None,
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes and 1; with ``target_bytes`` the number of leaves
    follows from their sum.  Rows of equal text are in one shard, null texts count as one text
    unlike the empty one, null metadata as the least.  The law is ``bytes``: shards differ by
    the tolerance of the splits and by the largest group of equal texts.  A tree can't grow by
    one shard without moving rows, so ``grown_shard`` is null.
    """
    text = F.col("text").cast("string")
    kinds = dict(docs.dtypes)
    dims = tuple(d for d in dims if d in kinds)
    rows = cut(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("_size"),
            F.crc32(text).alias("_crc"),
            F.unhex(F.sha2(F.coalesce(F.concat(F.lit("t"), text), F.lit("")), 256)).alias("_key"),
            *[F.col(d) for d in dims if d != "doc_id"],
        )
    )
    points = cut(points_of(rows, list(dims)))
    totals = points.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    if target_bytes:
        leaves = max(1, -(-(totals[0] or 0) // target_bytes))
    splits = build_tree(points, len(dims), leaves)
    numbers = leaf_numbers(splits, leaves)
    placed = points.select(F.col("key").alias("_key"), node_column(splits).alias("node")).select(
        "_key", _by_node(numbers, lambda shard: shard, F.lit(0)).cast("int").alias("shard")
    )
    out = rows.select("doc_id", "_size", "_crc", "_key").join(placed, "_key")
    out = cut(out.drop("_key"))
    return gapless_slots(out, "shard", ["doc_id", "_crc", "_size"], out.count()).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.coalesce("_crc", F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
