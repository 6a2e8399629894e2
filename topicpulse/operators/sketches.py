"""Closeness of large graphs by one mergeable sketch for each node.

The sketch (HyperLogLog) of a node holds the nodes that reach it so far.  A round unites it with
those of the nodes that link to it, so after t rounds its estimate is how many nodes are at most
t links away; what a round adds is at distance t.  A node that a round left as it was isn't
sent on, and the rounds end when no estimate grows.

The state is ``n`` sketches of at most ``2 ** lg_k`` bytes, where exact closeness keeps a bit for
each pair of nodes.  The relative standard error of a count is about ``1.04 / sqrt(2 ** lg_k)``,
1.6 % by default; sketches of a few hundred nodes hold them singly and count without error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicpulse.operators.graph import TopicGraph, on_grid, named, reversed_both_ways, topic_graph
from topicpulse.operators.lineage import Stages, cut, fixed_layout, partitions_for
from topicpulse.operators.paths import closeness_value
from topicpulse.operators.skew import SLOT, slot_count

LG_K = 12
# Sketches and links that a task handles.
ROWS_PER_PARTITION = 50_000


def sketched_sums(graph: TopicGraph, outward: bool = False, lg_k: int = LG_K) -> DataFrame:
    """Sparse ``Category, id, reached, distance`` as ``reach_sums`` has them, estimated."""
    spark = graph.links.sparkSession
    stages = Stages(spark)
    links = graph.links.filter(F.col("src") != F.col("dst"))
    ends = ["dst", "src", "dst_in"] if outward else ["src", "dst", "src_out"]
    # A node that many link to, or that links to many, has its sketch sent once for each slot.
    slots = slot_count(F.col(ends[2]), graph.heavy_rows)
    slot = F.pmod(F.xxhash64(ends[1]), slots).cast("int").alias(SLOT)
    partitions = partitions_for(graph.edge_count, ROWS_PER_PARTITION, least=8)
    with fixed_layout(spark, partitions):
        table = links.select(
            F.col(ends[0]).alias("node"), slot, F.col(ends[1]).alias("to"), slots.alias("slots")
        )
        table = cut(table.repartition("node", SLOT))
        spread = table.groupBy("node").agg(F.max("slots").alias("slots"))
        nodes = table.select("node").union(table.select("to")).distinct()
        own = nodes.groupBy("node").agg(F.hll_sketch_agg("node", F.lit(lg_k)).alias("sketch"))
        state = stages.keep(
            own.join(spread, "node", "left").select(
                "node",
                "slots",
                "sketch",
                F.lit(1).cast("bigint").alias("held"),
                F.lit(0).cast("bigint").alias("distance"),
                F.lit(True).alias("new"),
            )
        )
        level = 0
        while not state.filter("new").isEmpty():
            level += 1
            state = stages.keep(_united(state, table, level))
        sums = state.select(F.col("node").alias("key"), (F.col("held") - 1).alias("reached"), "distance")
        total = cut(sums.filter("reached > 0"))
    stages.release()
    return named(graph, total)


def _united(state: DataFrame, table: DataFrame, level: int) -> DataFrame:
    """The state after one more level."""
    leaving = state.filter("new AND slots IS NOT NULL").select(
        "node", "sketch", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias(SLOT)
    )
    came = leaving.join(table, ["node", SLOT]).select(F.col("to").alias("node"), "sketch")
    came = came.groupBy("node").agg(F.hll_union_agg("sketch").alias("came"))
    united = F.when(F.col("came").isNull(), F.col("sketch")).otherwise(F.hll_union("sketch", "came"))
    joined = state.join(came, "node", "left").withColumn("united", united)
    # An estimate never falls, though that of a union may by a rounding.
    now = F.greatest(F.col("held"), F.hll_sketch_estimate("united"))
    return joined.withColumn("now", now).select(
        "node",
        "slots",
        F.col("united").alias("sketch"),
        F.col("now").alias("held"),
        (F.col("distance") + level * (F.col("now") - F.col("held"))).alias("distance"),
        (F.col("now") > F.col("held")).alias("new"),
    )


def closeness_sketched(
    graph: TopicGraph, direction: str = "in", wasserman_faust: bool = False, lg_k: int = LG_K
) -> DataFrame:
    """Closeness as ``paths.closeness`` defines it, with counts estimated by sketches."""
    if direction not in ("in", "out", "both"):
        raise ValueError(f"direction must be 'in', 'out' or 'both', not {direction!r}")
    searched = graph
    if direction == "both":
        searched = topic_graph(reversed_both_ways(graph.edges), graph.heavy_rows)
    sums = sketched_sums(searched, direction == "out", lg_k)
    node_count = graph.nodes.count() if wasserman_faust else 0
    value = closeness_value(node_count, wasserman_faust).alias("closeness")
    return on_grid(graph, sums.select("Category", "id", value), "closeness")
