"""PageRank of all topic graphs at once.

``r0(v) = 1 - d`` and ``r(v) = (1 - d) + d * sum of r(u) / outdegree(u)`` over the links
``u -> v``.  Ranks are not normalised and dangling nodes pass nothing on.

Only the core of a graph has to be iterated.  A node without incoming links keeps the
rank ``1 - d`` for ever, so what it passes on is a constant of its targets, and a node
without outgoing links influences nobody, so its rank is needed once, at the end.

A round is one join and one aggregation.  The links stay partitioned by source, the
ranks come out of the aggregation partitioned by node, so only the partial sums of a
round are shuffled.  Sources with very many links are split into slots.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from topicpulse.operators.graph import (
    PAGERANK_DAMPING,
    PAGERANK_ROUNDS,
    TopicGraph,
    named,
    on_grid,
)
from topicpulse.operators.lineage import cut, fixed_layout, partitions_for
from topicpulse.operators.skew import SLOT, slot_count

# Links handled by one task of a round.
LINKS_PER_PARTITION = 1_000_000
# Rounds chained into one job before the ranks are written out.
ROUNDS_PER_CUT = 5


def pagerank_scores(
    graph: TopicGraph,
    rounds: int = PAGERANK_ROUNDS,
    damping: float = PAGERANK_DAMPING,
    tolerance: float | None = None,
) -> DataFrame:
    """Sparse ``Category, id, rank`` of the nodes with incoming links.

    All other nodes have the rank ``1 - damping``.  With ``tolerance`` the rounds stop
    early once no rank moved by more than that between two writes.
    """
    if rounds < 1:
        raise ValueError("at least one round is needed")
    start = 1.0 - damping
    weighted = graph.links.withColumn("weight", F.lit(damping) / F.col("src_out"))
    from_leaf = F.when(F.col("src_in") == 0, F.lit(start) * F.col("weight"))
    targets = cut(
        weighted.groupBy(F.col("dst").alias("key")).agg(
            (F.lit(start) + F.coalesce(F.sum(from_leaf), F.lit(0.0))).alias("base"),
            F.max("dst_out").alias("out_degree"),
        )
    )
    links = weighted.filter(F.col("src_in") > 0).select(
        "src",
        F.pmod(F.xxhash64("dst"), slot_count(F.col("src_out"), graph.heavy_rows))
        .cast("int")
        .alias(SLOT),
        F.col("dst").alias("key"),
        "weight",
        F.lit(0.0).alias("base"),
        F.col("dst_out").alias("out_degree"),
    )
    # A core node also links to itself with weight 0: that row brings in its constant
    # and keeps nodes whose other sources are all leaves.
    own = targets.select(
        F.col("key").alias("src"),
        F.lit(0).alias(SLOT),
        "key",
        F.lit(0.0).alias("weight"),
        "base",
        "out_degree",
    )
    split = graph.split_sources
    by_source = ["src", SLOT] if split else ["src"]
    # With split sources the ranks carry the number of slots they are needed in.
    slots = [slot_count(F.col("out_degree"), graph.heavy_rows).alias("slots")] if split else []
    into_core = F.col("out_degree") > 0
    partitions = partitions_for(graph.edge_count, LINKS_PER_PARTITION)
    with fixed_layout(graph.links.sparkSession, partitions):
        loop = (
            links.unionByName(own)
            .filter(into_core)
            .select(*by_source, "key", "weight", "base", *slots)
            .repartition(*by_source)
        )
        ranks = cut(
            targets.filter(into_core)
            .select("key", F.lit(start).alias("rank"), *slots)
            .repartition("key")
        )
        with _cached_view(loop) as view:
            ranks = _iterate(ranks, view, split, rounds - 1, tolerance)
        received = (
            _as_sources(ranks, by_source)
            .join(links.select(*by_source, "key", "weight"), by_source)
            .select("key", (F.col("rank") * F.col("weight")).alias("part"))
        )
        last = cut(
            received.unionByName(targets.select("key", F.col("base").alias("part")))
            .groupBy("key")
            .agg(F.sum("part").alias("rank"))
        )
    return named(graph, last)


@contextmanager
def _cached_view(frame: DataFrame) -> Iterator[str]:
    """Name of a view on the cached frame; dropping the view ends the caching too."""
    name = f"topicpulse_{uuid4().hex}"
    frame.persist().createOrReplaceTempView(name)
    try:
        yield name
    finally:
        frame.sparkSession.catalog.dropTempView(name)


def _as_sources(ranks: DataFrame, by_source: list[str]) -> DataFrame:
    sources = ranks.withColumnRenamed("key", "src")
    if SLOT in by_source:
        sources = sources.withColumn(SLOT, F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    return sources.select(*by_source, "rank")


def _rounds_sql(rounds: int, links: str, split: bool) -> str:
    """``rounds`` rounds on ``{ranks}`` and the view ``links`` as one statement.

    One statement is analysed once, which for small graphs is a good part of a round.
    """
    source, slots, on_slot = "{ranks}", "", ""
    if split:
        slots, on_slot = ", max(l.slots) AS slots", f" AND r.{SLOT} = l.{SLOT}"
    for _ in range(rounds):
        if split:
            spread = f"explode(sequence(0, slots - 1)) AS {SLOT}"
            source = f"(SELECT key, rank, {spread} FROM {source})"
        source = f"""(
            SELECT /*+ SHUFFLE_HASH(r) */
                l.key, sum(r.rank * l.weight + l.base) AS rank{slots}
            FROM {source} r JOIN {links} l ON r.key = l.src{on_slot}
            GROUP BY l.key)"""
    return f"SELECT * FROM {source}"


def _iterate(
    ranks: DataFrame, links: str, split: bool, rounds: int, tolerance: float | None
) -> DataFrame:
    while rounds > 0:
        chained = min(rounds, ROUNDS_PER_CUT)
        statement = _rounds_sql(chained, links, split)
        moved = cut(ranks.sparkSession.sql(statement, ranks=ranks))
        if tolerance is not None and _largest_move(ranks, moved) <= tolerance:
            return moved
        ranks, rounds = moved, rounds - chained
    return ranks


def _largest_move(before: DataFrame, after: DataFrame) -> float:
    moved = before.select("key", F.col("rank").alias("old")).join(
        after.select("key", "rank"), "key"
    )
    return moved.agg(F.max(F.abs(F.col("rank") - F.col("old")))).first()[0] or 0.0


def pagerank(
    graph: TopicGraph,
    rounds: int = PAGERANK_ROUNDS,
    damping: float = PAGERANK_DAMPING,
    tolerance: float | None = None,
) -> DataFrame:
    """PageRank of every graph node in every topic."""
    scores = pagerank_scores(graph, rounds, damping, tolerance)
    return on_grid(graph, scores, "rank", 1.0 - damping).withColumnRenamed("rank", "pagerank")
