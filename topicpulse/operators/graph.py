"""The topic graph: labelled edges as a table, with the topic as a column.

All topics are handled by one plan.  ``TopicGraph`` holds what every measure needs:

* ``edges``    Category, Source, Target
* ``degrees``  Category, id, key, out_degree, in_degree
* ``links``    src, dst and both degrees of both ends, as keys
* ``sizes``    per topic with at least one edge a few counts, on the driver

``key`` is one long per (topic, node).  The iterated jobs join and shuffle only these
longs; names come back with ``named`` at the end.  Measures are computed sparsely
(``Category, id, value`` where the value differs from the default) and completed to the
full node x topic grid by ``on_grid``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from topicpulse.operators.lineage import cut
from topicpulse.operators.skew import HEAVY_ROWS, heaviest, salted_join

PAGERANK_DAMPING = 0.85
PAGERANK_ROUNDS = 100


@dataclass(frozen=True)
class TopicSize:
    """Counts of one topic: nodes, nodes with outgoing edges, edges, largest degrees, the edges
    from nodes that have incoming ones, and these nodes with or without outgoing edges."""

    members: int
    senders: int
    edges: int
    most_out: int
    most_in: int
    inner: int
    receivers: int


@dataclass
class TopicGraph:
    edges: DataFrame
    degrees: DataFrame
    sizes: dict[str, TopicSize]
    heavy_rows: int = HEAVY_ROWS
    _links: DataFrame | None = field(default=None, repr=False)

    @property
    def topics(self) -> list[str]:
        """The topics with edges, ascending."""
        return sorted(self.sizes)

    @property
    def edge_count(self) -> int:
        return sum(size.edges for size in self.sizes.values())

    @property
    def split_sources(self) -> bool:
        """True when a node has more outgoing edges than one slot should hold."""
        return any(size.most_out > self.heavy_rows for size in self.sizes.values())

    @property
    def split_targets(self) -> bool:
        return any(size.most_in > self.heavy_rows for size in self.sizes.values())

    @property
    def links(self) -> DataFrame:
        """Edges with the degrees of both ends; computed once, on first use."""
        if self._links is None:
            self._links = cut(_annotated(self))
        return self._links

    @property
    def nodes(self) -> DataFrame:
        """Ids with at least one labelled edge of any topic."""
        return self.degrees.select("id").distinct()


def edge_topics(labelled: DataFrame) -> DataFrame:
    return labelled.select("Category").distinct().orderBy("Category")


def edge_degrees(labelled: DataFrame) -> DataFrame:
    """``Category, id, out_degree, in_degree`` for nodes with an edge in that topic."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = F.array(
        F.struct(F.col("Source").alias("id"), one.alias("o"), none.alias("i")),
        F.struct(F.col("Target").alias("id"), none.alias("o"), one.alias("i")),
    )
    return (
        labelled.select("Category", F.inline(ends))
        .groupBy("Category", "id")
        .agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
    )


def topic_graph(
    labelled: DataFrame, heavy_rows: int = HEAVY_ROWS, written: bool = False
) -> TopicGraph:
    """Materialise labelled edges and degrees and read back the size of each topic.

    ``written=True`` says that reading ``labelled`` again is cheap already.  The keys
    depend on how rows fall into partitions, so they are fixed by writing them out
    together with the degrees.  Within a partition those of a topic follow each other.
    """
    edges = labelled.select("Category", "Source", "Target")
    edges = edges if written else cut(edges)
    ordered = edge_degrees(edges).sortWithinPartitions("Category")
    degrees = cut(ordered.withColumn("key", F.monotonically_increasing_id()))
    rows = (
        degrees.groupBy("Category")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.count_if(F.col("out_degree") > 0).alias("senders"),
            F.sum("out_degree").alias("edges"),
            F.max("out_degree").alias("most_out"),
            F.max("in_degree").alias("most_in"),
            F.sum(F.when(F.col("in_degree") > 0, F.col("out_degree")).otherwise(0)).alias("inner"),
            F.count_if(F.col("in_degree") > 0).alias("receivers"),
        )
        .collect()
    )
    sizes = {row["Category"]: TopicSize(*row[1:]) for row in rows}
    return TopicGraph(edges, degrees, sizes, heavy_rows)


def _annotated(graph: TopicGraph) -> DataFrame:
    """``src, src_out, src_in, dst, dst_out, dst_in``; popular ends are salted."""
    links = graph.edges
    columns = []
    for end, other, name, own, split in (
        ("Source", "Target", "src", "out_degree", graph.split_sources),
        ("Target", "Source", "dst", "in_degree", graph.split_targets),
    ):
        ends = graph.degrees.withColumnRenamed("id", end)
        lookup = ends.select(
            "Category",
            end,
            F.col("key").alias(name),
            F.col("out_degree").alias(f"{name}_out"),
            F.col("in_degree").alias(f"{name}_in"),
        )
        keys = ["Category", end]
        heavy = heaviest(ends, keys, own, graph.heavy_rows) if split else []
        links = salted_join(links, lookup, keys, "inner", [other], heavy)
        columns += [name, f"{name}_out", f"{name}_in"]
    return links.select(*columns)


def reversed_both_ways(labelled: DataFrame) -> DataFrame:
    """Every edge in both directions, once: the undirected view of the graph."""
    ends = F.array(
        F.struct(F.col("Source").alias("Source"), F.col("Target").alias("Target")),
        F.struct(F.col("Target").alias("Source"), F.col("Source").alias("Target")),
    )
    return labelled.select("Category", F.inline(ends)).distinct()


def named(graph: TopicGraph, scores: DataFrame) -> DataFrame:
    """Scores by ``key`` as scores by ``Category, id``."""
    values = [c for c in scores.columns if c != "key"]
    names = graph.degrees.select("key", "Category", "id")
    return names.join(scores, "key").select("Category", "id", *values)


def grid(graph: TopicGraph) -> DataFrame:
    """``Category, id`` for every graph node and every topic with edges."""
    names = F.array(*[F.lit(t) for t in graph.topics]).cast("array<string>")
    return graph.nodes.select(F.explode(names).alias("Category"), "id")


def on_grid(
    graph: TopicGraph, scores: DataFrame, column: str, default: float = 0.0
) -> DataFrame:
    """Sparse scores completed with ``default`` for the other nodes and topics."""
    return (
        grid(graph)
        .join(scores, ["Category", "id"], "left")
        .select("Category", "id", F.coalesce(column, F.lit(default)).alias(column))
    )


def degree_scores(graph: TopicGraph, direction: str = "both") -> DataFrame:
    """Sparse ``Category, id, degree``.  A reciprocal pair counts 2 for each end."""
    parts: dict[str, Sequence[str]] = {
        "both": ("out_degree", "in_degree"),
        "out": ("out_degree",),
        "in": ("in_degree",),
    }
    if direction not in parts:
        raise ValueError(f"direction must be one of {sorted(parts)}, not {direction!r}")
    total = sum((F.col(c) for c in parts[direction]), F.lit(0))
    return graph.degrees.select("Category", "id", total.cast("double").alias("degree"))


def degree(graph: TopicGraph, direction: str = "both") -> DataFrame:
    """Degree of every graph node in every topic."""
    return on_grid(graph, degree_scores(graph, direction), "degree")


def by_user(scores: DataFrame) -> DataFrame:
    """Scores in descending order of the user id."""
    return scores.orderBy(F.desc("id"))
