"""Assembling the nested record of a user from features and centralities."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from topicpulse.functions import topic_struct
from topicpulse.operators.graph import PAGERANK_DAMPING, TopicGraph, degree_scores
from topicpulse.sources.schemas import CENTRALITY_MEASURES

# Name in the record -> column of the long form.
SCORE_COLUMNS = dict(
    zip(CENTRALITY_MEASURES, ["betweenness", "closeness", "degree", "pagerank"])
)


def centralities_long(
    graph: TopicGraph, paths: DataFrame, ranks: DataFrame, damping: float = PAGERANK_DAMPING
) -> DataFrame:
    """``id, category`` and the four measures, on the full node x topic grid.

    ``paths`` has ``betweenness`` and ``closeness``, ``ranks`` has ``rank``; both sparse.
    """
    wide = _scores_by_node(graph, paths, ranks, damping)
    if not graph.topics:
        raise ValueError("the graph has no labelled edge")
    topics = F.array(*[F.lit(t) for t in graph.topics]).alias("category")
    names = ("degree", "closeness", "betweenness", "pagerank")
    return wide.select("id", F.inline(F.arrays_zip(topics, *[F.col(c) for c in names])))


def _scores_by_node(
    graph: TopicGraph, paths: DataFrame, ranks: DataFrame, damping: float
) -> DataFrame:
    """One row per graph node with an array per measure, in the order of the topics."""
    parts = [
        degree_scores(graph),
        paths.select("Category", "id", "betweenness", "closeness"),
        ranks.select("Category", "id", F.col("rank").alias("pagerank")),
    ]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    default = {"pagerank": 1.0 - damping}
    names = list(SCORE_COLUMNS.values())
    # One row per node and topic first, then one entry per topic of a node.
    long = merged.groupBy("id", "Category").agg(*[F.max(c).alias(c) for c in names])
    own = F.map_from_entries(F.collect_list(F.struct("Category", F.struct(*names))))
    by_node = long.groupBy("id").agg(own.alias("own"))
    topics = F.array(*[F.lit(t) for t in graph.topics]).cast("array<string>")

    def of_topics(column: str) -> Column:
        value = lambda t: F.try_element_at("own", t).getField(column)
        missing = F.lit(default.get(column, 0.0))
        return F.transform(topics, lambda t: F.coalesce(value(t), missing)).alias(column)

    return by_node.select("id", *[of_topics(c) for c in names])


def centrality_record(
    nodes: DataFrame,
    graph: TopicGraph,
    paths: DataFrame,
    ranks: DataFrame,
    column: str = "centralities",
    damping: float = PAGERANK_DAMPING,
    topics: Sequence[str] | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda frame: frame,
) -> DataFrame:
    """``id`` and one nested struct for every node of the unlabelled edges.

    Nodes outside the graph have null scores.  ``topics`` can widen the dictionaries to
    topics without labelled edges, which are null there.  Without any topic there is
    nothing to nest and the struct is left out.  ``keep`` may write the flat scores.
    """
    if not (graph.topics if topics is None else topics):
        return nodes.select("id")
    wide = keep(_scores_by_node(graph, paths, ranks, damping))
    at = {topic: i for i, topic in enumerate(graph.topics)}
    names = list(graph.topics if topics is None else topics)

    def score(column_name: str, topic: str) -> Column:
        if topic not in at:
            return F.lit(None).cast("double")
        return F.get(column_name, F.lit(at[topic]))

    return nodes.join(wide, "id", "left").select(
        "id",
        F.struct(
            *[
                topic_struct({t: score(c, t) for t in names}, measure)
                for measure, c in SCORE_COLUMNS.items()
            ]
        ).alias(column),
    )


def merge_records(features: DataFrame, centralities: DataFrame, how: str = "inner") -> DataFrame:
    """Features and centralities of the users that occur in the edges.

    ``how="left"`` keeps the other users too, with null centralities.
    """
    return features.join(centralities, "id", how)
