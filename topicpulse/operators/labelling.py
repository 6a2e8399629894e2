"""Labelling edges with the topics both ends focus on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F

from topicpulse.operators.skew import heavy_endpoints, salted_join


def nodes(edges: DataFrame) -> DataFrame:
    """Distinct ids over both ends, from one scan of the edges."""
    return edges.select(F.explode(F.array("Source", "Target")).alias("id")).distinct()


def node_topics(node_ids: DataFrame, topics_of_users: DataFrame) -> DataFrame:
    """``id, userCategory`` for every node, null where the node is not a user."""
    return node_ids.join(topics_of_users, "id", "left")


def with_shared_topics(
    edges: DataFrame,
    topics_of_users: DataFrame,
    heavy: dict[str, list[Row]] | None = None,
    spam: DataFrame | None = None,
) -> DataFrame:
    """``Source, Target, sourceCategory, targetCategory, Categories`` per edge.

    An end that is not a user has no topics and gives a null ``Categories``.  With
    ``spam`` the edges of flagged ends are dropped on the way: the flag travels with the
    topics, so cleaning and labelling share one shuffle per end.
    """
    heavy = heavy_endpoints(edges) if heavy is None else heavy
    profile = topics_of_users.select("id", "userCategory", F.lit(False).alias("flagged"))
    if spam is not None:
        profile = profile.unionByName(
            spam.select(
                "id",
                F.lit(None).cast("array<string>").alias("userCategory"),
                F.lit(True).alias("flagged"),
            )
        )
    labelled = edges.select("Source", "Target")
    for end, other, column in (
        ("Source", "Target", "sourceCategory"),
        ("Target", "Source", "targetCategory"),
    ):
        lookup = profile.select(
            F.col("id").alias(end), F.col("userCategory").alias(column), "flagged"
        )
        labelled = salted_join(labelled, lookup, [end], "left", [other], heavy[end])
        labelled = labelled.filter(~F.coalesce("flagged", F.lit(False))).drop("flagged")
    return labelled.select(
        "Source",
        "Target",
        "sourceCategory",
        "targetCategory",
        F.array_intersect("sourceCategory", "targetCategory").alias("Categories"),
    )


def one_row_per_topic(with_topics: DataFrame) -> DataFrame:
    """``Source, Target, Category``; edges without a shared topic vanish."""
    return with_topics.select("Source", "Target", F.explode("Categories").alias("Category"))


def label_edges(
    edges: DataFrame,
    topics_of_users: DataFrame,
    heavy: dict[str, list[Row]] | None = None,
) -> DataFrame:
    return one_row_per_topic(with_shared_topics(edges, topics_of_users, heavy))
