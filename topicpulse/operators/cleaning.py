"""Spam removal, edge deduplication and post timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F

from topicpulse.functions import has_field, parse_created_at
from topicpulse.operators.skew import heavy_endpoints, salted_join
from topicpulse.sources.schemas import SPAM_FLAG, SPAM_VALUE


def with_posted_at(posts: DataFrame, on_bad_date: str = "raise") -> DataFrame:
    """Add ``posted_at``: ``created_at`` parsed if it is text, else taken as it is."""
    created_at = F.col("created_at")
    if dict(posts.dtypes)["created_at"] == "string":
        created_at = parse_created_at(created_at, on_bad_date)
    return posts.withColumn("posted_at", created_at)


def spam_ids(users: DataFrame, flag: str = SPAM_FLAG) -> DataFrame | None:
    """Distinct ids of flagged users, or None when the users carry no such flag."""
    if not has_field(users, flag):
        return None
    return (
        users.filter((F.col(flag) == SPAM_VALUE) & F.col("id").isNotNull())
        .select("id")
        .distinct()
    )


def exclude_spam_users(users: DataFrame, spam: DataFrame | None) -> DataFrame:
    if spam is None:
        return users
    return users.filter(F.col("id").isNotNull()).join(spam, "id", "left_anti")


def exclude_spam_posts(
    posts: DataFrame, spam: DataFrame | None, heavy: list[Row] | None = None
) -> DataFrame:
    """Rows whose ``userId`` is not flagged.

    A run applies it to ``daily_activity``, which has far fewer rows than the posts and
    no heavy user left.  For single posts pass ``heavy`` (``heavy_keys`` on ``userId``)
    to salt the users with very many of them.
    """
    if spam is None:
        return posts
    known = posts.filter(F.col("userId").isNotNull())
    flagged = spam.withColumnRenamed("id", "userId")
    spread_by = ["tweetId"] if "tweetId" in posts.columns else ["category"]
    kept = salted_join(known, flagged, ["userId"], "left_anti", spread_by, heavy or [])
    return kept.select(*posts.columns)


def dedup_edges(edges: DataFrame) -> DataFrame:
    """Distinct ``(Source, Target)`` pairs with both ends known."""
    return (
        edges.select("Source", "Target")
        .filter(F.col("Source").isNotNull() & F.col("Target").isNotNull())
        .distinct()
    )


def exclude_spam_edges(
    edges: DataFrame, spam: DataFrame | None, heavy: dict[str, list[Row]] | None = None
) -> DataFrame:
    """Edges with no flagged end.  Popular ends are salted, see ``operators.skew``."""
    if spam is None:
        return edges
    heavy = heavy_endpoints(edges) if heavy is None else heavy
    kept = edges
    for end, other in (("Source", "Target"), ("Target", "Source")):
        kept = salted_join(
            kept, spam.withColumnRenamed("id", end), [end], "left_anti", [other], heavy[end]
        )
    return kept.select(*edges.columns)
