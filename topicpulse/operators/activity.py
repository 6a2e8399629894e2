"""Per-user activity: post counts, active days, focus rate and activeness per topic.

Posts are reduced first to one row per user, topic and day.  Everything else is computed
from that table, so the large input is read and shuffled once, after map-side
aggregation, and a user who wrote a third of all posts is only a few rows of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from topicpulse.functions import topic_struct, zero_if_null

FEATURE_COLUMNS = ["focus_rate", "activeness_1", "activeness_2", "activeness_3"]


def daily_activity(posts: DataFrame) -> DataFrame:
    """``userId, category, day, posts, first_at, last_at`` from posts with ``posted_at``."""
    return posts.groupBy("userId", "category", F.to_date("posted_at").alias("day")).agg(
        F.count(F.lit(1)).alias("posts"),
        F.min("posted_at").alias("first_at"),
        F.max("posted_at").alias("last_at"),
    )


def _whole_days(first: str, last: str, kind: str) -> Column:
    """Full 24 hours between two instants, or between two wall clock times."""
    if kind == "timestamp":
        micros = F.unix_micros(F.col(last)) - F.unix_micros(F.col(first))
        return F.floor(micros / F.lit(86_400_000_000)).cast("long")
    return F.extract(F.lit("DAY"), F.col(last) - F.col(first)).cast("long")


def dataset_span(frame: DataFrame, first: str = "first_at", last: str = "last_at") -> DataFrame:
    """First and last post and the whole 24-hour days between them (one row).

    ``frame`` is ``daily_activity``, or posts with the same column as ``first`` and ``last``.
    """
    ends = frame.agg(F.min(first).alias("first_at"), F.max(last).alias("last_at"))
    kind = dict(ends.dtypes)["first_at"]
    return ends.withColumn("span_days", _whole_days("first_at", "last_at", kind))


def topics_and_span(daily: DataFrame) -> tuple[list[str], int]:
    """The topics in ascending order and the whole days covered.

    The topics are the field names of the output, so they have to be known to the driver.
    """
    names = [row[0] for row in topics(daily).collect()]
    return names, dataset_span(daily).first()["span_days"] or 0


def topics(posts: DataFrame, column: str = "category") -> DataFrame:
    """Distinct topics in ascending order; posts without a topic add none."""
    named = posts.filter(F.col(column).isNotNull()).select(column).distinct()
    return named.orderBy(column)


def screen_names(users: DataFrame) -> DataFrame:
    return users.select("screen_name").distinct()


def _members(users: DataFrame) -> DataFrame:
    # A user listed n times counts each post n times, as the join of users and posts does.
    return users.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))


def _total(posts: Column, copies: Column, count_inactive_as_zero: bool) -> Column:
    least = F.lit(0 if count_inactive_as_zero else 1).cast("long")
    return copies * F.coalesce(posts, least)


def user_totals(
    users: DataFrame, posts: DataFrame, count_inactive_as_zero: bool = False
) -> DataFrame:
    """``id, tweets_total`` for all users.

    A user without posts counts 1 (the unmatched row of the left join) unless
    ``count_inactive_as_zero`` is set.
    """
    written = posts.groupBy(F.col("userId").alias("id")).agg(F.count(F.lit(1)).alias("posts"))
    return (
        _members(users)
        .join(written, "id", "left")
        .select(
            "id",
            _total(F.col("posts"), F.col("copies"), count_inactive_as_zero).alias("tweets_total"),
        )
    )


def user_activity(
    users: DataFrame,
    daily: DataFrame,
    names: Sequence[str],
    count_inactive_as_zero: bool = False,
) -> DataFrame:
    """``id, tweets_total, posts, days``: one row per user.

    ``posts`` and ``days`` are arrays in the order of ``names``.
    """
    per_topic = daily.groupBy(F.col("userId").alias("id"), "category").agg(
        F.sum("posts").alias("posts"), F.count(F.lit(1)).alias("days")
    )
    # A user has one entry for each of their topics, nulls are dropped.
    entry = F.struct("category", F.struct("posts", "days"))
    per_user = per_topic.groupBy("id").agg(
        F.sum("posts").alias("total"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("category").isNotNull(), entry))
        ).alias("own"),
    )
    copies = F.col("copies")

    def of_topics(field: str) -> Column:
        return F.transform(
            _strings(names),
            lambda t: zero_if_null(F.try_element_at("own", t).getField(field), "long"),
        )

    return (
        _members(users)
        .join(per_user, "id", "left")
        .select(
            "id",
            _total(F.col("total"), copies, count_inactive_as_zero).alias("tweets_total"),
            F.transform(of_topics("posts"), lambda n: copies * n).alias("posts"),
            of_topics("days").alias("days"),
        )
    )


def _strings(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def _rates(posts: Column, days: Column, total: Column, span_days: int) -> dict[str, Column]:
    """The four measures of one topic; a span of zero days makes activeness null."""
    span = F.lit(span_days)
    return {
        "focus_rate": posts / F.greatest(F.lit(1), total),
        "activeness_1": F.try_divide(days, span),
        "activeness_2": F.try_divide(posts, span),
        "activeness_3": F.try_divide(posts * days, span),
    }


def features_long(activity: DataFrame, names: Sequence[str], span_days: int) -> DataFrame:
    """``id, category, tweets_total, posts, days`` and the four measures per user and topic."""
    cells = F.arrays_zip(_strings(names).alias("category"), F.col("posts"), F.col("days"))
    cell = activity.select("id", "tweets_total", F.inline(cells))
    rates = _rates(F.col("posts"), F.col("days"), F.col("tweets_total"), span_days)
    return cell.select(
        "id",
        "category",
        "tweets_total",
        "posts",
        "days",
        *[rates[c].alias(c) for c in FEATURE_COLUMNS],
    )


def feature_record(
    activity: DataFrame, names: Sequence[str], span_days: int, column: str = "user_features"
) -> DataFrame:
    """``id`` and one nested struct: the total and a dictionary per measure."""
    posts = {name: F.get("posts", F.lit(i)) for i, name in enumerate(names)}
    days = {name: F.get("days", F.lit(i)) for i, name in enumerate(names)}
    rates = {
        name: _rates(posts[name], days[name], F.col("tweets_total"), span_days) for name in names
    }
    return activity.select(
        "id",
        F.struct(
            F.col("tweets_total"),
            topic_struct(posts, "dict_tweet_by_topic"),
            topic_struct(days, "dict_days_posted_by_topic"),
            *[
                topic_struct({name: rates[name][c] for name in names}, f"dict_{c}")
                for c in FEATURE_COLUMNS
            ],
        ).alias(column),
    )


def user_topics(activity: DataFrame, names: Sequence[str]) -> DataFrame:
    """``id, userCategory``: the topics a user gives at least an even share of posts."""
    share = F.lit(1.0 / len(names)) if names else F.lit(1.0)
    total = F.greatest(F.lit(1), F.col("tweets_total"))
    cells = F.arrays_zip(_strings(names).alias("category"), F.col("posts"))
    kept = F.filter(cells, lambda cell: cell["posts"] / total >= share)
    return activity.select(
        "id", F.transform(kept, lambda cell: cell["category"]).alias("userCategory")
    )


def most_active_users(totals: DataFrame) -> DataFrame:
    """All users by number of posts, the most active first."""
    return totals.orderBy(F.desc("tweets_total"), "id")
