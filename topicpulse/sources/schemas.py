"""Explicit input schemas and the public measure names."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Scaled measures, in output order.
FEATURE_MEASURES = [
    "dict_activeness_1",
    "dict_activeness_2",
    "dict_activeness_3",
    "dict_focus_rate",
]
CENTRALITY_MEASURES = [
    "betweennessCentrality",
    "closenessCentrality",
    "degreeCentrality",
    "pageRank",
]
# Per-user counts that the raw record carries besides the measures.
RAW_FIELDS = ["tweets_total", "dict_tweet_by_topic", "dict_days_posted_by_topic"]

SPAM_FLAG = "experiment_spam.category_rf"
SPAM_VALUE = "1"

EDGES_SCHEMA = StructType(
    [StructField("Source", StringType()), StructField("Target", StringType())]
)


def nested_string(path: str) -> StructField:
    """A string field at a dotted path, as nested structs."""
    head, _, rest = path.partition(".")
    if not rest:
        return StructField(head, StringType())
    return StructField(head, StructType([nested_string(rest)]))


def users_schema(spam_flag: str | None = SPAM_FLAG) -> StructType:
    fields = [StructField("id_str", StringType()), StructField("screen_name", StringType())]
    if spam_flag:
        fields.append(nested_string(spam_flag))
    return StructType(fields)


def posts_schema(category_path: str = "category") -> StructType:
    """Only the fields the analysis reads, so a columnar or JSON scan skips the rest."""
    return StructType(
        [
            StructField("id_str", StringType()),
            StructField(
                "user",
                StructType(
                    [
                        StructField("id_str", StringType()),
                        StructField("screen_name", StringType()),
                    ]
                ),
            ),
            StructField("created_at", StringType()),
            nested_string(category_path),
        ]
    )
