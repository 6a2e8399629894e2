"""Users, posts and edges derived from the shared Parquet tables.

``customer`` gives the users (negative balance = flagged account), ``events`` gives the
posts (event type = topic) and the edges (user -> the ``k`` of ``props``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def users(spark: SparkSession, folder: str) -> DataFrame:
    """``id, screen_name, experiment_spam.category_rf``"""
    flag = F.when(F.col("c_acctbal") < 0, F.lit("1")).otherwise(F.lit("0"))
    return spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("screen_name"),
        F.struct(flag.alias("category_rf")).alias("experiment_spam"),
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """``tweetId, userId, created_at, category`` with a timestamp already parsed."""
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("event_id").cast("string").alias("tweetId"),
        F.col("user_id").cast("string").alias("userId"),
        F.col("ts").alias("created_at"),
        F.col("event_type").alias("category"),
    )


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    """The posts in the nested shape of the original documents, with text timestamps."""
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("event_id").cast("string").alias("id_str"),
        F.struct(
            F.col("user_id").cast("string").alias("id_str"),
            F.lit(None).cast("string").alias("screen_name"),
        ).alias("user"),
        F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
        F.struct(F.col("event_type").alias("category_rf")).alias("experiment_test"),
    )


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """``Source, Target`` with duplicates and self references.

    ``inline`` makes the parsed target a column of its own: filters on it then read that
    column, where they would otherwise repeat the parsing.
    """
    target = F.struct(F.get_json_object("props", "$.k").alias("Target"))
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("user_id").cast("string").alias("Source"), F.inline(F.array(target))
    )


def raw_users(spark: SparkSession, folder: str) -> DataFrame:
    """The users in the shape of the original documents, with both ids."""
    return users(spark, folder).withColumnRenamed("id", "id_str").withColumn(
        "id", F.col("id_str").cast("long")
    )
