"""Readers for users, posts and edges, in any format Spark can load.

Each reader is a plain ``load`` followed by a ``shape_*`` projection.  The projections
are public too, for callers that already hold a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from topicpulse.operators.lineage import Stages
from topicpulse.sources.inference import read_json_lines
from topicpulse.sources.schemas import EDGES_SCHEMA, posts_schema


def load(
    spark: SparkSession,
    location: str | None,
    fmt: str = "parquet",
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """Load with an explicit schema when there is one.

    Without a schema JSON and CSV sources infer it from all rows, so no field is lost.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(location) if location else reader.load()


def shape_users(raw: DataFrame) -> DataFrame:
    """Drop the numeric ``id`` if present and use ``id_str`` as ``id``."""
    return raw.drop("id").withColumnRenamed("id_str", "id")


def shape_posts(raw: DataFrame, category_path: str = "category") -> DataFrame:
    """Flatten posts to ``tweetId, userId, screen_name, created_at, category``."""
    return raw.select(
        F.col("id_str").alias("tweetId"),
        F.col("user.id_str").alias("userId"),
        F.col("user.screen_name").alias("screen_name"),
        F.col("created_at"),
        F.col(category_path).alias("category"),
    )


def shape_edges(raw: DataFrame) -> DataFrame:
    return raw.select("Source", "Target")


def read_users(
    spark: SparkSession,
    location: str | None,
    fmt: str = "json",
    schema: StructType | None = None,
    stages: Stages | None = None,
    **options: str,
) -> DataFrame:
    """Users with every column kept; pass ``schema`` to skip inference.

    With ``stages`` JSON lines are read by the schema of a sample and written there, see
    ``inference.read_json_lines``: a field that only few users have isn't lost, and the source
    is read once if there is none.
    """
    if stages is not None and fmt == "json" and schema is None and not options:
        return shape_users(read_json_lines(spark, location, stages))
    return shape_users(load(spark, location, fmt, schema, **options))


def read_posts(
    spark: SparkSession,
    location: str | None,
    fmt: str = "json",
    category_path: str = "category",
    **options: str,
) -> DataFrame:
    raw = load(spark, location, fmt, posts_schema(category_path), **options)
    return shape_posts(raw, category_path)


def read_edges(
    spark: SparkSession, location: str | None, fmt: str = "json", **options: str
) -> DataFrame:
    return shape_edges(load(spark, location, fmt, EDGES_SCHEMA, **options))
