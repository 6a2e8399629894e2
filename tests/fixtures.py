"""Small hand-checked inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

USERS = "id string, screen_name string, experiment_spam struct<category_rf: string>"
POSTS = "tweetId string, userId string, screen_name string, created_at string, category string"
EDGES = "Source string, Target string"
LABELLED = "Source string, Target string, Category string"

M1_POSTS = [
    ("t1", "u1", "one", "Mon Jan 01 00:00:00 +0000 2024", "A"),
    ("t2", "u1", "one", "Mon Jan 01 12:00:00 +0000 2024", "A"),
    ("t3", "u1", "one", "Wed Jan 03 09:00:00 +0000 2024", "A"),
    ("t4", "u1", "one", "Wed Jan 03 10:00:00 +0000 2024", "B"),
    ("t5", "u2", "two", "Fri Jan  5 06:00:00 +0000 2024", "A"),
    ("t6", "u9", "nine", "Thu Jan 11 12:00:00 +0000 2024", "C"),
    ("t7", "u4", "four", "Tue Jan 02 08:00:00 +0000 2024", "B"),
]
M1_EDGES = [
    ("u1", "u2"),
    ("u1", "u2"),
    ("u2", "u1"),
    ("u1", "u3"),
    ("u4", "u1"),
    ("u9", "u1"),
]
M2_EDGES = [("a", "b", "A"), ("b", "c", "A"), ("a", "d", "A"), ("d", "c", "A"), ("a", "b", "B")]


def users(spark: SparkSession, flagged: tuple[str, ...] = ("u4",)) -> DataFrame:
    rows = [
        (u, f"name-{u}", ("1" if u in flagged else "0",)) for u in ("u1", "u2", "u3", "u4")
    ]
    return spark.createDataFrame(rows, USERS)


def posts(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(M1_POSTS if rows is None else rows, POSTS)


def edges(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(M1_EDGES if rows is None else rows, EDGES)


def labelled(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(M2_EDGES if rows is None else rows, LABELLED)


def rows_of(frame: DataFrame) -> set[tuple]:
    return {tuple(row) for row in frame.collect()}
