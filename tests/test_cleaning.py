from __future__ import annotations

from fixtures import EDGES, edges, posts, rows_of, users
from topicpulse.functions import has_field
from topicpulse.operators import cleaning


def test_spam_is_removed_from_users_posts_and_edges(spark):
    people = users(spark)
    spam = cleaning.spam_ids(people)
    assert rows_of(spam) == {("u4",)}
    kept = cleaning.exclude_spam_users(people, spam)
    assert {r.id for r in kept.collect()} == {"u1", "u2", "u3"}
    assert kept.columns == people.columns
    left = cleaning.exclude_spam_posts(posts(spark), spam)
    assert {r.tweetId for r in left.collect()} == {"t1", "t2", "t3", "t4", "t5", "t6"}
    pairs = cleaning.exclude_spam_edges(cleaning.dedup_edges(edges(spark)), spam)
    assert sorted(map(tuple, pairs.collect())) == [
        ("u1", "u2"),
        ("u1", "u3"),
        ("u2", "u1"),
        ("u9", "u1"),
    ]


def test_missing_flag_skips_the_step(spark):
    plain = users(spark).drop("experiment_spam")
    assert not has_field(plain, "experiment_spam.category_rf")
    assert not has_field(users(spark), "experiment_spam.category_afw")
    assert cleaning.spam_ids(plain) is None
    assert cleaning.exclude_spam_users(plain, None) is plain
    assert cleaning.exclude_spam_posts(posts(spark), None).count() == 7
    assert cleaning.exclude_spam_edges(edges(spark), None).count() == 6


def test_null_keys_do_not_empty_the_result(spark):
    people = users(spark).unionByName(
        spark.createDataFrame([(None, "nobody", ("1",)), (None, "x", ("0",))], users(spark).schema)
    )
    spam = cleaning.spam_ids(people)
    assert rows_of(spam) == {("u4",)}
    assert cleaning.exclude_spam_users(people, spam).count() == 3
    broken = spark.createDataFrame([("u1", None), (None, "u1"), ("u1", "u2")], EDGES)
    assert rows_of(cleaning.dedup_edges(broken)) == {("u1", "u2")}


def test_no_spammer_keeps_everything(spark):
    people = users(spark, flagged=())
    spam = cleaning.spam_ids(people)
    assert cleaning.exclude_spam_users(people, spam).count() == 4
    assert cleaning.exclude_spam_edges(cleaning.dedup_edges(edges(spark)), spam).count() == 5


def test_timestamps_are_taken_as_they_are(spark):
    from pyspark.sql import functions as F

    typed = posts(spark).withColumn("created_at", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
    dated = cleaning.with_posted_at(typed)
    assert dated.schema["posted_at"].dataType.simpleString() == "timestamp_ntz"
    assert dated.filter("posted_at = created_at").count() == 7
