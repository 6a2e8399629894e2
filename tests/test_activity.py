from __future__ import annotations

import time

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fixtures import POSTS, posts, rows_of, users
from topicpulse.operators import activity as act
from topicpulse.operators import cleaning

NAMES = ["A", "B", "C"]


@pytest.fixture(scope="module")
def daily(spark):
    return act.daily_activity(cleaning.with_posted_at(posts(spark)))


@pytest.fixture(scope="module")
def per_user(spark, daily):
    return act.user_activity(users(spark), daily, NAMES)


def test_span_is_in_whole_days(daily):
    assert act.dataset_span(daily).first().span_days == 10
    assert act.topics_and_span(daily) == (NAMES, 10)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_span_over_a_clock_change(spark, monkeypatch, kind):
    """A driver and a session elsewhere, and an hour that their clocks skip."""
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    zone = spark.conf.get("spark.sql.session.timeZone")
    written = [("u1", "A", "2024-03-09 12:00:00"), ("u1", "A", "2024-03-10 11:30:00")]
    frame = spark.createDataFrame(written, "userId string, category string, at string")
    try:
        at = F.to_timestamp("at") if kind == "timestamp" else F.to_timestamp_ntz("at")
        fixed = frame.select("userId", "category", at.alias("posted_at"))
        assert act.topics_and_span(act.daily_activity(fixed)) == (["A"], 0)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        micros = "timestamp_micros(unix_micros(to_timestamp(concat(at, 'Z'))))"
        instants = frame.selectExpr("userId", "category", f"{micros} AS posted_at")
        assert act.dataset_span(instants, "posted_at", "posted_at").first().span_days == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
        monkeypatch.undo()
        time.tzset()


def test_many_topics(spark):
    rows = [(f"u{n % 7}", f"t{n:05}", "2024-01-01 00:00:00") for n in range(3000)]
    written = spark.createDataFrame(rows, "userId string, category string, at string")
    daily = act.daily_activity(written.withColumn("posted_at", F.to_timestamp("at")))
    names, _ = act.topics_and_span(daily)
    assert len(names) == 3000
    people = spark.createDataFrame([(f"u{n}",) for n in range(7)], "id string")
    activity = act.user_activity(people, daily, names)
    long = act.features_long(activity, names, 1)
    assert long.count() == 7 * 3000
    assert long.agg(F.sum("posts")).first()[0] == 3000


def test_counts(per_user):
    assert rows_of(
        per_user.selectExpr("id", "tweets_total", "array_join(posts, ' ')", "array_join(days, ' ')")
    ) == {
        ("u1", 4, "3 1 0", "2 1 0"),
        ("u2", 1, "1 0 0", "1 0 0"),
        ("u3", 1, "0 0 0", "0 0 0"),
        ("u4", 1, "0 1 0", "0 1 0"),
    }


def test_inactive_users_can_count_zero(spark, daily):
    strict = act.user_activity(users(spark), daily, NAMES, count_inactive_as_zero=True)
    assert {r.id: r.tweets_total for r in strict.collect()}["u3"] == 0
    totals = act.user_totals(users(spark), posts(spark), count_inactive_as_zero=True)
    assert {r.id: r.tweets_total for r in totals.collect()} == {"u1": 4, "u2": 1, "u3": 0, "u4": 1}
    assert act.user_totals(users(spark), posts(spark)).filter("id = 'u3'").first()[1] == 1


def test_repeated_user_rows_repeat_their_posts(spark, daily):
    twice = users(spark).unionByName(users(spark).filter("id in ('u1', 'u3')"))
    counted = act.user_activity(twice, daily, NAMES)
    assert {r.id: (r.tweets_total, r.posts[0], r.days[0]) for r in counted.collect()} == {
        "u1": (8, 6, 2),
        "u2": (1, 1, 1),
        "u3": (2, 0, 0),
        "u4": (1, 0, 0),
    }


def test_rates(per_user):
    long = act.features_long(per_user, NAMES, 10)
    got = {
        (r.id, r.category): (r.focus_rate, r.activeness_1, r.activeness_2, r.activeness_3)
        for r in long.collect()
    }
    assert len(got) == 12
    assert got["u1", "A"] == pytest.approx((0.75, 0.2, 0.3, 0.6))
    assert got["u1", "B"] == pytest.approx((0.25, 0.1, 0.1, 0.1))
    assert got["u2", "A"] == pytest.approx((1, 0.1, 0.1, 0.1))
    assert got["u3", "A"] == (0, 0, 0, 0)


def test_zero_span_gives_null_activeness(per_user):
    row = act.features_long(per_user, NAMES, 0).filter("id = 'u1' and category = 'A'").first()
    assert (row.focus_rate, row.activeness_1, row.activeness_3) == (0.75, None, None)


def test_record_is_nested_by_topic(per_user):
    record = act.feature_record(per_user, NAMES, 10, "user_features_rf")
    row = record.filter("id = 'u1'").first()["user_features_rf"]
    assert row.tweets_total == 4
    assert row.dict_tweet_by_topic.asDict() == {"A": 3, "B": 1, "C": 0}
    assert row.dict_days_posted_by_topic.asDict() == {"A": 2, "B": 1, "C": 0}
    assert row.dict_activeness_3.asDict() == pytest.approx({"A": 0.6, "B": 0.1, "C": 0})
    assert record.schema["user_features_rf"].dataType.fieldNames() == [
        "tweets_total",
        "dict_tweet_by_topic",
        "dict_days_posted_by_topic",
        "dict_focus_rate",
        "dict_activeness_1",
        "dict_activeness_2",
        "dict_activeness_3",
    ]


def test_topics_of_users(spark, per_user):
    chosen = act.user_topics(per_user, NAMES)
    assert {r.id: r.userCategory for r in chosen.collect()} == {
        "u1": ["A"],
        "u2": ["A"],
        "u3": [],
        "u4": ["B"],
    }
    # An even share is enough.
    even = spark.createDataFrame([("x", 5, [1] * 5, [1] * 5)], per_user.schema)
    names = list("abcde")
    assert act.user_topics(even, names).first().userCategory == names


def test_posts_without_topic_count_in_the_total_only(spark):
    rows = [
        ("p1", "u1", "one", "Mon Jan 01 00:00:00 +0000 2024", None),
        ("p2", "u1", "one", "Tue Jan 02 00:00:00 +0000 2024", "a.b c"),
    ]
    daily = act.daily_activity(cleaning.with_posted_at(posts(spark, rows)))
    names, span = act.topics_and_span(daily)
    assert (names, span) == (["a.b c"], 1)
    record = act.feature_record(act.user_activity(users(spark), daily, names), names, span)
    row = record.filter("id = 'u1'").first().user_features
    assert row.tweets_total == 2
    assert row.dict_focus_rate["a.b c"] == 0.5


def test_order_and_names(spark):
    totals = act.user_totals(users(spark), posts(spark))
    assert [r.id for r in act.most_active_users(totals).collect()] == ["u1", "u2", "u3", "u4"]
    assert act.screen_names(users(spark)).count() == 4


def test_no_posts_at_all(spark):
    daily = act.daily_activity(cleaning.with_posted_at(posts(spark, [])))
    assert act.topics_and_span(daily) == ([], 0)
    per_user = act.user_activity(users(spark), daily, [])
    assert {r.tweets_total for r in per_user.collect()} == {1}
    assert act.features_long(per_user, [], 0).count() == 0
    assert {tuple(r.userCategory) for r in act.user_topics(per_user, []).collect()} == {()}


written = st.lists(
    st.tuples(st.sampled_from(["u1", "u2", "u4"]), st.integers(1, 9), st.sampled_from(NAMES)),
    min_size=1,
    max_size=20,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(written)
def test_shares_add_up_and_spam_changes_nobody_else(spark, rows):
    made = [
        (str(i), u, u, f"Mon Jan 0{day} 10:00:00 +0000 2024", topic)
        for i, (u, day, topic) in enumerate(rows)
    ]
    daily = act.daily_activity(cleaning.with_posted_at(spark.createDataFrame(made, POSTS)))
    people = users(spark)
    spam = cleaning.spam_ids(people)
    everyone = act.features_long(act.user_activity(people, daily, NAMES), NAMES, 8)
    clean = act.features_long(
        act.user_activity(
            cleaning.exclude_spam_users(people, spam),
            cleaning.exclude_spam_posts(daily, spam).repartition(3),
            NAMES,
        ),
        NAMES,
        8,
    )
    shares = everyone.groupBy("id").sum("focus_rate").collect()
    active = {u for u, _, _ in rows}
    assert {r[0]: round(r[1], 9) for r in shares} == {
        r[0]: (1.0 if r[0] in active else 0.0) for r in shares
    }
    assert rows_of(clean) == {r for r in rows_of(everyone) if r[0] != "u4"}
