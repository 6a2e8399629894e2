from __future__ import annotations

import pytest

from fixtures import EDGES, edges
from topicpulse.operators import cleaning, labelling, skew

FACTS = [("hot", str(n)) for n in range(50)] + [(f"k{n}", str(n)) for n in range(20)]
LOOKUP = [("hot", "x"), ("hot", "y"), ("k1", "z"), ("unused", "w")]


@pytest.fixture(scope="module")
def frames(spark):
    facts = spark.createDataFrame(FACTS, "key string, value string")
    lookup = spark.createDataFrame(LOOKUP, "key string, extra string")
    return facts, lookup


def test_heavy_keys_are_found(frames):
    heavy = skew.heavy_keys(frames[0], ["key"], heavy_rows=10)
    assert [tuple(r) for r in heavy] == [("hot", 5)]
    assert skew.heavy_keys(frames[0], ["key"]) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salting_keeps_the_result(frames, how):
    facts, lookup = frames
    heavy = skew.heavy_keys(facts, ["key"], heavy_rows=10)
    salted = skew.salted_join(facts, lookup, ["key"], how, ["value"], heavy)
    plain = facts.join(lookup, ["key"], how)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salting_spreads_a_heavy_key(frames, spark):
    from pyspark.sql import functions as F

    facts, lookup = frames
    heavy = skew.heavy_keys(facts, ["key"], heavy_rows=10)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(
            facts, lookup.hint("shuffle_hash"), ["key"], "left_semi", ["value"], heavy
        )
        places = joined.filter("key = 'hot'").select(F.spark_partition_id().alias("p"))
        assert places.distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_heavy_endpoints_in_both_roles(spark):
    star = [("hub", f"n{i}") for i in range(12)] + [(f"n{i}", "sink") for i in range(9)]
    found = skew.heavy_endpoints(spark.createDataFrame(star, EDGES), heavy_rows=5)
    assert [tuple(r) for r in found["Source"]] == [("hub", 3)]
    assert [tuple(r) for r in found["Target"]] == [("sink", 2)]


def test_salted_cleaning_and_labelling_match_plain(spark):
    star = [("hub", f"n{i}") for i in range(12)] + [(f"n{i}", "hub") for i in range(9)]
    pairs = spark.createDataFrame(star, EDGES)
    spam = spark.createDataFrame([("n3",)], "id string")
    topics = spark.createDataFrame(
        [("hub", ["A", "B"])] + [(f"n{i}", ["A"] if i % 2 else ["B", "C"]) for i in range(10)],
        "id string, userCategory array<string>",
    )
    heavy = skew.heavy_endpoints(pairs, heavy_rows=2)
    assert heavy["Source"] and heavy["Target"]
    none = {"Source": [], "Target": []}
    for build in (
        lambda h: cleaning.exclude_spam_edges(pairs, spam, h),
        lambda h: labelling.with_shared_topics(pairs, topics, h, spam),
        lambda h: labelling.label_edges(pairs, topics, h),
    ):
        assert sorted(map(str, build(heavy).collect())) == sorted(map(str, build(none).collect()))


def test_edges_fixture_has_no_heavy_key(spark):
    assert skew.heavy_endpoints(edges(spark)) == {"Source": [], "Target": []}


def test_no_heavy_key_is_left_out(spark, monkeypatch):
    """All keys above the threshold are split, however many; counting bounds them."""
    rows = spark.range(36_000).selectExpr("cast(id % 12000 AS string) AS key")
    assert skew.heavy_keys(rows, ["key"], heavy_rows=1) == []
    monkeypatch.setattr(skew, "PARTS", 36_000)
    heavy = skew.heavy_keys(rows, ["key"], heavy_rows=1)
    assert len(heavy) == 12_000 and {r["_slots"] for r in heavy} == {3}
