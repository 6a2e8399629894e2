from __future__ import annotations

import pytest
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler

from topicpulse.operators.scaling import scale_records, unnest
from topicpulse.sources.schemas import CENTRALITY_MEASURES, FEATURE_MEASURES

VALUES = {"x": [0.0, 2.0, 5.0, 1.0], "y.z": [3.0, 3.0, 3.0, 3.0]}


@pytest.fixture(scope="module")
def merged(spark):
    topics = list(VALUES)
    inner = "struct<x: double, `y.z`: double>"
    features = ", ".join(f"{m}: {inner}" for m in FEATURE_MEASURES)
    raw = f"tweets_total: bigint, dict_tweet_by_topic: {inner}, dict_days_posted_by_topic: {inner}"
    scores = ", ".join(f"{m}: struct<x: double>" for m in CENTRALITY_MEASURES)
    rows = []
    for i in range(4):
        cell = tuple(VALUES[t][i] for t in topics)
        score = (None if i == 3 else float(i),)
        rows.append((f"u{i}", (7, cell, cell, *[cell] * 4), (score,) * 4))
    return spark.createDataFrame(
        rows, f"id string, user_features struct<{raw}, {features}>, centralities struct<{scores}>"
    )


def _by_user(records, column, measure, topic):
    return [
        r[column][measure][topic] for r in records.orderBy("id").collect()
    ]


def _library(spark, scaler, values):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    frame = VectorAssembler(inputCols=["v"], outputCol="in").transform(frame)
    model = scaler(inputCol="in", outputCol="out").fit(frame)
    return [round(float(r.out[0]), 7) for r in model.transform(frame).collect()]


@pytest.mark.parametrize("topic", list(VALUES))
def test_minmax_matches_the_library_scaler(spark, merged, topic):
    scaled = scale_records(merged, list(VALUES), ["x"])
    got = _by_user(scaled, "user_features", "dict_focus_rate", topic)
    assert got == pytest.approx(_library(spark, MinMaxScaler, VALUES[topic]), abs=1.01e-7)


@pytest.mark.parametrize("topic", list(VALUES))
def test_std_matches_the_library_scaler(spark, merged, topic):
    scaled = scale_records(merged, list(VALUES), ["x"], method="std")
    got = _by_user(scaled, "user_features", "dict_activeness_2", topic)
    assert got == pytest.approx(_library(spark, StandardScaler, VALUES[topic]), abs=1.01e-7)
    # Centralities are not affected by the method.
    assert _by_user(scaled, "centralities", "pageRank", "x") == [0.0, 0.5, 1.0, 0.0]


def test_shape_and_raw_fields(merged):
    plain = scale_records(merged, list(VALUES), ["x"])
    assert plain.columns == ["id", "user_features", "centralities"]
    assert plain.schema["user_features"].dataType.fieldNames() == FEATURE_MEASURES
    assert plain.schema["centralities"].dataType.fieldNames() == CENTRALITY_MEASURES
    raw = scale_records(merged, list(VALUES), ["x"], keep_raw=True)
    assert raw.first().user_features.tweets_total == 7
    assert raw.schema["user_features"].dataType.fieldNames() == FEATURE_MEASURES + [
        "tweets_total",
        "dict_tweet_by_topic",
        "dict_days_posted_by_topic",
    ]
    long = unnest(plain, "user_features", FEATURE_MEASURES, list(VALUES))
    assert long.count() == 4 * 4 * 2
    assert long.filter("value < 0 or value > 1 or value is null").count() == 0


def test_features_alone(merged):
    alone = scale_records(merged.drop("centralities"), list(VALUES), [])
    assert alone.columns == ["id", "user_features"]


def test_no_rows(merged):
    assert scale_records(merged.filter("id is null"), list(VALUES), ["x"]).count() == 0


def test_unknown_method_is_refused(merged):
    with pytest.raises(ValueError, match="method"):
        scale_records(merged, list(VALUES), ["x"], method="robust")
