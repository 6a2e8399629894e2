from __future__ import annotations

import json
from pathlib import Path

import pytest

from fixtures import edges, posts, users
from topicpulse import RunOptions, run
from topicpulse.__main__ import main

FEATURES = ["dict_activeness_1", "dict_activeness_2", "dict_activeness_3", "dict_focus_rate"]
SCORES = ["betweennessCentrality", "closenessCentrality", "degreeCentrality", "pageRank"]


@pytest.fixture(scope="module")
def result(spark):
    return run(users(spark), posts(spark), edges(spark), RunOptions(method_name="rf"))


def _column(frame, struct, measure, topic):
    rows = {r.id: r[struct][measure][topic] for r in frame.collect()}
    return [rows[u] for u in ("u1", "u2", "u3")]


def test_worked_example(result):
    assert (result.topics, result.centrality_topics, result.span_days) == (["A", "B", "C"], ["A"], 10)
    assert {tuple(r) for r in result.labelled_edges.collect()} == {
        ("u1", "u2", "A"),
        ("u2", "u1", "A"),
    }
    expected = {
        ("dict_focus_rate", "A"): [0.75, 1, 0],
        ("dict_focus_rate", "B"): [1, 0, 0],
        ("dict_focus_rate", "C"): [0.5, 0.5, 0.5],
        ("dict_activeness_1", "A"): [1, 0.5, 0],
        ("dict_activeness_2", "A"): [1, 0.3333333, 0],
        ("dict_activeness_3", "A"): [1, 0.1666667, 0],
    }
    for (measure, topic), values in expected.items():
        assert _column(result.records, "user_features_rf", measure, topic) == values
    for measure in ("degreeCentrality", "closenessCentrality"):
        assert _column(result.records, "centralities_rf", measure, "A") == [1, 1, 0]
    assert _column(result.records, "centralities_rf", "pageRank", "A") == pytest.approx([1, 1, 0])
    assert _column(result.records, "centralities_rf", "betweennessCentrality", "A") == [0.5] * 3


def test_scores_before_scaling(result):
    rows = {r.id: r.centralities_rf for r in result.merged.collect()}
    for user in ("u1", "u2"):
        assert rows[user].degreeCentrality.A == 2
        assert rows[user].closenessCentrality.A == 1
        assert rows[user].betweennessCentrality.A == 0
        assert rows[user].pageRank.A == pytest.approx(1, abs=1e-6)
    assert rows["u3"].degreeCentrality.A is None


def test_record_schema(result):
    schema = result.records.schema
    assert schema.names == ["id", "user_features_rf", "centralities_rf"]
    assert schema["user_features_rf"].dataType.fieldNames() == FEATURES
    assert schema["centralities_rf"].dataType.fieldNames() == SCORES
    for measure in FEATURES:
        inner = schema["user_features_rf"].dataType[measure].dataType
        assert inner.simpleString() == "struct<A:double,B:double,C:double>"


def test_getters(result):
    counts = {r.stage: r.rows for r in result.stage_counts().collect()}
    assert counts == {
        "users": 4,
        "users_clean": 3,
        "edges_distinct": 5,
        "edges_clean": 4,
        "edges_labelled": 2,
        "graph_nodes": 2,
        "records": 3,
    }
    assert result.screen_names.count() == 3


def test_options(spark):
    options = RunOptions(
        drop_spam_posts=False,
        keep_raw=True,
        how="left",
        all_topics=True,
        betweenness="sampled",
        closeness_direction="both",
        scale_method="std",
        heavy_rows=1,
        rounds=5,
    )
    result = run(users(spark), posts(spark), edges(spark, [("u1", "u2")]), options)
    schema = result.records.schema
    assert schema.names == ["id", "user_features", "centralities"]
    assert "tweets_total" in schema["user_features"].dataType.fieldNames()
    topics = schema["centralities"].dataType["pageRank"].dataType.fieldNames()
    assert topics == ["A", "B", "C"]
    assert {r.id for r in result.records.collect()} == {"u1", "u2", "u3"}


def test_spam_posts_shape_topics_and_span_only_on_request(spark):
    late = [
        ("p1", "u1", "one", "Mon Jan 01 00:00:00 +0000 2024", "A"),
        ("p2", "u2", "two", "Tue Jan 02 00:00:00 +0000 2024", "A"),
        ("p3", "u4", "four", "Wed Jan 31 00:00:00 +0000 2024", "Z"),
    ]
    pairs = edges(spark, [("u1", "u2")])
    kept = run(users(spark), posts(spark, late), pairs, RunOptions(drop_spam_posts=False, rounds=2))
    assert (kept.topics, kept.span_days) == (["A", "Z"], 30)
    clean = run(users(spark), posts(spark, late), pairs, RunOptions(rounds=2))
    assert (clean.topics, clean.span_days) == (["A"], 1)


def test_users_without_spam_flag(spark):
    plain = users(spark).drop("experiment_spam")
    result = run(plain, posts(spark), edges(spark), RunOptions(rounds=2))
    assert {r.id for r in result.records.collect()} == {"u1", "u2", "u3", "u4"}


def test_no_labelled_edge(spark):
    result = run(users(spark), posts(spark), edges(spark, [("u1", "u3")]), RunOptions(rounds=2))
    assert result.centrality_topics == []
    assert result.records.columns == ["id", "user_features"]
    assert {r.id for r in result.records.collect()} == {"u1", "u3"}


@pytest.mark.parametrize(
    "bad", [{"scale_method": "x"}, {"betweenness": "x"}, {"how": "x"}, {"on_bad_date": "x"}]
)
def test_bad_options_are_refused(bad):
    with pytest.raises(ValueError):
        RunOptions(**bad)


def test_command_line(spark, tmp_path):
    people = users(spark).selectExpr("id as id_str", "1 as id", "screen_name", "experiment_spam")
    people.write.json(str(tmp_path / "users"))
    posts(spark).selectExpr(
        "tweetId as id_str",
        "struct(userId as id_str, screen_name) as user",
        "created_at",
        "struct(category as category_rf) as experiment_test",
    ).write.json(str(tmp_path / "posts"))
    edges(spark).selectExpr("struct('x' as `$oid`) as _id", "Source", "Target").write.json(
        str(tmp_path / "edges")
    )
    paths = [f for n in ("users", "posts", "edges", "output", "enriched", "graph")
             for f in (f"--{n}", str(tmp_path / n))]
    main([*paths, "--method-name", "rf", "--category", "experiment_test.category_rf",
          "--single-file", "--counts"])
    (part,) = (tmp_path / "output").glob("part-*.json")
    records = {r["id"]: r for r in map(json.loads, part.read_text().splitlines())}
    assert list(records["u1"]) == ["id", "user_features_rf", "centralities_rf"]
    assert records["u2"]["user_features_rf"]["dict_activeness_3"] == {
        "A": 0.1666667, "B": 0.0, "C": 0.5,
    }
    enriched = spark.read.parquet(str(tmp_path / "enriched"))
    assert {r.id_str for r in enriched.collect()} == {"u1", "u2", "u3"}
    assert spark.read.parquet(str(tmp_path / "graph" / "edges")).count() == 2


def test_a_released_run_leaves_no_table_behind(spark, tmp_path):
    from topicpulse.operators import lineage

    folder = lineage.shared_folder(spark)
    result = run(users(spark), posts(spark), edges(spark), RunOptions(rounds=2))
    local = result.written.folder.removeprefix("file:")
    assert local.startswith(folder.removeprefix("file:")) and Path(local).is_dir()
    assert result.records.count() == 3
    result.release()
    assert not Path(local).exists()


def test_stages_are_counted_while_they_are_written(spark):
    result = run(users(spark), posts(spark), edges(spark), RunOptions(rounds=2))
    counted = set(result.rows)
    assert counted == {"users", "users_clean", "edges_distinct", "edges_clean", "edges_labelled", "records"}
    again = {name: frame.count() for name, frame in result.stages.items()}
    assert result.rows == {name: again[name] for name in counted}
    assert {r.stage: r.rows for r in result.stage_counts().collect()} == again
    # Only the stage that isn't written has to be read for the report.
    plan = result.stage_counts()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [count(1)") <= 1
    result.release()


def test_counts_of_a_run_without_users(spark):
    for none in (users(spark).limit(0), spark.createDataFrame([], users(spark).schema)):
        result = run(none, posts(spark), edges(spark), RunOptions(rounds=2))
        # What the optimiser takes away is not counted on the way, but when it is asked for.
        found = {r.stage: r.rows for r in result.stage_counts().collect()}
        assert found["users"] == found["users_clean"] == found["records"] == 0
        result.release()
