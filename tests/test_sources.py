from __future__ import annotations

import pytest

from fixtures import M2_EDGES, labelled, rows_of
from topicpulse.sources import ledger, readers, schemas, sinks

RECORDS = "id string, score struct<v: double>"


def test_users_keep_other_columns_and_use_the_text_id(spark, tmp_path):
    raw = spark.createDataFrame(
        [(17, "17", "ann", 3, ("1",))],
        "id long, id_str string, screen_name string, followers int, "
        "experiment_spam struct<category_rf: string>",
    )
    raw.write.json(str(tmp_path / "u"))
    users = readers.read_users(spark, str(tmp_path / "u"))
    assert sorted(users.columns) == ["experiment_spam", "followers", "id", "screen_name"]
    assert users.first().id == "17"
    typed = readers.read_users(spark, str(tmp_path / "u"), schema=schemas.users_schema())
    assert typed.columns == ["id", "screen_name", "experiment_spam"]


@pytest.mark.parametrize("fmt", ["json", "parquet", "orc"])
def test_posts_are_flattened(spark, tmp_path, fmt):
    raw = spark.createDataFrame(
        [("1", ("7", "bo"), "Wed Aug 27 13:08:45 +0000 2008", ("sport",), "unused")],
        "id_str string, user struct<id_str: string, screen_name: string>, created_at string, "
        "experiment_test struct<category_rf: string>, text string",
    )
    raw.write.format(fmt).save(str(tmp_path / "p"))
    posts = readers.read_posts(
        spark, str(tmp_path / "p"), fmt, category_path="experiment_test.category_rf"
    )
    assert rows_of(posts) == {("1", "7", "bo", "Wed Aug 27 13:08:45 +0000 2008", "sport")}
    assert posts.columns == ["tweetId", "userId", "screen_name", "created_at", "category"]


def test_scan_reads_only_needed_post_fields(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", ("7", "bo", "long"), "x", "sport", "unused")],
        "id_str string, user struct<id_str: string, screen_name: string, bio: string>, "
        "created_at string, category string, text string",
    )
    raw.write.parquet(str(tmp_path / "p"))
    posts = readers.read_posts(spark, str(tmp_path / "p"), "parquet").select("userId", "category")
    plan = posts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user:struct<id_str:string>,category:string>" in plan


def test_edges_ignore_other_fields(spark, tmp_path):
    (tmp_path / "e.json").write_text(
        '{"_id":{"$oid":"5d"},"Source":"1","Target":"2"}\n{"_id":{"$oid":"5e"},"Source":"3","Target":"2"}\n'
    )
    edges = readers.read_edges(spark, str(tmp_path / "e.json"))
    assert rows_of(edges) == {("1", "2"), ("3", "2")}


def test_export_refuses_to_overwrite(spark, tmp_path):
    records = spark.createDataFrame([("a", (1.0,)), ("b", (2.0,))], RECORDS).repartition(2)
    target = str(tmp_path / "out")
    sinks.export_records(records, target, single_file=True)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    assert spark.read.schema(RECORDS).json(target).count() == 2
    with pytest.raises(Exception, match="already exists"):
        sinks.export_records(records, target)


def test_one_file_holds_all_parts_in_order(spark, tmp_path):
    records = spark.range(1000).selectExpr("id", "concat('x', id) AS name").repartitionByRange(7, "id")
    records.write.json(str(tmp_path / "many"))
    parts = "".join(p.read_text() for p in sorted((tmp_path / "many").glob("part-*")))
    target = tmp_path / "one"
    for mode in ("errorifexists", "overwrite"):
        sinks.export_records(records, str(target), mode=mode, single_file=True)
        files = [p for p in target.iterdir() if not p.name.startswith(".")]
        assert [p.name for p in files] == ["part-00000.json"]
        assert files[0].read_text() == parts
    with pytest.raises(Exception, match="already exists"):
        sinks.export_records(records, str(target), single_file=True)
    assert [p.name for p in tmp_path.iterdir() if "_draft" in p.name] == []
    with pytest.raises(ValueError, match="joined"):
        sinks.export_records(records, str(tmp_path / "p"), "parquet", single_file=True)
    empty = tmp_path / "none"
    sinks.export_records(records.limit(0), str(empty), single_file=True)
    assert (empty / "part-00000.json").read_text() == ""


def test_one_file_is_not_written_by_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda *a: pytest.fail("one task"))
    monkeypatch.setattr(type(spark.range(1)), "repartition", lambda *a: pytest.fail("one task"))
    joined = []
    monkeypatch.setattr(ledger.SharedFiles, "join", lambda self, folder, target: joined.append(self.names(folder)) or
                        self.system.create(self._path(target), True).close())
    sinks.export_records(spark.range(100), str(tmp_path / "o"), single_file=True)
    assert sum(n.startswith("part-") for n in joined[0]) == 4


def test_enriched_users_are_appended(spark, tmp_path):
    users = spark.createDataFrame([("a", "ann"), ("c", "cy")], "id string, screen_name string")
    records = spark.createDataFrame([("a", (1.0,)), ("b", (2.0,))], RECORDS)
    for _ in range(2):
        sinks.append_enriched_users(users, records, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.columns == ["id_str", "screen_name", "score"]
    assert stored.count() == 4
    assert stored.filter("score is null").select("id_str").distinct().first()[0] == "c"


def test_graph_tables_can_be_published_again(spark, tmp_path):
    for _ in range(2):
        sinks.publish_graph(labelled(spark), str(tmp_path / "g"))
    stored = spark.read.parquet(str(tmp_path / "g" / "edges"))
    assert rows_of(stored.select("Source", "Target", "Category")) == set(M2_EDGES)
    assert rows_of(spark.read.parquet(str(tmp_path / "g" / "nodes"))) == {(v,) for v in "abcd"}
    assert (tmp_path / "g" / "edges" / "Category=A").is_dir()


def test_batches():
    assert list(sinks.batches(range(5), 2)) == [[0, 1], [2, 3], [4]]
    assert list(sinks.batches([], 2)) == []
    assert sinks.BATCH_ROWS == 7000


def test_publish_in_batches_covers_every_row(spark):
    seen = spark.sparkContext.accumulator(0)
    calls = spark.sparkContext.accumulator(0)

    def send(batch):
        assert len(batch) <= 2
        seen.add(len(batch))
        calls.add(1)

    sinks.publish_in_batches(labelled(spark).repartition(2), send, size=2)
    assert seen.value == len(M2_EDGES)
    assert calls.value >= 3


def test_names_of_run_variants():
    assert sinks.suffixed("user_features", "rf") == "user_features_rf"
    assert sinks.suffixed("user_features") == "user_features"


def _rows(*values):
    return [(v, v * 2) for v in values]


def test_a_run_is_appended_once(spark, tmp_path):
    target = str(tmp_path / "t")
    users = spark.createDataFrame([("a", "ann"), ("c", "cy")], "id string, screen_name string")
    records = spark.createDataFrame([("a", (1.0,)), ("b", (2.0,))], RECORDS)
    schema = sinks.enrich_users(users, records).schema
    assert sinks.read_appended(spark, target, schema).count() == 0
    for _ in range(2):
        sinks.append_enriched_users(users, records, target, run="2024-01")
    sinks.append_enriched_users(users.limit(1), records, target, run="2024-02")
    # Two runs that were killed before their marker: one is repeated, with fewer rows left.
    for run in ("2024-03", "2024-04"):
        sinks.enrich_users(users, records).write.parquet(f"{target}/run={run}")
    assert sinks.append_once(sinks.enrich_users(users.limit(1), records), target, "2024-03")
    stored = sinks.read_appended(spark, target, schema)
    assert stored.columns == ["id_str", "screen_name", "score", "run"]
    assert sorted(r.run for r in stored.collect()) == ["2024-01", "2024-01", "2024-02", "2024-03"]


def test_names_of_runs_are_checked(spark, tmp_path):
    rows = spark.createDataFrame([("1",)], "run string")
    for name in ("", "_x", "a/b", "a=b", ".."):
        with pytest.raises(ValueError, match="letters"):
            sinks.append_once(rows.toDF("id"), str(tmp_path), name)
    with pytest.raises(ValueError, match="named"):
        sinks.append_once(rows, str(tmp_path), "one")


EDGES = "Source string, Target string, Category string"


def graph_at(spark, location):
    nodes, edges = sinks.read_graph(spark, location)
    return sorted(r.id for r in nodes.collect()), sorted(map(tuple, edges.collect()))


def test_overlapping_graphs_merge_to_their_union(spark, tmp_path, monkeypatch):
    location = str(tmp_path / "g")
    first = [("a", "b", "1"), ("b", "c", "1"), ("a", "b", "x/y"), ("a", "a", None), ("a", "b", "1")]
    second = [("b", "c", "1"), ("c", "d", "1"), ("d", "a", "x/y"), ("e", "f", "z")]
    assert graph_at(spark, location) == ([], [])
    assert sinks.merge_graph(spark.createDataFrame(first, EDGES), location, "one")
    assert sinks.merge_graph(spark.createDataFrame(second, EDGES), location, "two")
    assert not sinks.merge_graph(spark.createDataFrame([("x", "y", "q")], EDGES), location, "one")
    nodes, edges = sinks.read_graph(spark, location)
    assert sorted(r.id for r in nodes.collect()) == list("abcdef")
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, edges.collect())) == order(set(first) | set(second))
    assert sinks.merge_graph(spark.createDataFrame([], EDGES), location, "none")
    assert sinks.read_graph(spark, location)[1].count() == len(set(first) | set(second))


def test_a_merge_that_broke_off_is_finished(spark, tmp_path, monkeypatch):
    location = str(tmp_path / "g")
    monkeypatch.setattr(sinks, "EDGE_PARTS", 1)
    sinks.merge_graph(spark.createDataFrame([("a", "b", "A"), ("c", "d", "B")], EDGES), location, "one")
    swap = sinks.KeyedTable.swap

    def broken(table, folder):
        if table.location.endswith("edges"):
            raise OSError("gone")
        swap(table, folder)

    monkeypatch.setattr(sinks.KeyedTable, "swap", broken)
    more = spark.createDataFrame([("a", "e", "A")], EDGES)
    with pytest.raises(OSError):
        sinks.merge_graph(more, location, "two")
    assert (tmp_path / "g" / "_staged" / "two").is_dir()
    monkeypatch.setattr(sinks.KeyedTable, "swap", swap)
    # A partition was already emptied when it broke off.
    gone = next((tmp_path / "g" / "edges").glob("Category=A/part=*"))
    for file in gone.iterdir():
        file.unlink()
    assert not sinks.merge_graph(more, location, "two")  # finished before it is looked up
    assert graph_at(spark, location) == (list("abcde"), [("a", "b", "A"), ("a", "e", "A"), ("c", "d", "B")])
    assert not list((tmp_path / "g" / "_staged").glob("*"))


def test_a_merge_leaves_other_partitions_alone(spark, tmp_path):
    location = str(tmp_path / "g")
    sinks.merge_graph(spark.createDataFrame([("a", "b", "A"), ("c", "d", "B")], EDGES), location, "one")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "g" / "edges").glob("Category=B/*/*.parquet")}
    sinks.merge_graph(spark.createDataFrame([("a", "e", "A")], EDGES), location, "two")
    assert before and {p: p.stat().st_mtime_ns for p in before} == before


def test_the_newest_row_of_a_key_stays(spark):
    schema = "k string, v int, w string"
    stored = spark.createDataFrame([("a", 9, "old"), ("b", 1, None), (None, 1, "old")], schema)
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("c", None, None), (None, 0, "new")], schema)
    found = {tuple(r) for r in sinks.newest(rows, stored, ["k"]).collect()}
    assert found == {("a", 1, "y"), ("b", 1, None), ("c", None, None), (None, 0, "new")}


def receiver(folder, fails=()):
    """Writes a file for every delivery, and fails once for some batches."""
    folder = str(folder)

    def send(batch_id, rows):
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        name = batch_id.replace("/", "_")
        if name.rpartition("_")[2] in fails and not os.path.exists(f"{folder}/failed_{name}"):
            open(f"{folder}/failed_{name}", "w").close()
            raise OSError("the store is away")
        with open(f"{folder}/{name}.{uuid.uuid4().hex}", "w") as out:
            out.writelines(f"{r.Source} {r.Target}\n" for r in rows)

    return send


def deliveries(folder):
    return {p.name: p.read_text().split("\n")[:-1] for p in folder.iterdir() if "failed" not in p.name}


def test_batches_are_sent_once_though_sending_fails(spark, tmp_path):
    edges = [(f"n{k}", f"m{k % 7}", "A") for k in range(200)] + [("hot", "x", "A")] * 100
    frame = spark.createDataFrame(edges, EDGES)
    marks = str(tmp_path / "ledger")
    whole = receiver(tmp_path / "whole")
    sinks.publish_once(frame, whole, ["Source"], str(tmp_path / "other"), "p", size=20)
    assert all(len(rows) <= 20 for rows in deliveries(tmp_path / "whole").values())
    halting = receiver(tmp_path / "sent", fails=("3-0", "5-0", "9-0"))
    with pytest.raises(Exception, match="the store is away"):
        sinks.publish_once(frame, halting, ["Source"], marks, "p", size=20)
    before = deliveries(tmp_path / "sent")
    for attempt in range(6):
        try:
            sinks.publish_once(frame.repartition(5 + attempt), halting, ["Source"], marks, "p", size=20)
            break
        except Exception as error:
            assert "the store is away" in str(error)
    after = deliveries(tmp_path / "sent")
    assert before.items() <= after.items() and len(before) < len(after)
    ids = [name.partition(".")[0] for name in after]
    assert len(ids) == len(set(ids))
    assert sorted(x for rows in after.values() for x in rows) == sorted(f"{s} {t}" for s, t, _ in edges)
    of = lambda found: {n.partition(".")[0]: rows for n, rows in found.items()}
    assert of(after) == of(deliveries(tmp_path / "whole"))
    with pytest.raises(ValueError, match="not those it began with"):
        sinks.publish_once(frame.limit(50), halting, ["Source"], marks, "p", size=20)
    assert deliveries(tmp_path / "sent") == after
