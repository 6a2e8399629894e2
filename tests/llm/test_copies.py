"""Line dedup, near-duplicates, shards, and the pipeline."""

from __future__ import annotations

import os
import random
import zlib
from collections import Counter

import pytest

import corpus_pipeline
import plain
from topicpulse.llm import common, kd_sharding, line_dedup, near_duplicates, quality_model, queries
from topicpulse.operators.lineage import Stages

EDGES = [None, "", " \n ", "\n\nx\n\n", "one", "tie tie", "tie tie", "a b c d e f\n" * 300]


def lined_docs():
    draw = random.Random(5)
    lines = ["", "l m", "q r s t u v", "a b c", "d e", "é f g h i j k", " spaced  line of some words "]
    docs = ["\n".join(draw.choices(lines, k=draw.randint(0, 12))) for _ in range(60)]
    block = "\n".join(f"line {k} of a block of lines" for k in range(40))
    docs += [block, "before it\n" + block, block + "\nafter it", block]
    return list(enumerate(EDGES + docs))


@pytest.mark.parametrize("min_words", [1, 4, 5, 9])
def test_lines_that_stand_earlier_go(table, min_words):
    rows = lined_docs()
    found = {r.doc_id: r for r in line_dedup.dedup_lines(table(rows), min_words).collect()}
    removed = plain.removed_lines(rows, min_words)
    for n, text in rows:
        kept = [x for i, x in enumerate(plain.LINE_END.split(text or "")) if i not in removed[n]]
        assert found[n].n_removed == len(removed[n]), text
        assert (found[n].text or "") == "\n".join(kept)
    assert found[0].text is None


def test_lines_by_shuffles_and_of_repeated_rows(table, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    rows = [(2, "a b c d e\nx"), (2, "a b c d e\nx"), (None, "a b c d e"), (1, "a b c d e")]
    found = line_dedup.dedup_lines(table(rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == [(0, ""), (1, "a b c d e"), (2, "x"), (2, "x")]
    assert line_dedup.dedup_lines(table([])).count() == 0


def test_equal_rows_of_many_lines_are_one_document(spark, table):
    text = "\n".join(f"line {k} of a document of many lines" for k in range(200))
    stages = Stages(spark)
    assert line_dedup.line_places(table([(1, text), (1, text)]), stages).count() == 200
    stages.release()
    found = line_dedup.dedup_lines(table([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (1, 0), (2, 200)]


def test_lines_are_numbered_without_rows_from_the_driver(spark, table):
    """Executors start Python workers for a list of rows, and keep them."""
    stages = Stages(spark)
    places = line_dedup.line_places(table([(1, "a\nb"), (2, "c")]), stages)
    assert "ExistingRDD" not in places._jdf.queryExecution().toString()
    assert sorted(r.p for r in places.collect()) == [0, 1, 2]
    stages.release()


def test_few_texts_are_sent_to_a_worker_of_line_dedup(spark, table, monkeypatch):
    portions = common._portions

    def look(batch, column, most):
        assert batch.column(column).buffers()[2].size < 16 << 20
        return portions(batch, column, most)

    monkeypatch.setattr(common, "_portions", look)
    stages = Stages(spark)
    many = table([(0, "same words " * 10_000)]).crossJoin(spark.range(0, 400, 1, 1).toDF("n"))
    assert line_dedup.line_places(many, stages).count() == 1
    stages.release()


def _own_bytes():
    with open("/proc/self/status") as file:
        return next(int(x.split()[1]) for x in file if x.startswith("RssAnon")) << 10


def test_freed_memory_goes_back_to_the_system():
    before = _own_bytes()
    held = [bytes(1000) for _ in range(200_000)]
    last, held = held[-1], None
    common.hand_back()
    assert len(last) == 1000 and _own_bytes() - before < 60 << 20


@pytest.mark.parametrize("stage", [k for k, (n, _) in enumerate(corpus_pipeline.STAGES) if n != "decontamination"])
def test_tasks_of_the_pipeline_hand_memory_back(spark, table, labelled, tmp_path, monkeypatch, stage):
    told = str(tmp_path / "told")

    def tell():
        open(told, "a").close()

    for module in (common, quality_model):
        monkeypatch.setattr(module, "hand_back", tell)
    labelled([(n, n % 2, 0) for n in range(40)]).write.parquet(str(tmp_path / "labels.parquet"))
    docs = table([(n, f"some words of {n}" + " !!" * (n % 2)) for n in range(40)])
    corpus_pipeline.STAGES[stage][1](spark, docs, str(tmp_path)).collect()
    assert os.path.exists(told)


def test_a_run_is_judged_as_a_whole(table):
    """Runs of three lines of two words, and of seven lines of one word."""
    three, seven = "a b\nc d\ne f", "\n".join("stuvwxy")
    rows = [(1, f"{three}\nx1"), (2, f"y1\n{three}"), (3, f"{seven}\nx2"), (4, f"{seven}\ny2"), (5, "a b\nc d\nz1")]
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(table(rows)).collect()}
    assert found == {1: rows[0][1], 2: "y1", 3: rows[2][1], 4: "y2", 5: "a b\nc d\nz1"}


def near_docs():
    draw = random.Random(11)
    vocabulary = ["".join(draw.choices("abcdefghijklmnop", k=4)) for _ in range(3000)]
    docs = []
    for _ in range(40):
        base = draw.choices(vocabulary, k=draw.randint(5, 300))
        docs.append(" ".join(base))
        for _ in range(draw.randint(0, 8)):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 12))):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            docs.append(" ".join(copy).upper() if draw.random() < 0.3 else "  ".join(copy))
    # A group in which neighbours are near and ends are far from each other.
    chain = draw.choices(vocabulary, k=100)
    for k in range(60):
        chain = chain[1:] + [draw.choice(vocabulary)] if k % 2 else chain[:]
        docs.append(" ".join(chain))
    return list(enumerate(EDGES + docs))


@pytest.mark.parametrize("broadcast, words", [(True, 2), (False, 2), (False, 5)])
def test_components_are_those_of_all_pairs(table, monkeypatch, broadcast, words):
    if not broadcast:
        monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(near_duplicates, "COMPARED", 0)
    rows = near_docs()
    found = {r.doc_id: r for r in near_duplicates.components(table(rows), words=words).collect()}
    expected = plain.near_components(rows, length=words)
    assert {n: r.component_id for n, r in found.items()} == expected
    assert all(r.kept == (n == expected[n]) for n, r in found.items())
    assert all(r.n_shingles == len(plain.shingles(t, words)) for (n, t), r in zip(rows, map(found.get, range(len(rows)))))


def test_near_duplicates_of_odd_tables(table):
    rows = [(3, "a b c"), (3, "a b c"), (None, "A B  c"), (None, None), (9, ""), (8, "  "), (7, "c b a")]
    found = near_duplicates.components(table(rows)).collect()
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found)
    assert got == [(0, 0, True), (0, 3, False), (3, 3, True), (3, 3, True), (7, 7, True), (8, 8, True), (9, 9, True)]
    kept = near_duplicates.keep_one(table(rows)).collect()
    assert len(kept) == 6 and kept[0].asDict().keys() == table(rows).limit(1).collect()[0].asDict().keys()
    assert near_duplicates.components(table([])).count() == 0
    assert near_duplicates.components(table([(1, "a"), (2, "b c")])).filter("kept").count() == 2


def test_least_nodes_of_a_long_chain(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(200)] + [(500, 501)], "a bigint, b bigint")
    roots = {r.node: r.root for r in near_duplicates.connected(edges).collect()}
    assert set(roots.values()) == {0, 500} and roots[200] == 0 and roots[501] == 500


def check_shards(rows, found, leaves, most):
    assert len(found) == len(rows)
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r)
    for shard in by_shard.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r["size"]
    assert all(0 <= s < leaves for s in sizes)
    mean = sum(sizes.values()) / leaves
    assert max(abs(sizes[s] - mean) for s in range(leaves)) <= most


def test_shards_are_near_equal(table):
    draw = random.Random(1)
    rows = [(n, "x" * draw.randint(0, 2000), draw.choice(["en", "de", None]), f"src{n % 7}", n % 50)
            for n in range(3000)]
    rows += [(3000 + n, "same text " * 20, "en", "src0", 200) for n in range(300)]
    docs = table(rows).drop("shard", "slot", "size")
    found = kd_sharding.shard(docs).collect()
    check_shards(rows, found, 8, 3 * 60300)
    texts = {n: t for n, t, *_ in rows}
    assert len({r.shard for r in found if texts[r.doc_id] == "same text " * 20}) == 1
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 1 for r in found)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in found)
    alone = [r for r in rows if not r[1].startswith("same")]
    check_shards(alone, kd_sharding.shard(table(alone), leaves=5).collect(), 5, 3000 * 3)


def test_shards_of_odd_tables(table):
    rows = [(1, None), (1, None), (None, "é"), (2, ""), (3, "same"), (4, "same")]
    found = kd_sharding.shard(table(rows)).collect()
    assert sorted(r["size"] for r in found) == [1, 1, 1, 3, 5, 5]
    assert len({r.shard for r in found if r["size"] == 5}) == 1
    assert kd_sharding.shard(table([])).count() == 0
    assert {r.shard for r in kd_sharding.shard(table(rows), target_bytes=100).collect()} == {0}


def test_pipeline_keeps_what_it_should(spark, table, tmp_path):
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abcdefghijkl", k=draw.randint(2, 8)))
    clean = [" ".join(word() for _ in range(80)) for _ in range(300)]
    item = " ".join(word() for _ in range(30))
    junk = [" ".join(w + "###" for w in t.split()[:60]) for t in clean[:60]]
    near = [" ".join(t.split()[:-1] + ["changed"]) for t in clean[:20]]
    shared = " ".join(word() for _ in range(60))
    rows = [*clean, *junk, *near, clean[5], clean[7] + " " + item, clean[8] + "x\n" + shared, clean[9] + "y z\n" + shared, None, ""]
    rows = list(enumerate(rows))
    labels = [(n, int(n < 300), 0) for n in range(360)]
    table(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(range(300)) - kept == set()
    assert kept.isdisjoint(range(300, 360)) and kept.isdisjoint(range(360, 380))
    assert 380 not in kept and 381 not in kept


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_give_whole_results(spark, name):
    folder = "/root/testdata/sf0.001"
    found = queries.QUERIES[name](spark, folder)
    rows = found.count()
    tables = {"op2": "pages", "op11": "embeddings", "op12": "conversations"}
    table = spark.read.parquet(f"{folder}/{tables.get(name.partition('_')[0], 'documents')}.parquet")
    if name.startswith("op12_"):  # a row for each node: the root has all conversations
        assert found.filter("depth = 0").first().n_convs == table.select("conv_id").distinct().count()
        return
    total = table.count()
    assert 0 < rows < total if name.startswith("op1_") else rows == total
