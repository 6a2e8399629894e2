"""The queries with SQL against DuckDB on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from topicpulse.llm import queries

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.is_dir(), reason="shared tables not present")


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, str(FOLDER))
    cursor = connection.execute(queries.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    order = lambda rows: sorted(rows, key=lambda r: [(x is not None, x) for x in r])
    assert order(tuple(r[c] for c in columns) for r in frame.collect()) == order(cursor.fetchall())


def odd_rows():
    words = [f"w{k} x{k * 7 % 11}" for k in range(40)]
    clean = [" ".join(words[n % 30 :] + words[: n % 30] + [f"u{n}a u{n}b"]) for n in range(1500)]
    junk = [" ".join(w + "##" for w in t.split()) for t in clean[:150]]
    return list(enumerate([*clean, *junk, None, "", "A b", "a B", "one"]))


@pytest.mark.parametrize("name", ["op4_quality_rules", "op5_near_duplicates"])
def test_query_matches_sql_where_rules_reject(spark, tmp_path, table, labelled, name):
    rows = odd_rows()
    frame = table(rows).select("doc_id", "text", "lang", "source", "n_chars")
    frame.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    marks = labelled([(n, int(n < 1500), 0) for n in range(1650)])
    marks.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    connection = duckdb.connect()
    for t in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    cursor = connection.execute(queries.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    found = queries.QUERIES[name](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(cursor.fetchall())
    if name.startswith("op4"):
        assert sum(r.rejected_by != "" for r in found) >= 150
