"""Every registered query against its SQL, on the smallest shared tables."""

from __future__ import annotations

import functools
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from topicpulse.queries import ORACLE, QUERIES, catalog
from topicpulse.queries.oracle import WALK_LIMIT, with_parts

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.is_dir(), reason="shared tables not present")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def shared_inputs():
    """Let the queries of this module share what they derive from the tables."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(catalog, "Inputs", functools.cache(catalog.Inputs))
        yield


def _sortable(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, tables, name):
    frame = driver.queries()[name](spark, str(FOLDER))
    columns = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=_sortable)
    cursor = tables.execute(driver.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_sortable)
    assert len(got) == len(expected)
    for mine, theirs in zip(got, expected):
        for a, b in zip(mine, theirs):
            if isinstance(a, float) and isinstance(b, float):
                assert math.isclose(a, b, abs_tol=1.5e-6), (mine, theirs)
            else:
                assert a == b, (mine, theirs)


def _longest(edges):
    """The longest shortest path: rounds until no node is reached by a further source."""
    nodes = {v: 1 << i for i, v in enumerate({v for e in edges for v in e})}
    reached, rounds = dict(nodes), 0
    while True:
        after = dict(reached)
        for s, t in edges:
            after[t] |= reached[s]
        if after == reached:
            return rounds
        reached, rounds = after, rounds + 1


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_walks_are_longer_than_any_shortest_path(scale):
    connection = duckdb.connect()
    for file in (FOLDER.parent / scale).glob("*.parquet"):
        source = f"{file}/*.parquet" if file.is_dir() else file
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{source}'")
    edges = connection.execute(with_parts("tr", "SELECT c, s, t FROM tr")).fetchall()
    for topic in {c for c, _, _ in edges}:
        own = [(s, t) for c, s, t in edges if c == topic]
        assert _longest(own) < WALK_LIMIT
        assert _longest(own + [(t, s) for s, t in own]) < WALK_LIMIT


def test_flagship(spark):
    records = driver.entry(spark)
    assert records.columns == ["id", "user_features_rf", "centralities_rf"]
    assert records.count() == 91
