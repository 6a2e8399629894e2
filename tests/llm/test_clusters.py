"""Clustering in dimension shards, against plain Python over whole vectors."""

from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from topicpulse.llm import sharded_lloyd

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, k, rounds, dimensions):
    kept = [
        (v, [math.floor(64 * x) for x in e])
        for v, e in rows
        if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)
    ]
    marks = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centres = [e for _, e in sorted(kept, key=marks)[:k]]

    def nearest(e):
        return min((sum((a - b) ** 2 for a, b in zip(e, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, e in kept:
            members.setdefault(nearest(e)[1], []).append(e)
        for j, own in members.items():
            centres[j] = [sum(column) // len(own) for column in zip(*own)]
    found = [(v, *nearest(e)[::-1]) for v, e in kept]
    out = []
    for v, j, d in found:
        mark = hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()
        out.append((v, j, d, sum(x for _, i, x in found if i == j), sum(x for _, _, x in found), mark))
    return out


def vectors(dimensions, count, seed):
    draw = random.Random(seed)
    rows = [(n, [draw.randint(-40, 40) / 16 for _ in range(dimensions)]) for n in range(count)]
    rows += [(1000 + n, rows[0][1]) for n in range(count // 2)]  # a third of all are equal
    odd = [0.5] * dimensions
    rows += [(5, odd), (5, odd), (None, odd), (7, None), (8, []), (9, odd[1:]), (10, odd + [1.0])]
    return rows + [(11, odd[1:] + [x]) for x in (None, math.nan, math.inf, -math.inf)]


def order(rows):
    return sorted(tuple(-1 if x is None else x for x in r) for r in rows)


@pytest.mark.parametrize("dimensions, block, k", [(6, 4, 4), (8, 2, 5), (3, 16, 2)])
def test_clusters_are_those_of_whole_vectors(spark, dimensions, block, k):
    rows = vectors(dimensions, 40, dimensions)
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(3)
    clashing = frame.select("*", *[F.lit("x").alias(c) for c in ("row", "cluster", "xs", "block", "d")])
    found = sharded_lloyd.cluster(clashing, k, 3, dimensions, block)
    assert ", ".join(f"{n} {t}" for n, t in found.dtypes) == sharded_lloyd.RESULT
    assert order(found.collect()) == order(plain(rows, k, 3, dimensions))


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-1.0, 0.0])]
    found = sharded_lloyd.cluster(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), 16, 3, 2)
    assert order(found.collect()) == order(plain(rows, 16, 3, 2))
    assert sharded_lloyd.cluster(spark.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0
    assert sharded_lloyd.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
