from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns with names that operators use inside.
CLASHES = "words ids key cid rank root size shard slot n_lines secrets bands row at".split()


@pytest.fixture
def table(spark):
    """Makes a table of documents out of ``(doc_id, text)`` or whole rows."""

    def make(rows):
        full = [
            (*r, "en", "src0", None if r[1] is None else len(r[1])) if len(r) == 2 else r
            for r in rows
        ]
        frame = spark.createDataFrame(full, SCHEMA)
        return frame.select("*", *[F.lit("x").alias(c) for c in CLASHES])

    return make


@pytest.fixture
def labelled(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture
def benchmark_table(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")
