"""Row counts at stage boundaries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def stage_counts(stages: Mapping[str, DataFrame], known: Mapping[str, int] | None = None) -> DataFrame:
    """``stage, rows`` for the named frames; those with a ``known`` count aren't read."""
    known = {name: rows for name, rows in (known or {}).items() if name in stages}
    counted = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, frame in stages.items()
        if name not in known
    ]
    if known:
        spark = next(iter(stages.values())).sparkSession
        counted.append(spark.createDataFrame(list(known.items()), "stage string, rows bigint"))
    return reduce(DataFrame.unionByName, counted)
