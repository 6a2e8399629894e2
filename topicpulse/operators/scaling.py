"""Scaling every (measure, topic) value over all merged records.

The values are unfolded to one row per measure and topic, whose bounds one aggregation
finds; they are a few numbers per field of the output and become literals of one
projection.  There is no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from topicpulse.functions import topic_struct, zero_if_null
from topicpulse.sources.schemas import CENTRALITY_MEASURES, FEATURE_MEASURES, RAW_FIELDS

# Digits kept, and the value of a column that does not vary.
DIGITS = 7
CONSTANT_MINMAX = 0.5
CONSTANT_STD = 0.0

METHODS = ("minmax", "std")


def _value(column: str, measure: str, topic: str) -> Column:
    return zero_if_null(F.col(column).getField(measure).getField(topic))


def _bounds(
    merged: DataFrame, cells: dict[tuple[str, str, str], Column], methods: dict[str, str]
) -> dict[tuple[str, str, str], tuple[float, ...]]:
    """``(min, max)`` or ``(stddev,)`` of every cell, from one pass."""
    if not cells:
        return {}
    long = merged.select(F.posexplode(F.array(*cells.values())).alias("cell", "value"))
    stats = long.groupBy("cell").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.stddev_samp("value").alias("sd")
    )
    rows = {row["cell"]: row for row in stats.collect()}
    found = {}
    for at, cell in enumerate(cells):
        names = ("low", "high") if methods[cell[0]] == "minmax" else ("sd",)
        found[cell] = tuple((rows[at][n] if at in rows else None) or 0.0 for n in names)
    return found


def _scaled(value: Column, bounds: tuple[float, ...]) -> Column:
    if len(bounds) == 2:
        low, high = bounds
        if high == low:
            return F.lit(CONSTANT_MINMAX)
        return F.round((value - F.lit(low)) / F.lit(high - low), DIGITS)
    if bounds[0] == 0.0:
        return F.lit(CONSTANT_STD)
    return F.round(value / F.lit(bounds[0]), DIGITS)


def scale_records(
    merged: DataFrame,
    topics: Sequence[str],
    centrality_topics: Sequence[str],
    method: str = "minmax",
    keep_raw: bool = False,
    features_column: str = "user_features",
    centralities_column: str = "centralities",
    counted: Observation | None = None,
) -> DataFrame:
    """Records with scaled measures, nested like the input.

    ``minmax`` maps each column to [0, 1] (0.5 if constant); ``std`` divides features by
    their sample deviation without centring (0 if constant).  Centralities always use
    ``minmax``.  Nulls count as 0.  ``keep_raw`` carries the per-user counts along.  A
    struct that has no topics or that ``merged`` lacks is left out.  ``counted`` gets the
    ``rows`` of ``merged`` while the bounds are found.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    layout = [
        (features_column, FEATURE_MEASURES, topics),
        (centralities_column, CENTRALITY_MEASURES, centrality_topics),
    ]
    layout = [part for part in layout if part[2] and part[0] in merged.columns]
    methods = {features_column: method, centralities_column: "minmax"}
    cells = {
        (column, measure, topic): _value(column, measure, topic)
        for column, measures, names in layout
        for measure in measures
        for topic in names
    }
    source = merged
    if counted is not None and cells:
        source = merged.observe(counted, F.count(F.lit(1)).alias("rows"))
    bounds = _bounds(source, cells, methods)
    output = [F.col("id")]
    for column, measures, names in layout:
        fields = [
            topic_struct(
                {t: _scaled(cells[column, m, t], bounds[column, m, t]) for t in names}, m
            )
            for m in measures
        ]
        if keep_raw and column == features_column:
            fields += [F.col(column).getField(f).alias(f) for f in RAW_FIELDS]
        output.append(F.struct(*fields).alias(column))
    return merged.select(*output)


def unnest(
    records: DataFrame, column: str, measures: Sequence[str], topics: Sequence[str]
) -> DataFrame:
    """``id, measure, category, value`` from one nested column of the records."""
    cells = [
        F.struct(
            F.lit(m).alias("measure"),
            F.lit(t).alias("category"),
            F.col(column).getField(m).getField(t).alias("value"),
        )
        for m in measures
        for t in topics
    ]
    return records.select("id", F.inline(F.array(*cells)))
