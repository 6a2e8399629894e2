"""Equi-joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits skewed sort-merge joins by itself, but not inside every plan
and not for shuffled hash joins.  Here the heavy keys are found by one counting pass
and only those are salted: the facts of a heavy key are spread over several slots and
the matching lookup rows are repeated once per slot.  Every fact row meets exactly the
lookup rows it would meet without salting, so inner, left, semi and anti joins keep
their results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# A key with more rows than this is split into slots of about this size.
HEAVY_ROWS = 1_000_000
# A key is heavy only if it also holds more than this part of all rows.  So there are fewer
# heavy keys than parts, and the collected and broadcast list is bounded by counting.
PARTS = 10_000

SALT = "_salt"


# Slot of a link or rank row in the graph loops, where all keys know their slot count.
SLOT = "_slot"


def slot_count(rows: Column, heavy_rows: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(heavy_rows))).cast("int")


def heaviest(counts: DataFrame, keys: list[str], rows: str, heavy_rows: int) -> list[Row]:
    """``(keys, slots)`` of all heavy keys in a table of row counts per key."""
    total = counts.agg(F.sum(rows)).first()[0] or 0
    least = max(heavy_rows, total // PARTS)
    return (
        counts.filter(F.col(rows) > least)
        .select(*keys, slot_count(F.col(rows), least).alias("_slots"))
        .collect()
    )


def heavy_keys(facts: DataFrame, keys: list[str], heavy_rows: int = HEAVY_ROWS) -> list[Row]:
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return heaviest(counts, keys, "_rows", heavy_rows)


def heavy_endpoints(edges: DataFrame, heavy_rows: int = HEAVY_ROWS) -> dict[str, list[Row]]:
    """Heavy ``Source`` and heavy ``Target`` keys of an edge table, from one pass."""
    ends = edges.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(end).alias("end"), F.col(end).alias("id"))
                    for end in ("Source", "Target")
                ]
            )
        ).alias("e")
    ).select("e.end", "e.id")
    found: dict[str, list[Row]] = {"Source": [], "Target": []}
    for row in heavy_keys(ends, ["end", "id"], heavy_rows):
        found[row["end"]].append(Row(**{row["end"]: row["id"], "_slots": row["_slots"]}))
    return found


def heavy_frame(facts: DataFrame, heavy: list[Row], keys: list[str]) -> DataFrame:
    """The heavy keys with their ``_slots`` as a frame to broadcast."""
    schema = StructType(
        [facts.schema[k] for k in keys] + [StructField("_slots", IntegerType())]
    )
    rows = [tuple(row[c] for c in [*keys, "_slots"]) for row in heavy]
    return F.broadcast(facts.sparkSession.createDataFrame(rows, schema))


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str,
    spread_by: list[str],
    heavy: list[Row],
    heavy_on: list[str] | None = None,
) -> DataFrame:
    """``facts`` joined to ``lookup`` on ``keys``, heavy fact keys salted.

    ``spread_by`` are fact columns that differ within a heavy key.  ``heavy`` comes from
    ``heavy_keys`` of the facts (or of a superset of them) and has fewer rows than
    ``PARTS``, so broadcasting it is safe; ``heavy_on`` names its keys when they are only
    some of ``keys``.  Without heavy keys this is the plain join.
    """
    if not heavy:
        return facts.join(lookup, keys, how)
    heavy_on = heavy_on or keys
    slots = heavy_frame(facts, heavy, heavy_on)
    n = F.coalesce(F.col("_slots"), F.lit(1))
    spread = facts.join(slots, heavy_on, "left").select(
        *[F.col(c) for c in facts.columns],
        F.pmod(F.xxhash64(*spread_by), n).cast("int").alias(SALT),
    )
    repeated = lookup.join(slots, heavy_on, "left").select(
        *[F.col(c) for c in lookup.columns],
        F.explode(F.sequence(F.lit(0), n - 1)).alias(SALT),
    )
    return spread.join(repeated, [*keys, SALT], how).drop(SALT)
