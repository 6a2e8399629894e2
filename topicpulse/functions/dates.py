"""Parsing of post timestamps such as ``Wed Aug 27 13:08:45 +0000 2008``.

The result is a ``timestamp_ntz``, so neither the clock time nor the calendar day
depends on the session time zone.  Only built-in expressions are used: one regular
expression check and one cast per row, all inside generated code.  The usual width has its
parts at fixed places; only other values are split, which costs more than all the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the timestamp format.
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
CREATED_AT_PATTERN = (
    r"^(?i)(" + "|".join(WEEKDAYS) + r")\s+(" + "|".join(MONTHS) + r")"
    r"\s+\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}\s+\+0000\s+\d{4}$"
)
# All fields at full width with one space between them.
USUAL_PATTERN = (
    r"^(?i)(?:" + "|".join(WEEKDAYS) + r") (?:" + "|".join(MONTHS) + r")"
    r" \d\d \d\d:\d\d:\d\d \+0000 \d{4}\z"
)


def _iso(year: Column, month: Column, day: Column, time: Column) -> Column:
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(month))
    return F.concat_ws(" ", F.concat_ws("-", year, number.cast("string"), day), time)


def parse_created_at(created_at: Column, on_bad_date: str = "raise") -> Column:
    """Timestamp of a post.

    ``on_bad_date="raise"`` fails the job on a null or malformed value,
    ``on_bad_date="null"`` yields null for it.
    """
    if on_bad_date not in ("raise", "null"):
        raise ValueError(f"on_bad_date must be 'raise' or 'null', not {on_bad_date!r}")
    token = F.split(created_at, r"\s+")
    part = lambda start, length: F.substring(created_at, start, length)
    usual = _iso(part(27, 4), part(5, 3), part(9, 2), part(12, 8))
    other = _iso(token[5], token[1], token[2], token[3])
    parsed = (
        F.when(created_at.rlike(USUAL_PATTERN), usual)
        .when(created_at.rlike(CREATED_AT_PATTERN), other)
        .try_cast("timestamp_ntz")
    )
    if on_bad_date == "null":
        return parsed
    message = F.concat(
        F.lit("not a post timestamp: "), F.coalesce(created_at, F.lit("null"))
    )
    return F.coalesce(parsed, F.raise_error(message).cast("timestamp_ntz"))


def created_date(created_at: Column, on_bad_date: str = "raise") -> Column:
    """Calendar day of a post."""
    return F.to_date(parse_created_at(created_at, on_bad_date))
