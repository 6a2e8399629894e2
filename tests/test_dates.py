from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from topicpulse.functions import created_date, dates, parse_created_at


def _parse(spark, values, mode="null"):
    frame = spark.createDataFrame([(v,) for v in values], "s string")
    return [
        (row.at, row.day)
        for row in frame.select(
            parse_created_at(F.col("s"), mode).alias("at"),
            created_date(F.col("s"), mode).alias("day"),
        ).collect()
    ]


def test_parses_padded_and_short_days(spark):
    parsed = _parse(
        spark,
        [
            "Wed Aug 27 13:08:45 +0000 2008",
            "Thu Aug  7 00:00:01 +0000 2008",
            "Thu Aug 7 00:00:01 +0000 2008",
            "sat FEB 29 23:59:59 +0000 2020",
        ],
    )
    assert parsed == [
        (dt.datetime(2008, 8, 27, 13, 8, 45), dt.date(2008, 8, 27)),
        (dt.datetime(2008, 8, 7, 0, 0, 1), dt.date(2008, 8, 7)),
        (dt.datetime(2008, 8, 7, 0, 0, 1), dt.date(2008, 8, 7)),
        (dt.datetime(2020, 2, 29, 23, 59, 59), dt.date(2020, 2, 29)),
    ]


def test_usual_values_are_not_split(spark):
    """Neither of the two ways takes what the other one refuses."""
    usual, spaced = "Wed Aug 27 13:08:45 +0000 2008", "Wed  Aug 27\t13:08:45 +0000  2008"
    at = dt.datetime(2008, 8, 27, 13, 8, 45)
    odd = ["Wed Aug 32 13:08:45 +0000 2008", "Wed Aug 27 13:60:45 +0000 2008", usual + " "]
    parsed = _parse(spark, [usual, spaced, usual.upper(), *odd])
    assert parsed == [(at, at.date())] * 3 + [(None, None)] * 3
    assert not re.match(dates.USUAL_PATTERN.replace("^(?i)", "(?i)^").replace("\\z", "$"), spaced)
    assert re.match(dates.USUAL_PATTERN.replace("^(?i)", "(?i)^").replace("\\z", "$"), usual)


def test_bad_dates_become_null_on_request(spark):
    bad = [
        None,
        "",
        "2008-08-27 13:08:45",
        "Wed Aug 27 13:08:45 +0200 2008",
        "Wed Xyz 27 13:08:45 +0000 2008",
        "Sat Feb 30 00:00:00 +0000 2020",
        "Wed Aug 27 25:08:45 +0000 2008",
    ]
    assert _parse(spark, bad) == [(None, None)] * len(bad)


@pytest.mark.parametrize("value", [None, "yesterday", "Sat Feb 30 00:00:00 +0000 2020"])
def test_bad_dates_raise_by_default(spark, value):
    with pytest.raises(Exception, match="not a post timestamp"):
        _parse(spark, [value], "raise")


def test_result_does_not_depend_on_the_session_zone(spark):
    text = "Sun Mar 31 02:30:00 +0000 2024"
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert _parse(spark, [text], "raise") == [
            (dt.datetime(2024, 3, 31, 2, 30), dt.date(2024, 3, 31))
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        parse_created_at("x", "ignore")
