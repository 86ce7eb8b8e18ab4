"""Spellings of dates that a mixed-format parser reads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leadlake.functions.dates import parse_mixed_ts

SPELLINGS = {
    "2026-08-01 10:00 PM": "2026-08-01 22:00:00",
    "2026/08/01 10:00:00+02:00": "2026-08-01 08:00:00",
    "8/1/2026 10:00:00+02:00": "2026-08-01 08:00:00",
    "8/1/2026T10:00:00": "2026-08-01 10:00:00",
    "8/1/2026, 10:00 AM": "2026-08-01 10:00:00",
    "8/1/2026 10:11:12.1234567": "2026-08-01 10:11:12.123456",
    "01-Aug-26": "2026-08-01 00:00:00",
    "08-09-26": "2026-08-09 00:00:00",
    "Aug-01-2026": "2026-08-01 00:00:00",
    "2026.08.01": "2026-08-01 00:00:00",
    "20260801T101112": "2026-08-01 10:11:12",
    "202608011011": "2026-08-01 10:11:00",
    "Aug 2026": "2026-08-01 00:00:00",
    "Aug. 1, 2026": "2026-08-01 00:00:00",
    "1 August, 2026": "2026-08-01 00:00:00",
    "Sat Aug 01 2026": "2026-08-01 00:00:00",
    "Sat, 01 Aug 2026 10:00:00 GMT": "2026-08-01 10:00:00",
    "2026-08-01  10:00": "2026-08-01 10:00:00",
    "Saturday, August 1st, 2026 at": None,
    "August 1st, 2026": "2026-08-01 00:00:00",
    "Sat Aug  1 10:00:00 2026": "2026-08-01 10:00:00",
    "2026-08-01T10:00:00Z": "2026-08-01 10:00:00",
    "2026-08-01T10:00:00-0530": "2026-08-01 15:30:00",
    "8/1/2026 12:05 AM": "2026-08-01 00:05:00",
    "13/8/2026": "2026-08-13 00:00:00",
    "8/1/99": "1999-08-01 00:00:00",
    "2026-13-01": None,
    "2/30/2026": None,
    "8/1/2026 25:00": None,
    "8/1/2026 13:00 PM": None,
    "Augustus 1 2026": None,
    "12:30": None,
    "soon": None,
    "": None,
}


def test_spellings(spark):
    rows = spark.createDataFrame(list(SPELLINGS.items()), "text string, want string")
    read = rows.select("text", "want", parse_mixed_ts("text").cast("timestamp_ntz").cast("string").alias("got"))
    wrong = [(r.text, r.got, r.want) for r in read.collect() if (r.got or None) != (r.want and r.want.removesuffix(".000000"))]
    assert wrong == []


def test_missing_text_is_missing(spark):
    assert spark.range(1).select(parse_mixed_ts(F.lit(None).cast("string")).alias("t")).first().t is None


@pytest.mark.parametrize("text", ["2026-08-01", "08/01/2026", "1 Aug 2026"])
def test_plan_has_no_python(spark, text):
    plan = spark.createDataFrame([(text,)], "t string").select(parse_mixed_ts("t"))._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString()
