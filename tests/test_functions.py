"""Scalar functions against plain Python."""

from __future__ import annotations

import hashlib
import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadlake.functions import dates, stats, text


def column(spark, values, fn, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.out for r in df.select("i", fn("v").alias("out")).orderBy("i").collect()]


def test_lead_id_is_stable_and_32_hex_digits(spark):
    url = "https://www.linkedin.com/in/test-user"
    first, second = column(spark, [url, url], text.lead_id)
    assert first == second == hashlib.sha256(url.encode()).hexdigest()[:32]


def test_lead_id_ignores_case_and_surrounding_whitespace(spark):
    urls = [
        "https://www.linkedin.com/in/Test-User",
        " HTTPS://www.linkedin.com/in/test-user ",
        "\thttps://www.linkedin.com/in/test-user \n",
        "　https://www.linkedin.com/in/test-user\x1f",
    ]
    assert len(set(column(spark, urls, text.lead_id))) == 1


def test_lead_id_of_missing_url_is_null(spark):
    assert column(spark, [None, "", "   ", "\t "], text.lead_id) == [None] * 4


def test_strip_equals_python_strip(spark):
    values = [c + "a" + c + "b" + c for c in text.WHITESPACE] + ["", " ", "​x", "x y"]
    assert column(spark, values, text.strip) == [v.strip() for v in values]


def test_status_spellings_fall_together(spark):
    values = ["Invite Sent", " invite sent ", "invite_sent", "INVITE_SENT\t"]
    assert set(column(spark, values, text.norm_status)) == {"invite_sent"}


DATES = {
    "2026-08-01": "2026-08-01 00:00:00",
    "8/1/2026": "2026-08-01 00:00:00",
    "2026/08/01": "2026-08-01 00:00:00",
    "20260801": "2026-08-01 00:00:00",
    "Aug 1, 2026": "2026-08-01 00:00:00",
    "August 1, 2026": "2026-08-01 00:00:00",
    "2026-08": "2026-08-01 00:00:00",
    "08-09-2026": "2026-08-09 00:00:00",
    "13/1/2026": "2026-01-13 00:00:00",
    "2026": "2026-01-01 00:00:00",
    "1 Aug 2026 10:00": "2026-08-01 10:00:00",
    "01-Aug-2026": "2026-08-01 00:00:00",
    "8/1/2026 3:05 PM": "2026-08-01 15:05:00",
    "8/1/2026 15:05:06": "2026-08-01 15:05:06",
    " 2026-08-01 10:11:12 ": "2026-08-01 10:11:12",
    "2026-08-01T10:11:12+05:30": "2026-08-01 04:41:12",
    "2026-08-01T10:11:12Z": "2026-08-01 10:11:12",
    "garbage": None,
    "2026-13-45": None,
    "99/99/2026": None,
    "12345": None,
    "": None,
    None: None,
}


def test_mixed_dates(spark):
    got = column(spark, list(DATES), lambda c: dates.parse_mixed_ts(c).cast("timestamp_ntz").cast("string"))
    assert dict(zip(DATES, got, strict=True)) == DATES


def test_calendar_columns_equal_python(spark):
    days = [date(2019, 12, 25) + timedelta(days=i) for i in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.full_date: r for r in df.select(*[c.alias(n) for n, c in dates.calendar_columns(F.col("d")).items()]).collect()}
    for d in days:
        r = got[d]
        assert r.date_key == int(d.strftime("%Y%m%d"))
        assert (r.year, r.month, r.day_of_month) == (d.year, d.month, d.day)
        assert r.quarter == (d.month - 1) // 3 + 1
        assert (r.month_name, r.day_of_week) == (d.strftime("%B"), d.strftime("%A"))
        assert r.week == int(d.strftime("%U"))


def wilson(s, n, z=1.96):
    if s == 0:
        return 0.0
    p = s / n
    middle = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return max(0.0, middle - half)


def test_wilson_bound(spark):
    pairs = [(s, n) for n in (1, 2, 29, 30, 44, 468, 10**9) for s in {0, 1, n // 3, n}]
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(pairs)], "i int, s long, n long")
    got = df.orderBy("i").select(stats.wilson_lower(F.col("s"), F.col("n"), 1.96).alias("w")).collect()
    for (s, n), row in zip(pairs, got, strict=True):
        assert row.w == pytest.approx(wilson(s, n), rel=1e-9, abs=1e-15)
        assert row.w == 0.0 or s > 0


def test_wilson_bound_of_huge_groups_does_not_overflow(spark):
    n = 4 * 10**12
    df = spark.createDataFrame([(n // 2, n)], "s long, n long")
    assert df.select(stats.wilson_lower(F.col("s"), F.col("n"), 1.96)).first()[0] == pytest.approx(0.5, abs=1e-5)


def test_proportion_z(spark):
    rows = [(0.5, 0.4, 100), (0.5, 0.0, 100), (0.5, 1.0, 100), (0.5, 0.4, 0)]
    df = spark.createDataFrame(rows, "r double, b double, n long")
    got = [x[0] for x in df.select(stats.proportion_z(F.col("r"), F.col("b"), F.col("n"))).collect()]
    assert got[0] == pytest.approx(0.1 / math.sqrt(0.4 * 0.6 / 100))
    assert got[1:] == [0.0, 0.0, 0.0]


def test_midnights_not_hours_count_as_days(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 8, 1, 23, 59), datetime(2026, 8, 2, 0, 1)), (datetime(2026, 8, 3), datetime(2026, 8, 1))],
        "a timestamp_ntz, c timestamp_ntz",
    )
    got = df.select(F.datediff(F.to_date("c"), F.to_date("a"))).collect()
    assert [r[0] for r in got] == [1, -2]
