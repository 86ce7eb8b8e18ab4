"""Small frames for tests."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql.types import LongType, StructField, StructType

from leadlake.schemas import RAW, RAW_TO_STAGING, STG_LEADS

T0 = datetime(2026, 8, 1, tzinfo=timezone.utc)

_RAW_DEFAULTS = {
    "Name": "Test User", "Job Title": "Data Analyst", "Company": "Test Company", "Industry": "Technology",
    "Location": "India", "Agent": "Ada", "SDR Status": "Connected", "Comment Status": "Replied",
    "Hot Score": "80", "Source": "Feed", "Prioritized": "Yes",
    "LinkedIn URL": "https://www.linkedin.com/in/test-user", "Added On": "2026-08-01",
    "Last Contacted": "2026-08-02", "Invite Sent At": "2026-08-01", "Connected At": "2026-08-03",
}


def raw(spark, *rows: dict):
    """Raw export rows with `src_ordinal`, defaults overridden by header."""
    filled = [tuple({**_RAW_DEFAULTS, **r}[h] for h in RAW_TO_STAGING) + (i,) for i, r in enumerate(rows)]
    schema = StructType([*RAW.fields, StructField("src_ordinal", LongType())])
    return spark.createDataFrame(filled, schema)


def url(n: int) -> str:
    return f"https://www.linkedin.com/in/u{n}"


def stg(spark, *rows: dict):
    """Staging rows; columns not given are null."""
    return spark.createDataFrame([tuple(r.get(c) for c in STG_LEADS.names) for r in rows], STG_LEADS)
