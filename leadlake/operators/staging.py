"""Raw export rows to typed staging rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.dates import parse_mixed_ts
from leadlake.functions.text import lead_id, strip
from leadlake.operators.dedup import keep_last
from leadlake.schemas import DATE_COLUMNS, RAW_TO_STAGING, SOURCE_ORDER, STAGING_COLUMNS


def _timestamp(df: DataFrame, name: str) -> Column:
    is_text = df.schema[name].dataType.simpleString() in ("string", "void")
    return (parse_mixed_ts(name) if is_text else F.col(name).cast("timestamp")).alias(name)


def _score(df: DataFrame) -> Column:
    is_text = df.schema["hot_score"].dataType.simpleString() in ("string", "void")
    number = strip("hot_score").try_cast("double") if is_text else F.col("hot_score").cast("double")
    return F.when(~F.isnan(number), number).alias("hot_score")


def identify(raw: DataFrame) -> DataFrame:
    """Rename the source headers and add the lead id."""
    return raw.withColumnsRenamed(RAW_TO_STAGING).withColumn("staging_id", lead_id("linkedin_url"))


def type_columns(df: DataFrame, run_ts: datetime, also: list[str] | None = None) -> DataFrame:
    """Parse dates and scores and fix the staging column list. NaN scores become null."""
    typed = df.select(
        *[
            _timestamp(df, c) if c in DATE_COLUMNS else _score(df) if c == "hot_score" else c
            for c in ("staging_id", *RAW_TO_STAGING.values())
        ],
        *(also or []),
    )
    return typed.withColumns(
        {
            "record_updated_at": F.greatest(*DATE_COLUMNS),
            "load_timestamp": F.lit(run_ts).cast("timestamp"),
        }
    ).select(*STAGING_COLUMNS, *(also or []))


def stage_leads(
    raw: DataFrame,
    run_ts: datetime,
    order: list[str] = SOURCE_ORDER,
    dedup_nulls: bool = True,
    copies: str | None = None,
) -> DataFrame:
    """Raw rows to staging rows, the last row per lead id, in one shuffle.

    Rows without a URL share the null id and collapse to one; `dedup_nulls=False` keeps each of them,
    spread over all tasks, so that every one reaches the dead letters. `copies` names a column to count the
    raw rows behind each staging row in.
    """
    leads, also = identify(raw), [copies] if copies else []
    rest = [c for c in leads.columns if c not in ("staging_id", *RAW_TO_STAGING.values())]
    if dedup_nulls:
        return type_columns(keep_last(leads, ["staging_id"], order, copies, rest), run_ts, also)
    is_nameless = F.col("staging_id").isNull()
    named = keep_last(leads.where(~is_nameless), ["staging_id"], order, copies, rest)
    nameless = leads.where(is_nameless)
    if copies:
        nameless = nameless.withColumn(copies, F.lit(1).cast("long"))
    return type_columns(named, run_ts, also).unionByName(type_columns(nameless, run_ts, also))
