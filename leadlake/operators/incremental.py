"""High-water mark, incremental filter and upsert."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


PIPELINE = "leads_ingestion"


def current_watermark(runs: DataFrame, pipeline: str = PIPELINE) -> DataFrame:
    """One row: the newest mark that a successful run of the pipeline left, or null."""
    done = runs.where((F.col("pipeline_name") == pipeline) & (F.col("status") == "SUCCESS"))
    return done.agg(F.max("watermark_end").alias("watermark"))


def utc(naive: datetime | None) -> datetime | None:
    """A wall-clock reading of the UTC session as a moment in time."""
    return naive and naive.replace(tzinfo=timezone.utc)


def moment(mark: DataFrame) -> datetime | None:
    """The one scalar a run needs on the driver: the value of a one-row watermark frame."""
    return utc(mark.select(F.col("watermark").cast("timestamp_ntz").alias("w")).first().w)


def newest(df: DataFrame) -> DataFrame:
    """One row: the newest `record_updated_at`, or null."""
    return df.agg(F.max("record_updated_at").alias("watermark"))


def incremental_rows(
    src: DataFrame, watermark: datetime | None, overlap: timedelta | None = None
) -> DataFrame:
    """Rows strictly newer than the mark; rows without any date never qualify.

    The mark is a literal, so the filter reaches the parquet scan. `overlap` re-reads that much time below
    the mark to pick up late rows; the upsert makes re-reading safe.
    """
    if watermark is None:
        return src
    return src.where(F.col("record_updated_at") > F.lit(watermark - (overlap or timedelta(0))))


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "staging_id") -> DataFrame:
    """Existing rows whose key does not come in again, plus all incoming rows."""
    kept = existing.join(incoming.select(key), key, "left_anti")
    return kept.select(incoming.columns).unionByName(incoming)


def incremental_step(
    src: DataFrame,
    existing: DataFrame,
    watermark: datetime | None,
    mode: str = "incremental",
    overlap: timedelta | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(new staging content, one-row new watermark).

    `full` and a first run without a mark take the source as it is. An incremental run upserts the newer
    rows; when there are none, staging and mark stay as they were.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "full" or watermark is None:
        return src, newest(src)
    rows = incremental_rows(src, watermark, overlap)
    mark = newest(rows).select(
        F.greatest("watermark", F.lit(watermark).cast("timestamp")).alias("watermark")
    )
    return upsert(existing, rows), mark
