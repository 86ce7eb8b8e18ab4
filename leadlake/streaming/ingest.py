"""Streaming route: landed export files through the same load as the daily run."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from leadlake.plans.daily_run import Settings, run_load
from leadlake.session import as_path
from leadlake.sources.files import read_leads_csv, read_leads_json
from leadlake.sources.store import Store

#: What Spark's stream of whole files has of a file; only the path is read.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def landed_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The paths of files as they land, each once."""
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("path")


def stream_leads(
    spark: SparkSession,
    path: str,
    store: Store,
    name: str = "leads_stream",
    fmt: str = "csv",
    files_per_batch: int | None = None,
    settings: Settings = Settings(use_watermark=False),
    run_ts: datetime | None = None,
    multi_line: bool | None = None,
) -> StreamingQuery:
    """Start loading all files that have landed and stop when they are done; the next start takes new files.

    The stream finds the files; each micro-batch reads its own with the readers of the daily run, so headers may
    differ and malformed records are kept alike. `multi_line` is handed to them: line breaks in cells of CSV (by
    default yes), JSON arrays (by default no). The names of a micro-batch's files reach the driver.

    The stream's own checkpoint knows which files are done, so rows are not filtered by the watermark. Each
    micro-batch is one run with an id of its own: a batch that is replayed after a failure loads once. Runs
    enter the ledger under the stream's name, so its newest date is no watermark of the daily load.
    """
    settings = replace(settings, pipeline=name)
    read, lines = (read_leads_csv, True) if fmt == "csv" else (read_leads_json, False)
    lines = lines if multi_line is None else multi_line

    def load(batch: DataFrame, batch_id: int) -> None:
        here = Store(batch.sparkSession, store.root, store.buckets)
        files = sorted(as_path(batch.sparkSession, r.path) for r in batch.collect())
        if files:
            raw = read(batch.sparkSession, files, multi_line=lines)
            run_load(here, raw, f"{name}-{batch_id}", run_ts or datetime.now(timezone.utc), settings)

    return (
        landed_files(spark, path, files_per_batch)
        .writeStream.queryName(name)
        .option("checkpointLocation", f"{store.root}/_streams/{name}")
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )
