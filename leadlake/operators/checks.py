"""Warehouse verification, run records and alert rules."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions.stats import rows
from leadlake.operators.dims import Dims
from leadlake.operators.star import orphans
from leadlake.schemas import ALERTS, KEY_COLUMNS, PIPELINE_RUNS


def schema_of(df: DataFrame) -> DataFrame:
    """Rows (name, type, nullable) of a table's columns."""
    fields = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(fields, "name string, type string, nullable boolean")


def uniqueness(df: DataFrame, key: str = "staging_id") -> DataFrame:
    """One row: rows, distinct keys, and 1 when they agree."""
    return df.agg(
        rows().alias("total_rows"), F.count_distinct(key).alias("unique_ids")
    ).withColumn("unique_ids_match", (F.col("total_rows") == F.col("unique_ids")).cast("int"))


def duplicate_ids(df: DataFrame, key: str = "staging_id") -> DataFrame:
    """One row `duplicates`: how many keys occur more than once."""
    repeated = df.groupBy(key).agg(rows().alias("_n")).where("_n > 1")
    return repeated.agg(rows().alias("duplicates"))


def scd_check(dim: DataFrame) -> DataFrame:
    """One row: type-2 figures of a dimension and 1 when its structure holds."""
    counts = dim.agg(
        rows().alias("total"),
        F.count_if("is_current").alias("current_rows"),
        F.count("valid_from").alias("valid_from_rows"),
    )
    sound = (
        (F.col("total") > 0)
        & (F.col("current_rows") > 0)
        & (F.col("valid_from_rows") == F.col("total"))
    )
    return counts.withColumn("scd_valid", sound.cast("int"))


def _count_row(df: DataFrame, name: str, as_column: str) -> DataFrame:
    return df.agg(rows().alias("rows")).select(F.lit(name).alias(as_column), "rows")


def dim_counts(dims: Dims) -> DataFrame:
    """Rows (dimension, rows)."""
    agent = _count_row(dims.agent, "dim_agent", "dimension")
    status = _count_row(dims.status, "dim_lead_status", "dimension")
    return agent.unionByName(status).unionByName(_count_row(dims.date, "dim_date", "dimension"))


def _key_counts(star: DataFrame, dims: Dims) -> DataFrame:
    """One row: fact rows, ids that occur more than once, and rows whose key has no dimension row.

    One pass: every row offers its id and its keys, tasks count them before they send, and the counts meet the
    dimensions' keys where they are. A hot key is one row a task.
    """
    offered = F.array(
        F.struct(F.lit("id").alias("kind"), F.col("staging_id").alias("value")),
        *[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in KEY_COLUMNS],
    )
    counted = star.select(F.inline(offered)).groupBy("kind", "value").agg(rows().alias("_n"))
    known = reduce(
        DataFrame.unionByName,
        [
            dim.select(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value"), F.lit(True).alias("_known"))
            for k, dim in zip(KEY_COLUMNS, (dims.agent, dims.status, dims.date), strict=True)
        ],
    ).distinct()
    found = counted.join(known, ["kind", "value"], "left")

    def added(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0).cast("long"))

    lost = F.col("_known").isNull()
    return found.agg(
        added(F.col("kind") == "id").alias("fact_rows"),
        F.count_if((F.col("kind") == "id") & (F.col("_n") > 1)).alias("duplicate_ids"),
        *[
            added(lost & (F.col("kind") == k)).alias(name)
            for k, name in zip(KEY_COLUMNS, ("orphan_agents", "orphan_statuses", "orphan_dates"), strict=True)
        ],
    )


def verify_star(star: DataFrame, dims: Dims) -> DataFrame:
    """Rows (check, value, passed), the last one the overall verdict.

    The verdict needs fact rows, no duplicate id and no orphan key (a null key is an orphan); the structure
    of the agent history is reported beside it. The fact is read once.
    """
    counts = _key_counts(star, dims)
    good = {c: F.col(c) > 0 if c == "fact_rows" else F.col(c) == 0 for c in counts.columns}
    failed = reduce(Column.__add__, [(~holds).cast("long") for holds in good.values()])

    def row(name: str, value: Column, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), value.cast("long").alias("value"), passed.cast("int").alias("passed"))

    checks = [row(c, F.col(c), holds) for c, holds in good.items()]
    scd = scd_check(dims.agent).select(F.struct("total", "scd_valid").alias("scd")).scalar()
    structure = row("scd_structure", F.col("_scd.total"), F.col("_scd.scd_valid"))
    every = F.array(*checks, structure, row("verdict", failed, failed == 0))
    return counts.withColumn("_scd", scd).select(F.inline(every))


def validate_warehouse(star: DataFrame, dims: Dims) -> bool:
    """Raise on duplicate ids or orphan keys (null keys aside), else True."""
    facts = uniqueness(star).first()
    if not facts.unique_ids_match:
        raise RuntimeError("duplicate staging ids in the fact table")
    for dim, key in ((dims.date, "date_key"), (dims.agent, "agent_key"), (dims.status, "status_key")):
        lost = orphans(star, dim, key).first().orphan_count
        if lost:
            raise RuntimeError(f"validation failed: {lost} orphan {key}s")
    return True


def run_record(
    spark: SparkSession,
    run_id: str,
    pipeline_name: str,
    started_at: datetime,
    completed_at: datetime,
    rows_read: int,
    rows_loaded: int,
    status: str,
    watermark_start: datetime | None = None,
    watermark_end: datetime | None = None,
    error_message: str | None = None,
) -> DataFrame:
    """The ledger row of one run."""
    row = (
        run_id, pipeline_name, started_at, completed_at, rows_read, rows_loaded, status,
        watermark_start, watermark_end, error_message,
    )
    return spark.createDataFrame([row], PIPELINE_RUNS)


def alert_events(runs: DataFrame, dq: DataFrame, max_seconds: float = 300) -> DataFrame:
    """Alerts as rows: failed runs, quality below its threshold, successful runs that took too long."""
    seconds = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at")) / 1_000_000
    failed = runs.where("status = 'FAILED'").select(
        "run_id",
        F.lit("pipeline_failure").alias("event"),
        F.lit("CRITICAL").alias("severity"),
        F.col("error_message").alias("detail"),
    )
    slow = runs.where((F.col("status") == "SUCCESS") & (seconds > max_seconds)).select(
        "run_id",
        F.lit("anomalous_run_duration").alias("event"),
        F.lit("WARNING").alias("severity"),
        F.concat(F.lit("duration_seconds="), F.round(seconds, 3).cast("string")).alias("detail"),
    )
    poor = dq.where("dq_status <> 'PASS'").select(
        F.col("dq_run_id").alias("run_id"),
        F.lit("dq_threshold_breach").alias("event"),
        F.lit("CRITICAL").alias("severity"),
        F.concat(F.lit("dq_score="), F.round("composite_dq_score", 2).cast("string")).alias("detail"),
    )
    return failed.unionByName(slow).unionByName(poor).select(*ALERTS.names)


def table_presence(spark: SparkSession, present: Iterable[tuple[str, bool]]) -> DataFrame:
    """Rows (table, exists) with exists as 0 or 1."""
    found = [(name, int(there)) for name, there in present]
    return spark.createDataFrame(found, "table string, exists int")
