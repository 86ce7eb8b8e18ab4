"""Star schema: fact with surrogate keys, the reporting view and referential checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.stats import rows
from leadlake.functions.text import norm_agent, norm_status
from leadlake.operators.dims import Dims, canonical_status
from leadlake.schemas import FCT_LEADS_STAR, KEY_COLUMNS


class ReferentialError(RuntimeError):
    """Fact rows without a dimension key."""


def star_fact(fct: DataFrame, dims: Dims) -> DataFrame:
    """Fact rows with agent, status and date keys; agent and status come out normalised.

    Each dimension is reduced to one key per join value first (the highest), so no row can multiply. Spark
    chooses by bytes whether a dimension is broadcast or both sides are shuffled, where AQE splits hot values.
    """
    agents = (
        dims.agent.where("is_current")
        .groupBy(norm_agent("agent_name").alias("agent"))
        .agg(F.max("agent_key").alias("agent_key"))
    )
    days = dims.date.groupBy(F.col("full_date").alias("_added")).agg(
        F.max("date_key").alias("date_key")
    )
    keyed = fct.withColumns(
        {
            "agent": norm_agent("agent"),
            "lead_status": norm_status("lead_status"),
            "_added": F.to_date("added_on"),
        }
    )
    return (
        keyed.join(agents, "agent", "left")
        .join(canonical_status(dims.status), "lead_status", "left")
        .join(days, "_added", "left")
        .select(*FCT_LEADS_STAR.names)
    )


def missing_key_counts() -> list[Column]:
    """Aggregates that count the rows without each key."""
    return [
        F.count_if(F.col(k).isNull()).alias(f"missing_{k}s") for k in KEY_COLUMNS
    ]


def missing_keys(star: DataFrame) -> DataFrame:
    """One row: how many fact rows lack each key."""
    return star.agg(*missing_key_counts())


def require_keys(counts: dict[str, int]) -> None:
    """Gate on the counts of `missing_keys`."""
    found = {name: n for name, n in counts.items() if n}
    if found:
        raise ReferentialError(f"fact rows without dimension keys: {found}")


#: Columns of the narrow fact: the star fact without the text that dimensions carry.
FACT_COLUMNS = [
    "staging_id",
    *KEY_COLUMNS,
    *[
        c for c in FCT_LEADS_STAR.names
        if c not in ("staging_id", "agent", "sdr_status", "lead_status", *KEY_COLUMNS)
    ],
]


def fact_leads(star: DataFrame) -> DataFrame:
    return star.select(*FACT_COLUMNS)


#: Columns of the reporting view, in its order.
VIEW_COLUMNS = [
    "staging_id", "name", "job_title", "company", "industry", "location",
    "agent_key", "agent_name", "status_key", "lead_status",
    "date_key", "full_date", "year", "month", "month_name", "quarter", "day_of_month", "day_of_week",
    "comment_status", "hot_score", "source", "prioritized", "linkedin_url",
    "added_on", "last_contacted", "invite_sent_at", "connected_at", "record_updated_at",
    "is_contacted", "is_invite_sent", "is_connected", "is_prioritized", "is_hot_lead",
    "days_to_connection",
]


def vw_leads_analytics(fact: DataFrame, dims: Dims) -> DataFrame:
    """Narrow fact with its dimension attributes; a key without a dimension row shows as null."""
    keyed = fact
    for dim, key in zip((dims.agent, dims.status, dims.date), KEY_COLUMNS, strict=True):
        # the view shows the key of the dimension row, null when there is none
        side = dim.withColumnRenamed(key, f"_{key}")
        keyed = (
            keyed.join(side, F.col(key) == F.col(f"_{key}"), "left")
            .drop(key)
            .withColumnRenamed(f"_{key}", key)
        )
    return keyed.select(*VIEW_COLUMNS)


def orphans(fact: DataFrame, dim: DataFrame, key: str, count_null: bool = False) -> DataFrame:
    """One row `orphan_count`: fact rows whose key has no dimension row; null keys only on request.

    The fact is counted per key before the join, so a hot key is one row by then.
    """
    per_key = fact.groupBy(key).agg(rows().alias("_rows"))
    if not count_null:
        per_key = per_key.where(F.col(key).isNotNull())
    lost = per_key.join(dim.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_count"))


def status_unmatched(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """One row `unmatched_rows`: fact rows whose normalised status is no status of the dimension."""
    per_status = fct.groupBy(norm_status("lead_status").alias("_status")).agg(
        rows().alias("_rows")
    )
    known = dim.select(norm_status("lead_status").alias("_status"))
    lost = per_status.join(known, "_status", "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("unmatched_rows"))
