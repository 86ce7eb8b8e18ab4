"""Sums that loads maintain: reports, quality counts and risk figures without a scan of the leads.

Every lead has one narrow row in an index: a digest of its staging row, and its share in the sums. A load takes the
shares of the old versions of changed leads off the sums and puts the new ones on, so its cost follows the increment.
What depends on the day of asking (leads that wait for an answer since some day, dates ahead of the load's clock) is
kept by that day, so any later day can be asked for.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.stats import percent
from leadlake.functions.text import norm_agent, norm_status
from leadlake.operators import quality, reports
from leadlake.operators.dims import Dims, canonical_status
from leadlake.operators.risk import DEFAULT, RiskParams, replied
from leadlake.schemas import COUNTED, LEAD_INDEX, LEAD_SUMS, STAGING_COLUMNS, SUM_COUNTS, SUM_KEYS


def _conditions() -> dict[str, Column]:
    """What of a fact row is counted, by the names of `COUNTED`."""
    return {
        "contacted_leads": F.col("is_contacted") == 1,
        "invite_sent_leads": F.col("is_invite_sent") == 1,
        "connected_leads": F.col("is_connected") == 1,
        "prioritized_leads": F.col("is_prioritized") == 1,
        "hot_leads": F.col("is_hot_lead") == 1,
        "replied_leads": replied(),
        "rate_limited_leads": reports.rate_limited(),
        **quality.completeness(),
        **quality.validity(),
        "dated_rows": F.col("record_updated_at").isNotNull(),
        "rows_with_url": F.col("linkedin_url").isNotNull(),
    }


def digests() -> list[Column]:
    """Two 64-bit hashes of a staging row but for its load time. Nulls enter as a mask: the hash skips them."""
    columns = STAGING_COLUMNS[:-1]
    mask = F.lit(0)
    for bit, name in enumerate(columns):
        mask = mask.bitwiseOR(F.when(F.col(name).isNull(), 1 << bit).otherwise(0))
    return [
        F.xxhash64(mask, *columns).alias("digest_1"),
        F.xxhash64(*reversed(columns), mask, F.lit(17)).alias("digest_2"),
    ]


def index_rows(fct: DataFrame) -> DataFrame:
    """The index row of each fact row."""
    conditions = _conditions()
    flags = F.lit(0)
    for bit, name in enumerate(COUNTED):
        flags = flags.bitwiseOR(F.when(conditions[name], 1 << bit).otherwise(0))
    waits = F.col("invite_sent_at").isNotNull() & F.col("connected_at").isNull()
    ahead = F.col("record_updated_at") > F.col("load_timestamp")
    return fct.select(
        "staging_id",
        *digests(),
        "agent",
        "lead_status",
        "source",
        "industry",
        F.to_date("added_on").alias("added_day"),
        F.when(waits, F.to_date("invite_sent_at")).alias("waiting_since"),
        F.when(ahead, F.col("record_updated_at")).alias("ahead_until"),
        "days_to_connection",
        flags.alias("flags"),
    ).select(*LEAD_INDEX.names)


def _key(kind: str, **values: str) -> Column:
    named = {name: F.col(column) for name, column in values.items()}
    return F.struct(
        F.lit(kind).alias("kind"),
        *[named.get(c, F.lit(None)).cast(t).alias(c) for c, t in SUM_KEYS.items() if c != "kind"],
    )


def _keys() -> Column:
    """All sums that an index row has a share in."""
    return F.array(
        _key("all"),
        _key("agent", agent="agent"),
        _key("status", lead_status="lead_status"),
        _key("day", day="added_day"),
        _key("source", source="source"),
        _key("industry", industry="industry"),
        F.when(F.col("waiting_since").isNotNull(), _key("waiting", agent="agent", day="waiting_since")),
        F.when(F.col("ahead_until").isNotNull(), _key("ahead", moment="ahead_until")),
    )


def sums_of(index: DataFrame, sign: int = 1) -> DataFrame:
    """Sums over index rows, each counted `sign` times. Tasks add up before they send: one row a sum and task."""
    bits = {c: F.shiftright("flags", i).bitwiseAND(1) for i, c in enumerate(COUNTED)}
    days = F.col("days_to_connection")
    numbers = {
        "total_rows": F.lit(1),
        **bits,
        "connection_days": F.coalesce(days, F.lit(0)),
        "connection_day_rows": days.isNotNull().cast("int"),
    }
    exploded = index.select(F.explode(_keys()).alias("key"), "flags", "days_to_connection")
    added = exploded.where("key IS NOT NULL").groupBy("key").agg(*[(sign * F.sum(n)).alias(c) for c, n in numbers.items()])
    return added.select("key.*", *SUM_COUNTS).select(*LEAD_SUMS.names)


def merged(*parts: DataFrame) -> DataFrame:
    """Sums added up; those that no lead has a share in any more are left out."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    total = together.groupBy(*SUM_KEYS).agg(*[F.sum(c).alias(c) for c in SUM_COUNTS])
    return total.where("total_rows <> 0").select(*LEAD_SUMS.names)


# ---------------------------------------------------------------- what the sums tell


def _of(sums: DataFrame, kind: str) -> DataFrame:
    return sums.where(F.col("kind") == kind)


def _totals(sums: DataFrame) -> DataFrame:
    """One row, zeros for no leads."""
    return _of(sums, "all").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUM_COUNTS])


_FUNNEL = ["contacted_leads", "invite_sent_leads", "connected_leads", "hot_leads"]


def lead_funnel(sums: DataFrame) -> DataFrame:
    return reports.funnel_rates(_totals(sums).select(F.col("total_rows").alias("total_leads"), *_FUNNEL))


def star_funnel(sums: DataFrame) -> DataFrame:
    return reports.star_funnel_rates(_totals(sums).select(F.col("total_rows").alias("total_leads"), *_FUNNEL))


def lead_status(sums: DataFrame) -> DataFrame:
    return _of(sums, "status").select(
        "lead_status",
        F.col("total_rows").alias("lead_count"),
        F.col("contacted_leads").alias("contacted_count"),
        F.col("connected_leads").alias("connected_count"),
        F.col("hot_leads").alias("hot_lead_count"),
    )


def agent_performance(sums: DataFrame) -> DataFrame:
    counts = _of(sums, "agent").select("agent", F.col("total_rows").alias("total_leads"), *_FUNNEL)
    return counts.withColumn("connection_rate", percent("connected_leads", "total_leads"))


def segment_performance(sums: DataFrame, segment: str) -> DataFrame:
    """Per source or industry."""
    return (
        _of(sums, segment)
        .select(
            segment,
            F.col("total_rows").alias("total_leads"),
            F.col("invite_sent_leads").alias("invites_sent"),
            "connected_leads",
        )
        .withColumns(reports.segment_rates())
    )


def _waiting(sums: DataFrame, as_of: date, days: int = DEFAULT.ghost_after_days) -> DataFrame:
    """Sums of the leads that were invited at least `days` days before `as_of` and have not connected."""
    return _of(sums, "waiting").where(F.datediff(F.lit(as_of), F.col("day")) >= days)


def kpi_overview(sums: DataFrame, as_of: date) -> DataFrame:
    ghosted = _waiting(sums, as_of).agg(F.coalesce(F.sum("total_rows"), F.lit(0))).scalar()
    return (
        _totals(sums)
        .select(
            F.col("total_rows").alias("total_leads"),
            "contacted_leads",
            F.col("invite_sent_leads").alias("invites_sent"),
            "connected_leads",
            "replied_leads",
            ghosted.alias("ghosted_leads"),
            "rate_limited_leads",
        )
        .withColumns(reports.kpi_rates())
    )


def _per_key(sums: DataFrame, keys: DataFrame, by: str, key: str, suffix: str, total: str) -> DataFrame:
    """Counts per dimension key: `keys` (by, key) has one key for each value of `by`."""
    keyed = sums.join(keys, by)
    rows = F.sum("total_rows")
    return keyed.groupBy(key).agg(
        rows.alias(total),
        rows.alias("_rows"),
        F.sum("contacted_leads").alias(f"contacted_{suffix}"),
        F.sum("invite_sent_leads").alias(f"invite_sent_{suffix}"),
        F.sum("connected_leads").alias(f"connected_{suffix}"),
        F.sum("hot_leads").alias("hot_leads" if suffix == "leads" else f"hot_lead_{suffix}"),
    )


def star_agent_performance(sums: DataFrame, dims: Dims) -> DataFrame:
    keys = dims.agent.where("is_current").groupBy(norm_agent("agent_name").alias("agent"))
    keys = keys.agg(F.max("agent_key").alias("agent_key"))
    own = _of(sums, "agent").withColumn("agent", norm_agent("agent"))
    counts = _per_key(own, keys, "agent", "agent_key", "leads", "total_leads")
    return reports.named_agents(counts, dims.agent)


def star_status(sums: DataFrame, dims: Dims) -> DataFrame:
    own = _of(sums, "status").withColumn("lead_status", norm_status("lead_status"))
    counts = _per_key(own, canonical_status(dims.status), "lead_status", "status_key", "count", "lead_count")
    return reports.named_statuses(counts, dims.status)


def star_daily_trend(sums: DataFrame, dims: Dims) -> DataFrame:
    keys = dims.date.groupBy(F.col("full_date").alias("day")).agg(F.max("date_key").alias("date_key"))
    return reports.named_days(_per_key(_of(sums, "day"), keys, "day", "date_key", "leads", "total_leads"), dims.date)


def dq_scores(sums: DataFrame, as_of: datetime, threshold: float = 95.0) -> DataFrame:
    """The quality scores of staging.

    Distinct ids and URLs need no distinct count: staging holds one row per id, and an id is a function of the URL,
    so rows of different ids have different URLs. `as_of` is no earlier than the clock of the last load.
    """
    late = _of(sums, "ahead").where(F.col("moment") > F.lit(as_of)).agg(F.coalesce(F.sum("total_rows"), F.lit(0)))
    counts = _totals(sums).withColumns(
        {
            "unique_staging_ids": F.col("total_rows"),
            "unique_linkedin_urls": F.col("rows_with_url"),
            "timely_records": F.col("dated_rows") - late.scalar(),
        }
    )
    return quality.scores_of(counts, threshold=threshold)


def risk_base(sums: DataFrame, as_of: date, params: RiskParams = DEFAULT) -> DataFrame:
    """The per-agent counts of the risk model."""
    waiting = _waiting(sums, as_of, params.ghost_after_days).where("agent is not null")
    ghosted = waiting.groupBy("agent").agg(F.sum("total_rows").alias("ghosted_leads"))
    own = _of(sums, "agent").where("agent is not null")
    return own.join(ghosted, "agent", "left").select(
        "agent",
        F.col("total_rows").alias("total_leads"),
        "contacted_leads",
        "invite_sent_leads",
        "connected_leads",
        "hot_leads",
        F.coalesce("ghosted_leads", F.lit(0).cast("long")).alias("ghosted_leads"),
        "replied_leads",
        F.try_divide("connection_days", "connection_day_rows").alias("avg_days_to_connection"),
    )
