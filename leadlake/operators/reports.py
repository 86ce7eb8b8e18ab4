"""Funnel, status, agent, segment and trend reports.

Every report is one aggregation. Star reports aggregate on the key first and join the dimension to the few
aggregated rows, so the fact shuffles at most one row per key and map task, and no dimension is broadcast.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.stats import flagged, percent, rows
from leadlake.functions.text import norm_status
from leadlake.operators.risk import ghosted, replied


def funnel_rates(counts: DataFrame) -> DataFrame:
    """Connection and invite rate in percent; null for no leads."""
    return counts.withColumns(
        {
            "connection_rate": percent("connected_leads", "total_leads"),
            "invite_rate": percent("invite_sent_leads", "total_leads"),
        }
    )


def lead_funnel(fct: DataFrame) -> DataFrame:
    """Totals over all leads with connection and invite rate in percent; null rates for an empty fact."""
    counts = fct.agg(
        rows().alias("total_leads"),
        flagged("is_contacted").alias("contacted_leads"),
        flagged("is_invite_sent").alias("invite_sent_leads"),
        flagged("is_connected").alias("connected_leads"),
        flagged("is_hot_lead").alias("hot_leads"),
    )
    return funnel_rates(counts)


def lead_funnel_prioritized(fct: DataFrame) -> DataFrame:
    """Totals over all leads with the prioritized ones, without rates."""
    return fct.agg(
        rows().alias("total_leads"),
        flagged("is_contacted").alias("contacted_leads"),
        flagged("is_invite_sent").alias("invite_sent_leads"),
        flagged("is_connected").alias("connected_leads"),
        flagged("is_prioritized").alias("prioritized_leads"),
        flagged("is_hot_lead").alias("hot_leads"),
    )


def lead_status(fct: DataFrame) -> DataFrame:
    return fct.groupBy("lead_status").agg(
        rows().alias("lead_count"),
        flagged("is_contacted").alias("contacted_count"),
        flagged("is_connected").alias("connected_count"),
        flagged("is_hot_lead").alias("hot_lead_count"),
    )


def lead_status_counts(fct: DataFrame) -> DataFrame:
    return fct.groupBy("lead_status").agg(rows().alias("lead_count"))


def agent_performance(fct: DataFrame) -> DataFrame:
    """Per agent as written in the source; leads without an agent are a group of their own."""
    return (
        fct.groupBy("agent")
        .agg(
            rows().alias("total_leads"),
            flagged("is_contacted").alias("contacted_leads"),
            flagged("is_invite_sent").alias("invite_sent_leads"),
            flagged("is_connected").alias("connected_leads"),
            flagged("is_hot_lead").alias("hot_leads"),
        )
        .withColumn("connection_rate", percent("connected_leads", "total_leads"))
    )


def agent_performance_prioritized(fct: DataFrame) -> DataFrame:
    return fct.groupBy("agent").agg(
        rows().alias("total_leads"),
        flagged("is_contacted").alias("contacted"),
        flagged("is_invite_sent").alias("invites_sent"),
        flagged("is_connected").alias("connected"),
        flagged("is_hot_lead").alias("hot_leads"),
        flagged("is_prioritized").alias("prioritized"),
    )


# ---------------------------------------------------------------- star reports


def star_funnel(star: DataFrame) -> DataFrame:
    counts = star.agg(
        rows().alias("total_leads"),
        flagged("is_contacted").alias("contacted_leads"),
        flagged("is_invite_sent").alias("invite_sent_leads"),
        flagged("is_connected").alias("connected_leads"),
        flagged("is_hot_lead").alias("hot_leads"),
    )
    return star_funnel_rates(counts)


def star_funnel_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "contact_rate": F.round(percent("contacted_leads", "total_leads"), 2),
            "invite_rate": F.round(percent("invite_sent_leads", "total_leads"), 2),
            "connection_rate": F.round(percent("connected_leads", "total_leads"), 2),
        }
    )


def _per_key(star: DataFrame, key: str, suffix: str, total: str) -> DataFrame:
    return star.groupBy(key).agg(
        F.count("staging_id").alias(total),
        rows().alias("_rows"),
        flagged("is_contacted").alias(f"contacted_{suffix}"),
        flagged("is_invite_sent").alias(f"invite_sent_{suffix}"),
        flagged("is_connected").alias(f"connected_{suffix}"),
        flagged("is_hot_lead").alias("hot_leads" if suffix == "leads" else f"hot_lead_{suffix}"),
    )


def star_agent_performance(star: DataFrame, dim_agent: DataFrame) -> DataFrame:
    return named_agents(_per_key(star, "agent_key", "leads", "total_leads"), dim_agent)


def named_agents(counts: DataFrame, dim_agent: DataFrame) -> DataFrame:
    """Counts per agent key with the agent's name and rates."""
    return counts.join(dim_agent, "agent_key").select(
        "agent_key",
        "agent_name",
        "total_leads",
        "contacted_leads",
        "invite_sent_leads",
        "connected_leads",
        "hot_leads",
        F.round(percent("connected_leads", "_rows"), 2).alias("connection_rate"),
        F.round(percent("hot_leads", "_rows"), 2).alias("hot_lead_rate"),
    )


def star_status(star: DataFrame, dim_status: DataFrame) -> DataFrame:
    return named_statuses(_per_key(star, "status_key", "count", "lead_count"), dim_status)


def named_statuses(counts: DataFrame, dim_status: DataFrame) -> DataFrame:
    """Counts per status key with the status."""
    return counts.join(dim_status.select("status_key", "lead_status"), "status_key").select(
        "status_key",
        "lead_status",
        "lead_count",
        "contacted_count",
        "invite_sent_count",
        "connected_count",
        "hot_lead_count",
    )


def star_daily_trend(star: DataFrame, dim_date: DataFrame) -> DataFrame:
    return named_days(_per_key(star, "date_key", "leads", "total_leads"), dim_date)


def named_days(counts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Counts per date key with the day's calendar columns."""
    return counts.join(dim_date, "date_key").select(
        "date_key", "full_date", "year", "month", "month_name", "quarter",
        "total_leads", "contacted_leads", "invite_sent_leads", "connected_leads", "hot_leads",
    )


# ---------------------------------------------------------------- dashboard reports


def segment_performance(fct: DataFrame, segment: str) -> DataFrame:
    """Per source, industry, campaign or other segment column: totals, acceptance and conversion in percent."""
    return (
        fct.groupBy(segment)
        .agg(
            rows().alias("total_leads"),
            flagged("is_invite_sent").alias("invites_sent"),
            flagged("is_connected").alias("connected_leads"),
        )
        .withColumns(segment_rates())
    )


def segment_rates() -> dict[str, Column]:
    return {
        "acceptance_rate": percent("connected_leads", "invites_sent"),
        "conversion_rate": percent("connected_leads", "total_leads"),
    }


def kpi_overview(fct: DataFrame, as_of: date) -> DataFrame:
    """One row of dashboard figures; rates in percent, null when there is nothing to divide by."""
    return fct.agg(
        rows().alias("total_leads"),
        flagged("is_contacted").alias("contacted_leads"),
        flagged("is_invite_sent").alias("invites_sent"),
        flagged("is_connected").alias("connected_leads"),
        F.count_if(replied()).alias("replied_leads"),
        F.count_if(ghosted(as_of)).alias("ghosted_leads"),
        F.count_if(rate_limited()).alias("rate_limited_leads"),
    ).withColumns(kpi_rates())


def rate_limited() -> Column:
    return norm_status("lead_status") == "linkedin_rate_limited"


def kpi_rates() -> dict[str, Column]:
    return {
        "acceptance_rate": percent("connected_leads", "invites_sent"),
        "reply_rate": percent("replied_leads", "contacted_leads"),
        "conversion_rate": percent("connected_leads", "total_leads"),
        "ghosting_rate": percent("ghosted_leads", "invites_sent"),
        "rate_limit_rate": percent("rate_limited_leads", "total_leads"),
    }


def daily_leads(fct: DataFrame) -> DataFrame:
    """Leads added per day."""
    return fct.groupBy(F.to_date("added_on").alias("added_date")).agg(rows().alias("total_leads"))


def capacity_overview(risk: DataFrame, ceiling: int = 100) -> DataFrame:
    """Daily ceiling against the recommended capacity, per agent."""
    return risk.select(
        "agent",
        "risk_score",
        "risk_level",
        F.lit(ceiling).alias("daily_ceiling"),
        "recommended_daily_capacity",
        (F.lit(ceiling) - F.col("recommended_daily_capacity")).alias("capacity_reduction"),
    )
