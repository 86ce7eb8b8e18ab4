"""Per-agent outreach risk: rates, small-sample bounds, peer comparison, points and capacity."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.stats import flagged, fraction, proportion_z, rows, wilson_lower
from leadlake.functions.text import strip
from leadlake.schemas import RISK_COLUMNS
from leadlake.session import cut_lineage


@dataclass(frozen=True)
class RiskParams:
    """Model constants and point scales (fixed values)."""

    daily_ceiling: int = 100
    target_connections: int = 5
    z: float = 1.96
    min_sample: int = 30
    min_invites: int = 5
    ghost_after_days: int = 7
    # (limit, points), strongest first
    ghosting: tuple = ((0.50, 35), (0.30, 20), (0.15, 10))  # at least
    acceptance: tuple = ((0.05, 30), (0.10, 20), (0.15, 10))  # below
    anomaly: tuple = ((-3, 35), (-2, 25), (-1, 10))  # at most
    levels: tuple = ((60, "HIGH"), (30, "MEDIUM"))  # at least, else LOW
    floor_capacity: int = 10
    no_signal_capacity: int = 50
    level_caps: tuple = (("HIGH", 50), ("MEDIUM", 75))


DEFAULT = RiskParams()


def _ladder(steps: tuple, holds, default) -> Column:
    """First step whose limit holds gives the value."""
    chosen = None
    for limit, value in steps:
        chosen = (F if chosen is None else chosen).when(holds(limit), value)
    return chosen.otherwise(default)


def replied() -> Column:
    return F.lower(strip(F.coalesce("sdr_status", F.lit("")))) == "replied"


def ghosted(as_of: date, days: int = DEFAULT.ghost_after_days) -> Column:
    """Invited at least `days` days before `as_of` and still not connected."""
    waited = F.datediff(F.lit(as_of), F.to_date("invite_sent_at"))
    return F.col("invite_sent_at").isNotNull() & F.col("connected_at").isNull() & (waited >= days)


def risk_base(fct: DataFrame, as_of: date, params: RiskParams = DEFAULT) -> DataFrame:
    """Counts per agent as written in the source (blank is an agent, null is not)."""
    return (
        fct.where("agent is not null")
        .groupBy("agent")
        .agg(
            rows().alias("total_leads"),
            flagged("is_contacted").alias("contacted_leads"),
            flagged("is_invite_sent").alias("invite_sent_leads"),
            flagged("is_connected").alias("connected_leads"),
            flagged("is_hot_lead").alias("hot_leads"),
            F.count_if(ghosted(as_of, params.ghost_after_days)).alias("ghosted_leads"),
            F.count_if(replied()).alias("replied_leads"),
            F.avg("days_to_connection").alias("avg_days_to_connection"),
        )
    )


def risk_rates(base: DataFrame) -> DataFrame:
    """Add the four rates as fractions."""
    return base.withColumns(
        {
            "connection_rate": fraction("connected_leads", "total_leads"),
            "acceptance_rate": fraction("connected_leads", "invite_sent_leads"),
            "reply_rate": fraction("replied_leads", "contacted_leads"),
            "ghosting_rate": fraction("ghosted_leads", "invite_sent_leads"),
        }
    )


def risk_wilson(rates: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Add the lower 95 % bound of the connection rate."""
    bound = wilson_lower(F.col("connected_leads"), F.col("total_leads"), params.z)
    return rates.withColumn("connection_rate_lower_95", bound)


def risk_zscore(rates: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Add the z-score of each agent's connection rate against the pooled rate of all agents.

    0 for a single agent, for small samples and for a pooled rate of 0 or 1. The agents are checkpointed,
    so the pooled figures, a one-row scalar subquery, come from them and not from a second pass over leads.
    """
    rates = cut_lineage(rates)
    pooled = rates.agg(
        F.struct(
            fraction(F.sum("connected_leads"), F.sum("total_leads")).alias("rate"),
            rows().alias("agents"),
        ).alias("pooled")
    ).scalar()
    score = proportion_z(F.col("connection_rate"), F.col("_pooled.rate"), F.col("total_leads"))
    comparable = (F.col("_pooled.agents") >= 2) & (F.col("total_leads") >= params.min_sample)
    return (
        rates.withColumn("_pooled", pooled)
        .withColumn("connection_rate_zscore", F.when(comparable, score).otherwise(0.0))
        .drop("_pooled")
    )


def _capacity(params: RiskParams) -> Column:
    """Invites a day that should bring the target number of connections, within the limits."""
    bound = F.col("connection_rate_lower_95")
    wanted = F.floor(F.try_divide(F.lit(float(params.target_connections)), bound))
    clipped = F.least(F.lit(params.daily_ceiling), F.greatest(F.lit(params.floor_capacity), wanted))
    cap = _ladder(params.level_caps, lambda level: F.col("risk_level") == level, params.daily_ceiling)
    return (
        F.when(F.col("total_leads") < params.min_sample, params.daily_ceiling)
        .when(bound <= 0, params.no_signal_capacity)
        .otherwise(F.least(clipped, cap))
        .cast("long")
    )


def score_agents(base: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """From per-agent counts to the full risk table."""
    rated = risk_zscore(risk_wilson(risk_rates(base), params), params)
    invited = F.col("invite_sent_leads") >= params.min_invites
    ghosting, acceptance = F.col("ghosting_rate"), F.col("acceptance_rate")
    zscore, sampled = F.col("connection_rate_zscore"), F.col("total_leads") >= params.min_sample
    points = rated.withColumns(
        {
            "ghosting_risk_points": F.when(
                invited, _ladder(params.ghosting, lambda x: ghosting >= x, 0)
            ).otherwise(0),
            "acceptance_risk_points": F.when(
                invited, _ladder(params.acceptance, lambda x: acceptance < x, 0)
            ).otherwise(0),
            "connection_anomaly_points": _ladder(params.anomaly, lambda x: zscore <= x, 0),
        }
    )
    total = sum(
        (F.col(c) for c in ("acceptance_risk_points", "connection_anomaly_points")),
        F.col("ghosting_risk_points"),
    )
    return (
        points.withColumn("risk_score", F.least(F.lit(100), F.greatest(F.lit(0), total)))
        .withColumn("risk_level", _ladder(params.levels, lambda x: F.col("risk_score") >= x, "LOW"))
        .withColumns(
            {
                "recommended_daily_capacity": _capacity(params),
                "statistical_confidence": F.when(
                    sampled, "Adequate for rate monitoring"
                ).otherwise("Insufficient sample"),
                "model_status": F.when(sampled, "STATISTICALLY_ACTIONABLE").otherwise("MONITOR_ONLY"),
            }
        )
        .select(*RISK_COLUMNS)
    )


def risk_scores(fct: DataFrame, as_of: date, params: RiskParams = DEFAULT) -> DataFrame:
    """Risk table of all agents: one aggregation, then projections."""
    return score_agents(risk_base(fct, as_of, params), params)


def require_agents(risk: DataFrame) -> DataFrame:
    """Gate: a risk table without agents is an error."""
    if risk.isEmpty():
        raise RuntimeError("no agent data in the lead fact")
    return risk
