"""The lead fact: staging rows with flags and derived measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.text import strip
from leadlake.schemas import FCT_LEADS


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def fct_leads(stg: DataFrame, hot_threshold: float = 50) -> DataFrame:
    """Staging rows plus five 0/1 flags, whole days from adding to connecting, and the status.

    `days_to_connection` counts midnights passed and may be negative.
    """
    return stg.withColumns(
        {
            "is_contacted": _flag(F.col("last_contacted").isNotNull()),
            "is_invite_sent": _flag(F.col("invite_sent_at").isNotNull()),
            "is_connected": _flag(F.col("connected_at").isNotNull()),
            "is_prioritized": _flag(F.upper(strip("prioritized")) == "YES"),
            "is_hot_lead": _flag(F.col("hot_score") >= hot_threshold),
            "days_to_connection": F.datediff(F.to_date("connected_at"), F.to_date("added_on")),
            "lead_status": F.coalesce("sdr_status", F.lit("unknown")),
        }
    ).select(*FCT_LEADS.names)


def lookup(df: DataFrame, columns: list[str], **equals: object) -> DataFrame:
    """Rows whose named columns equal the given values, e.g. `lookup(stg, [...], name="Ada")`."""
    found = df
    for name, value in equals.items():
        found = found.where(F.col(name) == F.lit(value))
    return found.select(*columns)


#: What the point lookup shows of a lead in staging and in the fact.
STAGING_LOOKUP = [
    "name", "sdr_status", "hot_score", "prioritized", "last_contacted", "invite_sent_at", "connected_at",
]
FACT_LOOKUP = [
    "name", "lead_status", "is_contacted", "is_invite_sent", "is_connected", "is_prioritized",
    "is_hot_lead", "days_to_connection",
]
