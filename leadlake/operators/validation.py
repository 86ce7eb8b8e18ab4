"""Record validation and dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.text import is_blank


def default_rules() -> list[tuple[Column, str]]:
    """Invalidity conditions with their messages, in reporting order."""
    return [
        (is_blank("linkedin_url"), "Missing linkedin_url; "),
        (F.col("staging_id").isNull(), "Missing staging_id; "),
        (F.col("added_on").isNull(), "Missing added_on; "),
    ]


def dated_after(limit: datetime) -> tuple[Column, str]:
    """Rule against dates that lie ahead."""
    ahead = F.coalesce(F.col("record_updated_at") > F.lit(limit), F.lit(False))
    return ahead, "Date in the future; "


def reason(rules: Sequence[tuple[Column, str]] | None = None) -> Column:
    """Messages of all broken rules, joined; empty for a valid record. The text keeps its last semicolon."""
    parts = [F.when(broken, message).otherwise("") for broken, message in rules or default_rules()]
    return F.rtrim(F.concat(*parts))


def with_reasons(df: DataFrame, rules: Sequence[tuple[Column, str]] | None = None) -> DataFrame:
    """Add `error_reason`."""
    return df.withColumn("error_reason", reason(rules))


def validate(
    df: DataFrame, rules: Sequence[tuple[Column, str]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, dead); dead records carry `error_reason`.

    Write the staged rows first when both sides are used, else they are staged twice. The split tests the
    reason, not the rules one by one: Spark would push a test of the lead id below the deduplication and the
    joins under it, and hash every URL several times.
    """
    checked = with_reasons(df, rules)
    return (
        checked.where("error_reason = ''").drop("error_reason"),
        checked.where("error_reason <> ''"),
    )


def dead_letters(dead: DataFrame, run_id: str, run_ts: datetime) -> DataFrame:
    """Stamp invalid records with the run that rejected them."""
    return dead.withColumns(
        {
            "dead_letter_run_id": F.lit(run_id),
            "dead_letter_timestamp": F.lit(run_ts).cast("timestamp"),
        }
    )
