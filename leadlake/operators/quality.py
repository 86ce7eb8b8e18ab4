"""Weighted data-quality scores with a pass threshold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.stats import rows
from leadlake.functions.text import is_blank, strip
from leadlake.schemas import DQ_RESULTS

#: Statuses that count as valid.
VALID_STATUSES = ["captured", "invite sent", "connected", "replied", "rejected", "unknown"]


@dataclass(frozen=True)
class Weights:
    """Share of each score in the composite (fixed values)."""

    completeness: float = 0.25
    uniqueness: float = 0.20
    validity: float = 0.25
    timeliness: float = 0.15
    referential: float = 0.15


class QualityError(RuntimeError):
    """Composite score below the threshold."""


def _score(found: Column, checks: Column) -> Column:
    """Percentage of passed checks, 0 for an empty table."""
    return F.coalesce(F.try_divide(found, checks) * 100, F.lit(0.0))


def completeness() -> dict[str, Column]:
    """What a row must have, by the name of its count."""
    return {
        "valid_name": ~is_blank("name"),
        "valid_linkedin_url": ~is_blank("linkedin_url"),
        "valid_added_on": F.col("added_on").isNotNull(),
        "valid_agent": ~is_blank("agent"),
    }


def _counted(conditions: dict[str, Column]) -> list[Column]:
    return [F.count_if(holds).alias(name) for name, holds in conditions.items()]


def _completeness_counts() -> list[Column]:
    return [rows().alias("total_rows"), *_counted(completeness())]


def _completeness_score() -> Column:
    found = F.col("valid_name") + F.col("valid_linkedin_url") + F.col("valid_added_on")
    return _score(found + F.col("valid_agent"), F.col("total_rows") * 4)


def _with_counts(fct: DataFrame, rsd: float | None, *counts: Column) -> DataFrame:
    """One row: the counts, and the distinct ids and URLs, exact or estimated with a relative error.

    Each exact distinct count is an aggregate of its own over its one column: beside others it would
    multiply every row.
    """
    names = {"unique_staging_ids": "staging_id", "unique_linkedin_urls": "linkedin_url"}
    if rsd is not None:
        return fct.agg(*counts, *[F.approx_count_distinct(c, rsd).alias(n) for n, c in names.items()])
    found = {n: fct.select(c).where(F.col(c).isNotNull()).distinct() for n, c in names.items()}
    return fct.agg(*counts).withColumns({n: d.agg(rows().alias("n")).scalar() for n, d in found.items()})


def _uniqueness_score() -> Column:
    ids = _score(F.col("unique_staging_ids"), F.col("total_rows"))
    urls = _score(F.col("unique_linkedin_urls"), F.col("total_rows"))
    return (ids + urls) / 2


def validity(statuses: list[str] = VALID_STATUSES) -> dict[str, Column]:
    """What a row's values must be, by the name of its count."""
    score, priority, status = F.col("hot_score"), F.col("prioritized"), F.col("sdr_status")
    return {
        "valid_hot_scores": score.isNull() | score.between(0, 100),
        "valid_prioritized": priority.isNull() | F.upper(strip(priority)).isin("YES", "NO"),
        "valid_statuses": status.isNull() | F.lower(strip(status)).isin(statuses),
    }


def _validity_counts(statuses: list[str]) -> list[Column]:
    return _counted(validity(statuses))


def _validity_score() -> Column:
    found = F.col("valid_hot_scores") + F.col("valid_prioritized") + F.col("valid_statuses")
    return _score(found, F.col("total_rows") * 3)


def _timeliness_counts(as_of: datetime) -> list[Column]:
    updated = F.col("record_updated_at")
    return [
        F.count(updated).alias("dated_rows"),
        F.count_if(updated <= F.lit(as_of)).alias("timely_records"),
    ]


def _timeliness_score() -> Column:
    return _score(F.col("timely_records"), F.col("dated_rows"))


def _referential_score() -> Column:
    return _score(F.col("valid_agent"), F.col("total_rows"))


def dq_completeness(fct: DataFrame) -> DataFrame:
    """Share of non-missing name, URL, date and agent."""
    return fct.agg(*_completeness_counts()).withColumn("completeness_score", _completeness_score())


def dq_uniqueness(fct: DataFrame, rsd: float | None = None) -> DataFrame:
    """Mean share of distinct ids and distinct URLs. Nulls are not counted as values."""
    counts = _with_counts(fct, rsd, rows().alias("total_rows"))
    return counts.withColumn("uniqueness_score", _uniqueness_score())


def dq_validity(fct: DataFrame, statuses: list[str] = VALID_STATUSES) -> DataFrame:
    """Share of scores in 0..100, yes/no priorities and known statuses; null is valid."""
    counts = fct.agg(rows().alias("total_rows"), *_validity_counts(statuses))
    return counts.withColumn("validity_score", _validity_score())


def dq_timeliness(stg: DataFrame, as_of: datetime) -> DataFrame:
    """Share of dated rows whose newest date is not in the future."""
    return stg.agg(*_timeliness_counts(as_of)).withColumn("timeliness_score", _timeliness_score())


def dq_referential(fct: DataFrame) -> DataFrame:
    """Share of rows that name an agent."""
    counts = fct.agg(rows().alias("total_rows"), F.count_if(~is_blank("agent")).alias("valid_agent"))
    return counts.withColumn("referential_integrity_score", _referential_score())


def dq_scores(
    fct: DataFrame,
    as_of: datetime,
    stg: DataFrame | None = None,
    statuses: list[str] = VALID_STATUSES,
    weights: Weights = Weights(),
    threshold: float = 95.0,
    rsd: float | None = None,
) -> DataFrame:
    """One row: five scores, composite, threshold and PASS or FAIL.

    One pass over the fact counts everything but the distinct ids and URLs, which take a pass each over their one
    column: hand in a written fact. It holds each staging row once, so timeliness comes from the same pass; give `stg`
    when staging differs from the fact.
    """
    counts = _with_counts(
        fct,
        rsd,
        *_completeness_counts(),
        *_validity_counts(statuses),
        *(_timeliness_counts(as_of) if stg is None else []),
    )
    if stg is not None:
        dated = stg.agg(F.struct(*_timeliness_counts(as_of)).alias("t")).scalar()
        counts = counts.withColumn("_t", dated).select("*", "_t.*").drop("_t")
    return scores_of(counts, weights, threshold)


def dq_scores_by(fct: DataFrame, by: str, as_of: datetime, threshold: float = 95.0) -> DataFrame:
    """The scores of each group of rows, from one pass: (by, scores). Meant for few groups, such as loads."""
    counts = fct.groupBy(by).agg(
        *_completeness_counts(),
        *_validity_counts(VALID_STATUSES),
        *_timeliness_counts(as_of),
        F.count_distinct("staging_id").alias("unique_staging_ids"),
        F.count_distinct("linkedin_url").alias("unique_linkedin_urls"),
    )
    return scores_of(counts, threshold=threshold, also=(by,))


def scores_of(
    counts: DataFrame, weights: Weights = Weights(), threshold: float = 95.0, also: Sequence[str] = ()
) -> DataFrame:
    """The scores from their counts, however those came about, with the columns `also`."""
    composite = (
        F.col("completeness_score") * weights.completeness
        + F.col("uniqueness_score") * weights.uniqueness
        + F.col("validity_score") * weights.validity
        + F.col("timeliness_score") * weights.timeliness
        + F.col("referential_integrity_score") * weights.referential
    )
    return (
        counts.select(
            *also,
            "total_rows",
            _completeness_score().alias("completeness_score"),
            _uniqueness_score().alias("uniqueness_score"),
            _validity_score().alias("validity_score"),
            _timeliness_score().alias("timeliness_score"),
            _referential_score().alias("referential_integrity_score"),
        )
        .withColumn("composite_dq_score", composite)
        .withColumn("threshold", F.lit(threshold))
        .withColumn("dq_status", F.when(composite >= threshold, "PASS").otherwise("FAIL"))
    )


def dq_record(scores: DataFrame, run_ts: datetime) -> DataFrame:
    """History row of a quality run; its id is the run clock as digits down to the microsecond."""
    stamp = F.lit(run_ts).cast("timestamp")
    return scores.select(
        F.date_format(stamp, "yyyyMMddHHmmssSSSSSS").alias("dq_run_id"),
        stamp.alias("dq_timestamp"),
        *DQ_RESULTS.names[2:],
    )


def require_quality(status: str, score: float) -> None:
    """Gate: anything but PASS is an error."""
    if status != "PASS":
        raise QualityError(f"data quality check failed, score {score:.2f}%")
