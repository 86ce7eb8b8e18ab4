"""Rates and small-sample statistics as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows() -> Column:
    """COUNT(*)."""
    return F.count(F.lit(1))


def flagged(flag: str) -> Column:
    """Rows whose 0/1 flag is set."""
    return F.count_if(F.col(flag) == 1)


def fraction(part: Column | str, whole: Column | str) -> Column:
    """part / whole, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def percent(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole, null when there is nothing to divide by."""
    return F.try_divide(part, whole) * 100


def wilson_lower(successes: Column, trials: Column, z: float) -> Column:
    """Lower end of the Wilson score interval of a proportion.

    Without successes the bound is exactly 0; computing it would leave rounding noise above 0.
    Counts become doubles first: their product overflows a long on very large groups.
    """
    s, n = successes.cast("double"), trials.cast("double")
    spread = F.sqrt(s * (n - s) / n + z * z / 4)
    bound = (s + z * z / 2 - z * spread) / (n + z * z)
    return F.when(s > 0, F.greatest(bound, F.lit(0.0))).otherwise(0.0)


def proportion_z(rate: Column, baseline: Column, trials: Column) -> Column:
    """z-score of an observed rate against a baseline rate strictly between 0 and 1, else 0."""
    inside = (baseline > 0) & (baseline < 1) & (trials > 0)
    score = (rate - baseline) / F.sqrt(baseline * (1 - baseline) / trials)
    return F.when(inside, score).otherwise(0.0)
