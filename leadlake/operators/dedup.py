"""Keep the last row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadlake.functions.stats import rows


def keep_last(
    df: DataFrame, keys: list[str], order: list[str], copies: str | None = None, without: list[str] | None = None
) -> DataFrame:
    """One row per key: the one that comes last by `order`. Null keys form one group.

    Every map task cuts its rows to one per key before the shuffle, so a key that holds a third of all rows
    sends as many rows as there are map tasks. `copies` names a column to count the rows of each key in; the
    counts add up to the rows that went in, also when lost tasks ran twice. `without` names columns that the result
    does without, so that no row carries them beside the order.
    """
    without = set(without or ())
    if copies is None:
        newest_first = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        ranked = df.withColumn("_rank", F.row_number().over(newest_first))
        return ranked.where("_rank = 1").drop("_rank", *without)
    others = [f"`{c}`" for c in df.columns if c not in keys and c not in without]
    last = F.max_by(F.struct(*others), F.struct(*order))
    counted = df.groupBy(*keys).agg(last.alias("_last"), rows().alias(copies))
    return counted.select(*keys, "_last.*", copies)
