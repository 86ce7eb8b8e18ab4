"""Type-2 history from changes in any order of arrival, and joins with the version that was valid at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadlake.operators.dims import dense_keys
from leadlake.session import write_work


def observations(*parts: DataFrame, natural: str, at: str, tracked: list[str]) -> DataFrame:
    """What was seen of members (natural, at, tracked), one row a member and time.

    Where two rows tell different things of the same time, the greater values count, whichever came first. Rows
    without a member or a time are left out. Tasks cut their rows before they send them.
    """
    together = parts[0].select(natural, at, *tracked)
    for part in parts[1:]:
        together = together.unionByName(part.select(natural, at, *tracked))
    seen = together.where(F.col(natural).isNotNull() & F.col(at).isNotNull()).groupBy(natural, at)
    return seen.agg(F.max(F.struct(*tracked)).alias("_seen")).select(natural, at, *[f"_seen.{c}" for c in tracked])


def history(seen: DataFrame, natural: str, at: str, tracked: list[str]) -> DataFrame:
    """Versions (natural, valid_from, valid_to, is_current, tracked) of `observations`.

    A version begins where a tracked value differs from what was seen before, and ends where the next one begins.
    """
    by_time = W.partitionBy(natural).orderBy(at)
    now, before = F.struct(*tracked), F.lag(F.struct(*tracked)).over(by_time)
    begins = seen.withColumn("_begins", before.isNull() | ~now.eqNullSafe(before)).where("_begins")
    until = F.lead(at).over(by_time)
    return begins.select(
        natural,
        F.col(at).alias("valid_from"),
        until.alias("valid_to"),
        until.isNull().alias("is_current"),
        *tracked,
    )


def merge_history(
    dim: DataFrame, known: DataFrame, incoming: DataFrame, key: str, natural: str, at: str, tracked: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(dimension, observations) after more observations, of any time, have come in.

    An observation between two others cuts the version it falls into. Only members that come in are worked on;
    versions of the others are carried over. A version that is still there keeps its key; new ones are keyed on from
    the highest key, in the order of member and time. Whatever the order of arrival, the versions are the same: what
    was seen is kept, also where it told nothing new, as a later arrival may come before it.
    """
    touched = write_work(incoming.where(F.col(natural).isNotNull()).select(natural).distinct())
    seen = write_work(observations(known, incoming, natural=natural, at=at, tracked=tracked))
    versions = history(seen.join(touched, natural, "left_semi"), natural, at, tracked)
    old = dim.select(natural, "valid_from", key)
    keyed = write_work(versions.join(old, [natural, "valid_from"], "left"))
    fresh = keyed.where(F.col(key).isNull()).select(F.struct(natural, "valid_from").alias("_version"))
    added = dense_keys(fresh, "_version", "_key", after=dim.agg(F.max(key)).scalar())
    added = added.select("_key", F.col(f"_version.{natural}").alias(natural), "_version.valid_from")
    renewed = keyed.join(added, [natural, "valid_from"], "left").withColumn(key, F.coalesce(key, "_key"))
    carried = dim.join(touched, natural, "left_anti")
    return carried.unionByName(renewed.select(*dim.columns)), seen


def as_of_join(
    facts: DataFrame, versions: DataFrame, on: str, time: str, valid_from: str, take: list[str], period: str = "month"
) -> DataFrame:
    """`facts` with the columns `take` of the version that was valid at `time`: the latest of the same `on` that begins
    no later; null where there is none. Of versions that begin at one time the greatest counts.

    An equality join on (on, period), so that Spark may broadcast the versions or split a hot key: for each period
    the versions that begin in it come in one sorted array, with the one that was valid before. The array of a period
    is all that a fact is compared with. There is a row for each key and period up to the last fact's, not for each
    pair of fact and version.
    """
    version = F.struct(F.col(valid_from).cast("timestamp").alias("_from"), *take)
    begun = versions.where(F.col(on).isNotNull() & F.col(valid_from).isNotNull()).select(
        on, F.date_trunc(period, F.col(valid_from)).alias("_period"), version.alias("_version")
    )
    begun = begun.groupBy(on, "_period").agg(F.sort_array(F.collect_list("_version")).alias("_versions"))
    last = facts.agg(F.max(F.date_trunc(period, F.col(time)))).scalar()
    step = F.expr(f"INTERVAL 1 {period}")
    earlier = W.partitionBy(on).orderBy("_period")
    placed = begun.withColumn("_next", F.lead("_period").over(earlier))
    # a version reaches on through the periods in which none begins, up to the last fact
    until = F.greatest("_period", F.least(F.coalesce(F.col("_next") - step, last), last))
    spread = placed.withColumn("_at", F.explode(F.sequence("_period", F.coalesce(until, F.col("_period")), step)))
    carried = F.lag(F.element_at("_versions", -1)).over(W.partitionBy(on).orderBy("_at"))
    own = F.when(F.col("_at") == F.col("_period"), F.col("_versions")).otherwise(F.slice("_versions", -1, 1))
    slots = spread.select(on, F.col("_at").alias("_period"), F.concat(F.array_compact(F.array(carried)), own).alias("_versions"))
    joined = facts.withColumn("_period", F.date_trunc(period, F.col(time))).join(slots, [on, "_period"], "left")
    moment = F.col(time).cast("timestamp")
    valid = F.try_element_at(F.filter("_versions", lambda v: v["_from"] <= moment), F.lit(-1))
    found = joined.withColumn("_valid", valid)
    return found.select(*[F.col(c) for c in facts.columns], *[F.col(f"_valid.{c}").alias(c) for c in take])
