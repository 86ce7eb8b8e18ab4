"""Dimension tables with dense surrogate keys, calendars and type-2 history."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadlake.functions.dates import calendar_columns
from leadlake.functions.stats import rows
from leadlake.functions.text import norm_agent, norm_status, strip
from leadlake.schemas import DIM_AGENT, DIM_DATE, DIM_LEAD_STATUS
from leadlake.session import write_work

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


@dataclass(frozen=True)
class Dims:
    agent: DataFrame
    status: DataFrame
    date: DataFrame


def distinct_members(df: DataFrame, member: Column, name: str) -> DataFrame:
    """Distinct non-blank members. Each map task sends a member once, however often it occurs."""
    return df.select(member.alias(name)).where(F.col(name) != "").distinct()


def rank_members(members: DataFrame, kind: str, name: str) -> DataFrame:
    """Rank distinct (kind, member) rows 1..n within each kind without sorting a kind in one task.

    Rows are range-partitioned and sorted in their partitions. A rank is the row's place in its partition
    plus the members of its kind in the partitions before. The placed rows are written, so a range
    boundary that is drawn anew can never shift a rank. Only sizes, one row per partition and kind, are
    summed up in order.
    """
    placed = write_work(
        members.repartitionByRange(kind, name)
        .sortWithinPartitions(kind, name)
        .select(kind, name, F.monotonically_increasing_id().alias("_id"))
        .select(
            kind,
            name,
            F.shiftright("_id", _ROW_BITS).alias("_part"),
            F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
        )
    )
    sizes = placed.groupBy(kind, "_part").agg(rows().alias("_size"), F.min("_row").alias("_first"))
    earlier = W.partitionBy(kind).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        kind, "_part", (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    return placed.join(F.broadcast(offsets), [kind, "_part"]).select(
        kind, name, (F.col("_shift") + F.col("_row") + 1).alias("rank")
    )


def dense_keys(members: DataFrame, name: str, key: str, after: Column | None = None) -> DataFrame:
    """Number distinct members 1..n in sorted order, or on from the key `after`."""
    ranked = rank_members(members.select(F.lit(0).alias("_kind"), name), "_kind", name)
    start = F.lit(0) if after is None else F.coalesce(after, F.lit(0))
    return ranked.select((start + F.col("rank")).cast("long").alias(key), name)


def extend_keys(existing: DataFrame, members: DataFrame, name: str, key: str) -> DataFrame:
    """Rows (key, name) for members that `existing` lacks, keyed on from its highest key in sorted order."""
    missing = members.join(existing.select(name), name, "left_anti")
    return dense_keys(missing, name, key, after=existing.agg(F.max(key)).scalar())


# ---------------------------------------------------------------- agents


def _new_agents(keyed: DataFrame, run_ts: datetime) -> DataFrame:
    return keyed.select(
        "agent_key",
        "agent_name",
        F.lit(run_ts).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_agent(fct: DataFrame, run_ts: datetime, existing: DataFrame | None = None) -> DataFrame:
    """Agent dimension: cold start, or `existing` with new agents added behind its keys."""
    members = distinct_members(fct, norm_agent("agent"), "agent_name")
    if existing is None:
        return _new_agents(dense_keys(members, "agent_name", "agent_key"), run_ts)
    added = _new_agents(extend_keys(existing, members, "agent_name", "agent_key"), run_ts)
    return existing.select(*DIM_AGENT.names).unionByName(added)


def retype_scd(dim: DataFrame) -> DataFrame:
    """Repair the types of an agent dimension that was loaded as text; blank or bad `valid_to` is null."""
    return dim.select(
        F.col("agent_key").cast("long").alias("agent_key"),
        "agent_name",
        F.col("valid_from").cast("timestamp").alias("valid_from"),
        F.nullif(strip(F.col("valid_to").cast("string")), F.lit("")).try_cast("timestamp").alias("valid_to"),
        F.col("is_current").cast("boolean").alias("is_current"),
    )


def scd2_apply(
    dim: DataFrame,
    incoming: DataFrame,
    key: str,
    natural: str,
    tracked: list[str],
    run_ts: datetime,
) -> DataFrame:
    """Type-2 change: close the current row of a member whose tracked attributes changed, open a new one.

    New members open a row too; members that do not come in stay current. `incoming` holds one row per
    member; new versions are keyed on from the highest key in member order. The anti and semi joins run on
    the member name and Spark sizes them from the written inputs.
    """
    now = F.lit(run_ts).cast("timestamp")
    current = dim.where("is_current")
    same = F.lit(True)
    for name in [natural, *tracked]:
        same = same & F.col(f"i.{name}").eqNullSafe(F.col(f"c.{name}"))
    changed = write_work(
        incoming.alias("i").join(current.alias("c"), same, "left_anti").select(natural, *tracked)
    )
    marked = dim.join(changed.select(natural, F.lit(1).alias("_renewed")), natural, "left")
    ends = F.col("is_current") & F.col("_renewed").isNotNull()
    closed = marked.withColumns(
        {
            "valid_to": F.when(ends, now).otherwise(F.col("valid_to")),
            "is_current": F.col("is_current") & ~ends,
        }
    ).select(*dim.columns)
    keyed = dense_keys(changed.select(natural), natural, key, after=dim.agg(F.max(key)).scalar())
    opened = keyed.join(changed, natural).select(
        *[
            {"valid_from": now, "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
            .get(c, F.col(c))
            .alias(c)
            for c in dim.columns
        ]
    )
    return closed.unionByName(opened)


# ---------------------------------------------------------------- statuses


def dim_lead_status(fct: DataFrame) -> DataFrame:
    """Cold-start status dimension: trimmed lower-case statuses, keys 1..n in sorted order."""
    members = distinct_members(fct, F.lower(strip("lead_status")), "lead_status")
    return dense_keys(members, "lead_status", "status_key").select(*DIM_LEAD_STATUS.names)


def canonical_status(dim: DataFrame) -> DataFrame:
    """Status dimension on normalised names. Of spellings that fall together the highest key stays."""
    return dim.groupBy(norm_status("lead_status").alias("lead_status")).agg(
        F.max("status_key").alias("status_key")
    ).select(*DIM_LEAD_STATUS.names)


def dim_status_incremental(existing: DataFrame, fct: DataFrame) -> DataFrame:
    """Keep the keys of known statuses and add the missing ones behind them."""
    known = canonical_status(existing)
    members = distinct_members(fct, norm_status("lead_status"), "lead_status")
    return known.unionByName(extend_keys(known, members, "lead_status", "status_key"))


# ---------------------------------------------------------------- dates


def dim_date(days: DataFrame) -> DataFrame:
    """Date dimension of the given days (one DATE column), without duplicates and nulls."""
    day = days.columns[0]
    unique = days.select(F.col(day).alias("full_date")).where("full_date is not null").distinct()
    return unique.select(*[c.alias(n) for n, c in calendar_columns(F.col("full_date")).items()])


def dim_date_observed(fct: DataFrame) -> DataFrame:
    """Date dimension of the days on which leads were added."""
    return dim_date(fct.select(F.to_date("added_on")))


def day_range(first: Column, last: Column, df: DataFrame) -> DataFrame:
    """One row (first_day, last_day) over a frame."""
    return df.agg(
        F.min(F.to_date(first)).alias("first_day"), F.max(F.to_date(last)).alias("last_day")
    )


def days_between(span: DataFrame) -> DataFrame:
    """Every day of a one-row (first_day, last_day) frame; at most the days of the calendar."""
    return span.where("first_day is not null").select(
        F.explode(F.sequence("first_day", "last_day")).alias("full_date")
    )


def dim_date_calendar(stg: DataFrame, first: str = "record_updated_at") -> DataFrame:
    """Gapless calendar up to the newest update; `first="added_on"` makes it reach back to the first lead."""
    span = day_range(F.col(first), F.col("record_updated_at"), stg)
    return days_between(span).select(
        *[c.alias(n) for n, c in calendar_columns(F.col("full_date")).items()]
    )


def fill_date_gaps(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add the days of `wanted` (any frame with `full_date`) that the calendar lacks; known rows stay.

    Columns that a narrower calendar lacks are derived from the day.
    """
    full = {n: F.col(n) if n in existing.columns else c.alias(n)
            for n, c in calendar_columns(F.col("full_date")).items()}
    known = existing.select(*full.values())
    missing = wanted.select("full_date").join(existing.select("full_date"), "full_date", "left_anti")
    return known.unionByName(dim_date(missing)).select(*DIM_DATE.names)


def dim_date_range(dim: DataFrame) -> DataFrame:
    return dim.agg(
        F.min("full_date").alias("min_date"),
        F.max("full_date").alias("max_date"),
        rows().alias("dates"),
    )


def _offers(fct: DataFrame) -> DataFrame:
    """Distinct (kind, member) rows: every agent, status and day of the fact, from one pass over it.

    Map tasks keep the distinct ones before the shuffle, so a hot agent is one row per task.
    """
    kinds = {
        "agent": norm_agent("agent"),
        "status": norm_status("lead_status"),
        "date": F.to_date("added_on").cast("string"),
    }
    offered = F.array(
        *[F.struct(F.lit(k).alias("kind"), c.alias("member")) for k, c in kinds.items()]
    )
    return fct.select(F.inline(offered)).where("member <> ''").distinct()


def build_dims(fct: DataFrame, run_ts: datetime, known: Dims | None = None) -> Dims:
    """Dimensions that match every fact row the star join can match.

    A cold start numbers all members; with `known` dimensions their keys stay and only members they lack are
    ranked and added behind.
    """
    members = _offers(fct)
    if known is not None:
        status = canonical_status(known.status)
        had = (
            known.agent.select(F.lit("agent").alias("kind"), norm_agent("agent_name").alias("member"))
            .unionByName(status.select(F.lit("status").alias("kind"), F.col("lead_status").alias("member")))
            .unionByName(known.date.select(F.lit("date").alias("kind"), F.col("full_date").cast("string").alias("member")))
        )
        members = write_work(members.join(had, ["kind", "member"], "left_anti"))
        if members.isEmpty():
            return Dims(known.agent.select(*DIM_AGENT.names), status, known.date)
    ranked = write_work(rank_members(members, "kind", "member"))

    def added(kind: str, key: str, name: str, table: DataFrame | None) -> DataFrame:
        last = F.lit(0) if table is None else F.coalesce(table.agg(F.max(key)).scalar(), F.lit(0))
        return ranked.where(F.col("kind") == kind).select(
            (last + F.col("rank")).cast("long").alias(key), F.col("member").alias(name)
        )

    agents = _new_agents(added("agent", "agent_key", "agent_name", known and known.agent), run_ts)
    statuses = added("status", "status_key", "lead_status", known and known.status)
    days = dim_date(added("date", "_", "day", None).select(F.col("day").cast("date")))
    if known is not None:
        agents = known.agent.select(*DIM_AGENT.names).unionByName(agents)
        statuses = status.unionByName(statuses)
        days = known.date.unionByName(days)
    return Dims(agents, statuses, days)
