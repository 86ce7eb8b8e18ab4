"""Dimensions, star join and referential checks."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from leadlake.operators import checks, dims, star
from leadlake.operators.warehouse import fct_leads
from leadlake.schemas import DIM_AGENT, DIM_DATE, DIM_LEAD_STATUS
from tests.leads import T0, stg


def fact(spark, *leads):
    filled = [{"staging_id": f"id{i}", "added_on": T0, "record_updated_at": T0, **r} for i, r in enumerate(leads)]
    return fct_leads(stg(spark, *filled))


def pairs(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def test_dense_keys_are_sorted_and_gapless_over_many_partitions(spark):
    names = [f"{random.Random(i).random():.12f}-{i}" for i in range(5000)]
    members = spark.createDataFrame([(n,) for n in names], "m string").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pairs(dims.dense_keys(members, "m", "k"), "k", "m")
        behind = pairs(dims.dense_keys(members, "m", "k", after=F.lit(100)), "k", "m")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == set(enumerate(sorted(names), start=1))
    assert behind == set(enumerate(sorted(names), start=101))


def test_dense_keys_sort_by_code_point(spark):
    names = ["b", "B", "a", "Ä", "é", "z", "Z", "10", "9"]
    members = spark.createDataFrame([(n,) for n in names], "m string")
    assert pairs(dims.dense_keys(members, "m", "k"), "k", "m") == set(enumerate(sorted(names), start=1))


def test_agents_are_trimmed_distinct_and_sorted(spark, run_ts):
    rows = fact(spark, {"agent": " Zoe "}, {"agent": "Zoe"}, {"agent": None}, {"agent": " "}, {"agent": "Ada"})
    dim = dims.dim_agent(rows, run_ts)
    assert dim.schema.names == DIM_AGENT.names
    assert pairs(dim, "agent_key", "agent_name", "valid_to", "is_current") == {(1, "Ada", None, True), (2, "Zoe", None, True)}


def test_new_agents_get_keys_behind_the_known_ones(spark, run_ts):
    known = dims.dim_agent(fact(spark, {"agent": "Mia"}, {"agent": "Zoe"}), run_ts)
    grown = dims.dim_agent(fact(spark, {"agent": "Bo"}, {"agent": "Mia"}, {"agent": "Ada"}), run_ts, known)
    assert pairs(grown, "agent_key", "agent_name") == {(1, "Mia"), (2, "Zoe"), (3, "Ada"), (4, "Bo")}


def test_status_dimension_with_gaps_keeps_its_keys(spark):
    known = spark.createDataFrame([(1, "captured"), (2, "connected"), (5, "invite sent")], DIM_LEAD_STATUS)
    names = ["invite_sent", "Enriched", "linkedin rate limited", "rejected", "replied", None, "Captured "]
    rows = fact(spark, *[{"sdr_status": n} for n in names])
    grown = dims.dim_status_incremental(known, rows)
    assert pairs(grown, "status_key", "lead_status") == {
        (1, "captured"), (2, "connected"), (5, "invite_sent"), (6, "enriched"), (7, "linkedin_rate_limited"),
        (8, "rejected"), (9, "replied"), (10, "unknown"),
    }
    assert star.status_unmatched(rows, grown).first().unmatched_rows == 0
    assert star.status_unmatched(rows, known).first().unmatched_rows == 5


def test_status_spellings_keep_the_highest_key(spark):
    dim = spark.createDataFrame([(3, "invite sent"), (7, "invite_sent"), (1, "replied")], DIM_LEAD_STATUS)
    assert pairs(dims.canonical_status(dim), "status_key", "lead_status") == {(7, "invite_sent"), (1, "replied")}


def test_calendar_and_gap_fill(spark):
    rows = stg(spark, {"record_updated_at": T0}, {"record_updated_at": T0 + timedelta(days=40)}, {})
    whole = dims.dim_date_calendar(rows)
    assert whole.schema.names == DIM_DATE.names
    assert whole.count() == 41
    assert tuple(dims.dim_date_range(whole).first()) == (date(2026, 8, 1), date(2026, 9, 10), 41)
    holed = whole.where("day_of_month <> 24")
    filled = dims.fill_date_gaps(holed, whole.select("full_date"))
    assert filled.count() == 41 and filled.exceptAll(whole).isEmpty()
    narrow = holed.select("date_key", "full_date", "year", "month", "month_name", "quarter")
    assert dims.fill_date_gaps(narrow, whole.select("full_date")).exceptAll(whole).isEmpty()
    assert dims.dim_date_calendar(rows.limit(0)).isEmpty()


def test_scd_text_types_are_repaired(spark):
    dim = spark.createDataFrame(
        [("1", "Ada", "2026-08-01 00:00:00", " ", "true"), ("2", "Bo", "2026-08-01 00:00:00", "soon", "false"),
         ("3", "Cy", "2026-08-01 00:00:00", "2026-08-02 01:02:03", "false")],
        "agent_key string, agent_name string, valid_from string, valid_to string, is_current string",
    )
    fixed = dims.retype_scd(dim)
    assert [f.dataType for f in fixed.schema] == [f.dataType for f in DIM_AGENT]
    ends = pairs(fixed.withColumn("e", F.col("valid_to").cast("string")), "agent_key", "e")
    assert ends == {(1, None), (2, None), (3, "2026-08-02 01:02:03")}


def test_history_closes_changed_and_opens_new_versions(spark, run_ts):
    dim = spark.createDataFrame(
        [(1, "Ada", "north", run_ts, None, True), (2, "Bo", None, run_ts, None, True), (3, "Cy", "east", run_ts, None, True)],
        "agent_key long, agent_name string, team string, valid_from timestamp, valid_to timestamp, is_current boolean",
    )
    later = run_ts + timedelta(days=1)
    incoming = spark.createDataFrame(
        [("Ada", "south"), ("Bo", None), ("Di", "west")], "agent_name string, team string"
    )
    once = dims.scd2_apply(dim, incoming, "agent_key", "agent_name", ["team"], later)
    got = pairs(once, "agent_key", "agent_name", "team", "is_current")
    assert got == {
        (1, "Ada", "north", False), (2, "Bo", None, True), (3, "Cy", "east", True), (4, "Ada", "south", True),
        (5, "Di", "west", True),
    }
    closed = once.where("not is_current").first()
    assert closed.valid_to == once.where("agent_key = 4").first().valid_from
    again = dims.scd2_apply(once, incoming, "agent_key", "agent_name", ["team"], later)
    assert pairs(again, "agent_key", "agent_name", "team", "is_current") == got
    assert checks.scd_check(once).first().scd_valid == 1


def test_star_rows_equal_fact_rows_even_with_doubled_dimension_members(spark, run_ts):
    rows = fact(spark, {"agent": " Ada ", "sdr_status": "Invite Sent"}, {"agent": "Bo", "sdr_status": "invite_sent"})
    built = dims.build_dims(rows, run_ts)
    agents = built.agent.unionByName(
        built.agent.withColumns({"agent_key": F.col("agent_key") + 10, "agent_name": F.concat("agent_name", F.lit(" "))})
    )
    statuses = spark.createDataFrame([(1, "invite sent"), (4, "invite_sent")], DIM_LEAD_STATUS)
    keyed = star.star_fact(rows, dims.Dims(agents, statuses, built.date.union(built.date)))
    assert pairs(keyed, "agent", "lead_status", "agent_key", "status_key", "date_key") == {
        ("Ada", "invite_sent", 11, 4, 20260801), ("Bo", "invite_sent", 12, 4, 20260801),
    }
    assert keyed.count() == 2


def test_only_current_agents_match(spark, run_ts):
    rows = fact(spark, {"agent": "Ada"})
    built = dims.build_dims(rows, run_ts)
    closed = dims.Dims(built.agent.withColumn("is_current", F.lit(False)), built.status, built.date)
    counts = star.missing_keys(star.star_fact(rows, closed)).first().asDict()
    assert counts == {"missing_agent_keys": 1, "missing_status_keys": 0, "missing_date_keys": 0}
    with pytest.raises(star.ReferentialError, match="agent"):
        star.require_keys(counts)


def test_star_without_broadcasting_gives_the_same_rows(spark, run_ts):
    rows = fact(spark, *[{"agent": f"a{i % 7}", "sdr_status": f"s{i % 3}"} for i in range(50)], {"agent": None})
    built = dims.build_dims(rows, run_ts)
    small = star.star_fact(rows, built).orderBy("staging_id").collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = star.star_fact(rows, built)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert large.orderBy("staging_id").collect() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_extended_dimensions_keep_keys_and_match_everything(spark, run_ts):
    first = fact(spark, {"agent": "Mia", "sdr_status": "replied"})
    known = dims.build_dims(first, run_ts)
    more = fact(spark, {"agent": "Ada", "sdr_status": "Invite Sent", "added_on": T0 + timedelta(days=3)}, {"agent": "Mia"})
    grown = dims.build_dims(more, run_ts, known)
    assert pairs(grown.agent, "agent_key", "agent_name") == {(1, "Mia"), (2, "Ada")}
    assert pairs(grown.status, "status_key", "lead_status") == {(1, "replied"), (2, "invite_sent"), (3, "unknown")}
    assert grown.date.count() == 2
    assert set(star.missing_keys(star.star_fact(more, grown)).first()) == {0}


def test_orphans_with_and_without_null_keys(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "agent_key long")
    dim = spark.createDataFrame([(1,)], "agent_key long")
    assert star.orphans(facts, dim, "agent_key").first().orphan_count == 1
    assert star.orphans(facts, dim, "agent_key", count_null=True).first().orphan_count == 2
    assert star.orphans(facts.limit(0), dim, "agent_key").first().orphan_count == 0


def test_verification_verdict(spark, run_ts):
    rows = fact(spark, {"agent": "Ada"}, {"agent": "Bo"})
    built = dims.build_dims(rows, run_ts)
    keyed = star.star_fact(rows, built)
    good = {r["check"]: (r.value, r.passed) for r in checks.verify_star(keyed, built).collect()}
    assert good["verdict"] == (0, 1) and good["fact_rows"] == (2, 1) and good["scd_structure"] == (2, 1)
    assert checks.validate_warehouse(keyed, built)
    bad = {r["check"]: (r.value, r.passed) for r in checks.verify_star(keyed.union(keyed), built).collect()}
    assert bad["duplicate_ids"] == (2, 0) and bad["verdict"] == (1, 0)
    with pytest.raises(RuntimeError, match="duplicate"):
        checks.validate_warehouse(keyed.union(keyed), built)
    empty = {r["check"]: r.passed for r in checks.verify_star(keyed.limit(0), built).collect()}
    assert empty["fact_rows"] == 0 and empty["verdict"] == 0
