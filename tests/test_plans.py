"""Physical plans: what shuffles, what is broadcast, what reaches the scan; and hot keys."""

from __future__ import annotations

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from leadlake.operators import checks, dims, incremental, quality, reports, risk, staging, star
from leadlake.operators.dedup import keep_last
from leadlake.operators.warehouse import fct_leads
from leadlake.plans import catalog
from leadlake.session import write_work
from leadlake.sources.testleads import raw_leads


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark, sf):
    return catalog.written_fact(spark, sf)


@pytest.fixture(scope="module")
def built(facts):
    return dims.build_dims(facts, catalog.RUN_TS)


def test_staging_shuffles_leads_once_and_limits_before_it(spark, sf):
    leads = write_work(raw_leads(spark, sf))
    text = plan(staging.stage_leads(leads, catalog.RUN_TS, ["src_ordinal"]))
    assert text.count("Exchange") == 1
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "Python" not in text


def test_star_join_leaves_the_fact_in_place(facts, built):
    text = plan(star.star_fact(facts, built))
    fact_side = text[: text.index("staging_id#", text.index("FileScan"))]
    assert text.count("LeftOuter, BuildRight") == 3
    assert "SortMergeJoin" not in text
    assert "Exchange hashpartitioning(staging_id" not in fact_side


def test_watermark_filter_reaches_the_scan(facts):
    cut = datetime(1999, 1, 1, tzinfo=timezone.utc)
    text = plan(incremental.incremental_rows(facts, cut))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(record_updated_at,1999", text)


def test_reports_read_only_their_columns(facts):
    text = plan(reports.agent_performance(facts))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "agent", "is_contacted", "is_invite_sent", "is_connected", "is_hot_lead",
    }
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_star_reports_aggregate_before_the_join(facts, built):
    keyed = write_work(star.star_fact(facts, built))
    text = plan(reports.star_agent_performance(keyed, write_work(built.agent)))
    assert text.index("Join") < text.index("HashAggregate")
    assert text.count("FileScan") == 2


def test_quality_scores_take_one_scan_and_one_for_each_exact_distinct_count(facts):
    columns = re.findall(r"ReadSchema: struct<(.*?)>", plan(quality.dq_scores(facts, catalog.AS_OF_TS)))
    assert {"staging_id:string", "linkedin_url:string"} <= set(columns)
    assert plan(quality.dq_scores(facts, catalog.AS_OF_TS, rsd=0.01)).count("FileScan") == 1


def test_pooled_rate_takes_no_second_pass_over_leads(facts):
    text = plan(risk.risk_scores(facts, catalog.AS_OF))
    assert "FileScan" not in text and "Subquery" in text


def test_dimensions_take_one_scan(facts):
    assert plan(dims._offers(facts)).count("FileScan") == 1


def test_no_query_runs_python_per_row(spark, sf):
    writers = {"csv_scan", "json_updated_after", "load_in_batches", "load_then_risk", "stream_staging"}
    writers |= {"load_then_reports", "load_then_daily_trend", "load_then_quality"}  # the loads of load_then_risk
    readers = {"csv_mixed_headers", "stream_mixed_headers"}  # lines are put together to CSV records in Arrow batches
    for name in set(catalog.QUERIES) - writers - readers:
        text = plan(catalog.QUERIES[name](spark, sf))
        assert not re.search(r"EvalPython|MapInPandas|MapInArrow|FlatMapGroups|Cartesian", text), name


# ---------------------------------------------------------------- hot keys


def test_hot_key_is_thinned_before_the_shuffle(spark):
    rows = spark.range(0, 300_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50_000).cast("string").alias("k"),
        F.col("id").alias("o"),
    )
    kept = keep_last(rows, ["k"], ["o"])
    want = {r.k: r.o for r in rows.groupBy("k").agg(F.max("o").alias("o")).collect()}
    assert {r.k: r.o for r in kept.collect()} == want
    text = plan(kept)
    assert text.index("WindowGroupLimit", text.index("Exchange")) > text.index("Exchange")
    counted = keep_last(rows, ["k"], ["o"], copies="n")
    assert counted.agg(F.sum("n")).first()[0] == 300_000
    assert {r.k: r.o for r in counted.collect()} == want
    assert "partial_max_by" in plan(counted)


def test_hot_agent_does_not_multiply_or_lose_rows(spark):
    facts = fct_leads(hot_leads(spark))
    written = write_work(facts)
    built = dims.build_dims(written, catalog.RUN_TS)
    keyed = star.star_fact(written, built)
    assert keyed.count() == 60_000
    assert set(star.missing_keys(keyed).first()) == {0}
    assert star.orphans(keyed, built.agent.where("agent_name <> 'hot'"), "agent_key").first()[0] == 20_000
    top = reports.star_agent_performance(keyed, built.agent).where("agent_name = 'hot'").first()
    assert top.total_leads == 20_000
    assert checks.duplicate_ids(keyed).first().duplicates == 0


def hot_leads(spark):
    from leadlake.schemas import STG_LEADS

    base = spark.range(0, 60_000, 1, 8)
    given = {
        "staging_id": F.md5(F.col("id").cast("string")),
        "agent": F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), (F.col("id") % 5000).cast("string"))),
        "sdr_status": F.lit("replied"),
        "added_on": F.timestamp_seconds(F.lit(1_000_000_000) + F.col("id") * 1000),
    }
    return base.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STG_LEADS])


def test_quality_multiplies_no_rows(facts):
    for scores in (quality.dq_uniqueness(facts), quality.dq_scores(facts, catalog.AS_OF_TS)):
        assert "Expand" not in plan(scores)
