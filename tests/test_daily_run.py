"""Store, daily load and streaming route."""

from __future__ import annotations

import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from leadlake.operators import checks, dims
from leadlake.operators.quality import QualityError
from leadlake.operators.star import ReferentialError
from leadlake.plans.daily_run import Settings, register_views, run_load, tables
from leadlake.schemas import DIM_LEAD_STATUS, DQ_RESULTS, PIPELINE_RUNS, RAW_TO_STAGING
from leadlake.sources.files import read_leads_csv
from leadlake.sources.store import Store
from leadlake.streaming.ingest import stream_leads
from tests.leads import T0, raw, url

S = Settings(order=("src_ordinal",))
NOW = T0 + timedelta(days=60)


def lead(n, day=1, **more):
    return {"LinkedIn URL": url(n), "Name": f"n{n}", "Agent": f"agent {n % 3}", "SDR Status": "Replied",
            "Added On": f"2026-08-{day:02d}", "Last Contacted": None, "Invite Sent At": None,
            "Connected At": None, **more}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "warehouse"), buckets=4)


def names(store):
    return {r.name for r in store.read("stg_leads").collect()}


def test_first_run_builds_everything(spark, store):
    out = run_load(store, raw(spark, *[lead(n) for n in range(20)], lead(5, Name="last")), "r1", NOW, S)
    assert (out.rows_read, out.rows_loaded, out.dead_letters, out.watermark_start) == (21, 20, 0, None)
    assert out.watermark_end == T0
    found = tables(store)
    assert found["fct_leads_star"].count() == found["fact_leads"].count() == 20
    assert found["vw_leads_analytics"].where("agent_name is null or lead_status <> 'replied'").isEmpty()
    assert found["analytics_risk_scores"].count() == 3
    assert "last" in names(store) and "n5" not in names(store)
    row = found["pipeline_runs"].first()
    assert (row.status, row.rows_read, row.rows_loaded) == ("SUCCESS", 21, 20)
    assert "analytics_star_daily_trend" in register_views(store)
    assert spark.sql("select sum(total_leads) from analytics_star_daily_trend").first()[0] == 20


def test_repeat_run_adds_nothing(spark, store):
    source = raw(spark, *[lead(n) for n in range(12)])
    run_load(store, source, "r1", NOW, S)
    before = sorted(store.read("stg_leads").collect())
    again = run_load(store, source, "r2", NOW + timedelta(days=1), S)
    assert (again.rows_changed, again.rows_loaded) == (0, 12)
    assert again.watermark_end == again.watermark_start == T0
    assert sorted(store.read("stg_leads").collect()) == before
    assert run_load(store, source, "r2", NOW, S).status == "ALREADY_LOADED"
    assert store.ledger("pipeline_runs").count() == 2


def test_upsert_touches_only_buckets_of_changed_leads(spark, store):
    run_load(store, raw(spark, *[lead(n) for n in range(40)]), "r1", NOW, S)
    keys = {r.agent_name: r.agent_key for r in store.read("dim_agent").collect()}
    change = [lead(7, 2, Name="changed", Agent="newcomer"), lead(99, 2, Name="new")]
    out = run_load(store, raw(spark, *change), "r2", NOW + timedelta(days=1), S)
    assert (out.rows_changed, out.rows_loaded) == (2, 41)
    assert names(store) == {f"n{n}" for n in range(40) if n != 7} | {"changed", "new"}
    runs = set(store._current("stg_leads").values())
    assert runs == {"r1", "r2"} and 1 <= list(store._current("stg_leads").values()).count("r2") <= 2
    grown = {r.agent_name: r.agent_key for r in store.read("dim_agent").collect()}
    assert grown == {**keys, "newcomer": 4}
    star = store.read("fct_leads_star")
    assert star.count() == 41 and star.where("agent_key is null").isEmpty()


@pytest.mark.parametrize("rows", [1000, 9_500_000])
def test_each_shuffle_task_holds_one_bucket(spark, store, rows):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("staging_id"))
    tasks = F.spark_partition_id().alias("task")
    placed = store.by_lead(df, rows).select(tasks, store.bucket().alias("bucket")).distinct()
    assert placed.groupBy("task").count().where("count > 1").isEmpty()
    assert placed.select("task").distinct().count() == (4 if rows == 1000 else 12)


def test_another_bucket_count_is_refused(spark, store):
    run_load(store, raw(spark, *[lead(n) for n in range(40)]), "r1", NOW, S)
    other = Store(spark, store.root, buckets=16)
    with pytest.raises(ValueError, match="4 buckets, not in 16"):
        run_load(other, raw(spark, *[lead(n, 2) for n in range(3)]), "r2", NOW, S)
    assert store.read("stg_leads").count() == 40


def test_a_second_pipeline_adds_to_staging(spark, store):
    run_load(store, raw(spark, *[lead(n, 20) for n in range(40)]), "r1", NOW, Settings(order=S.order, pipeline="one"))
    out = run_load(store, raw(spark, *[lead(n, 10) for n in range(50, 60)]), "r2", NOW, Settings(order=S.order, pipeline="two"))
    assert out.rows_loaded == 50 and store.read("stg_leads").count() == 50


def test_full_refresh_replaces_staging(spark, store):
    run_load(store, raw(spark, *[lead(n) for n in range(30)]), "r1", NOW, S)
    out = run_load(store, raw(spark, lead(3, Name="only")), "r2", NOW, Settings(order=S.order, mode="full"))
    assert out.rows_loaded == 1 and names(store) == {"only"}
    assert store.read("fct_leads_star").count() == 1


def test_late_row_needs_overlap(spark, store):
    run_load(store, raw(spark, lead(1, 10)), "r1", NOW, S)
    late = raw(spark, lead(1, 10), lead(2, 5))
    assert run_load(store, late, "r2", NOW, S).rows_loaded == 1
    wide = Settings(order=S.order, overlap=timedelta(days=7))
    assert run_load(store, late, "r3", NOW, wide).rows_loaded == 2


def test_malformed_row_becomes_dead_letter_every_run(spark, store):
    source = raw(spark, *[lead(n) for n in range(5)], lead(9, **{"LinkedIn URL": None}))
    assert run_load(store, source, "r1", NOW, S).dead_letters == 1
    run_load(store, source, "r2", NOW, S)
    letters = store.ledger("dead_letter_leads").collect()
    assert {r.dead_letter_run_id for r in letters} == {"r1", "r2"}
    assert {r.error_reason for r in letters} == {"Missing linkedin_url; Missing staging_id;"}


def test_blank_agent_fails_the_run_and_nothing_is_published(spark, store):
    run_load(store, raw(spark, lead(1)), "r1", NOW, S)
    bad = raw(spark, lead(2, 5, Agent="  "))
    with pytest.raises(ReferentialError, match="agent"):
        run_load(store, bad, "r2", NOW, S)
    assert names(store) == {"n1"} and store.read("fct_leads_star").count() == 1
    failed = store.ledger("pipeline_runs").where("status = 'FAILED'").first()
    assert failed.run_id == "r2" and "missing_agent_keys" in failed.error_message
    good = run_load(store, raw(spark, lead(2, 5)), "r2", NOW, S)
    assert good.watermark_start == T0 and names(store) == {"n1", "n2"}


def test_quality_gate_stops_publishing(spark, store):
    poor = raw(spark, *[lead(n, **{"SDR Status": "odd", "Prioritized": "perhaps", "Hot Score": "500"}) for n in range(4)])
    with pytest.raises(QualityError):
        run_load(store, poor, "r1", NOW, S)
    assert store.read("stg_leads").isEmpty()
    events = {(r.run_id, r.event) for r in tables(store)["alert_events"].collect() if r.event == "pipeline_failure"}
    assert events == {("r1", "pipeline_failure")}
    assert store.ledger("dq_results").first().dq_status == "FAIL"


def test_crash_before_publishing_leaves_no_trace(spark, store, monkeypatch):
    run_load(store, raw(spark, lead(1)), "r1", NOW, S)

    def crash(*_):
        raise OSError("lost the driver")

    with monkeypatch.context() as patched:
        patched.setattr(Store, "publish", crash)
        with pytest.raises(OSError, match="driver"):
            run_load(store, raw(spark, lead(2, 9)), "r2", NOW, S)
    assert names(store) == {"n1"}
    out = run_load(store, raw(spark, lead(2, 9)), "r2", NOW, S)
    assert out.watermark_start == T0 and names(store) == {"n1", "n2"}


def test_source_without_valid_rows_leaves_staging_alone(spark, store):
    run_load(store, raw(spark, lead(1)), "r1", NOW, S)
    out = run_load(store, raw(spark, lead(2, **{"Added On": None})), "r2", NOW, Settings(order=S.order, mode="full"))
    assert out.rows_loaded == 1 and names(store) == {"n1"}


def test_new_status_and_old_dates_do_not_break_the_star(spark, store):
    run_load(store, raw(spark, lead(1, 20)), "r1", NOW, S)
    later = raw(spark, lead(2, 2, **{"SDR Status": "not interested", "Connected At": "2026-09-30"}))
    run_load(store, later, "r2", NOW, Settings(order=S.order, dq_threshold=0))
    star = store.read("fct_leads_star").where("name = 'n2'").first()
    assert (star.lead_status, star.date_key) == ("not_interested", 20260802)
    assert tuple(dims.dim_date_range(store.read("dim_date")).first())[2] == 60


# ---------------------------------------------------------------- store


def test_replace_ensure_and_presence(spark, store):
    dim = spark.createDataFrame([(1, "replied")], DIM_LEAD_STATUS)
    store.ensure("dim_lead_status")
    assert store.exists("dim_lead_status") and store.read("dim_lead_status").isEmpty()
    store.replace("dim_lead_status", dim, "a")
    store.replace("dim_lead_status", dim.limit(0), "b")
    store.replace("dim_lead_status", dim.withColumn("status_key", F.lit(9).cast("long")), "a")
    assert [r.status_key for r in store.read("dim_lead_status").collect()] == [1]
    found = {r.table: r.exists for r in store.required_tables(["dim_lead_status", "dim_agent"]).collect()}
    assert found == {"dim_lead_status": 1, "dim_agent": 0}
    store.require_tables(["dim_lead_status"])
    with pytest.raises(RuntimeError, match="dim_agent"):
        store.require_tables(["dim_lead_status", "dim_agent"])
    columns = {(r.name, r.type, r.nullable) for r in checks.schema_of(dim).collect()}
    assert columns == {("status_key", "bigint", False), ("lead_status", "string", False)}


def test_alert_rules(spark):
    def run(name, status, seconds, error=None):
        return (name, "p", T0, T0 + timedelta(seconds=seconds), 1, 1, status, None, None, error)

    runs = spark.createDataFrame(
        [run("ok", "SUCCESS", 300), run("slow", "SUCCESS", 300.5), run("bad", "FAILED", 900, "boom")], PIPELINE_RUNS
    )
    dq = spark.createDataFrame(
        [("q1", T0, 1, *[1.0] * 5, 94.996, 95.0, "FAIL"), ("q2", T0, 1, *[1.0] * 5, 95.0, 95.0, "PASS")], DQ_RESULTS
    )
    got = {tuple(r) for r in checks.alert_events(runs, dq).collect()}
    assert got == {
        ("bad", "pipeline_failure", "CRITICAL", "boom"),
        ("slow", "anomalous_run_duration", "WARNING", "duration_seconds=300.5"),
        ("q1", "dq_threshold_breach", "CRITICAL", "dq_score=95.0"),
    }
    assert checks.alert_events(runs, dq, max_seconds=1000).count() == 2


# ---------------------------------------------------------------- streaming


def landed(path, name, *leads, at=0):
    cells = [{h: {**lead(0), "Hot Score": "80", "Prioritized": "Yes", "Source": "Feed", **x}.get(h) for h in RAW_TO_STAGING} for x in leads]
    text = ",".join(RAW_TO_STAGING) + "\n" + "\n".join(",".join(c[h] or "" for h in RAW_TO_STAGING) for c in cells)
    target = path / f"{name}.csv"
    target.write_text(text + "\n")
    os.utime(target, (1_700_000_000 + at, 1_700_000_000 + at))


def test_stream_equals_batch_and_takes_only_new_files(spark, store, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    landed(landing, "b", *[lead(n) for n in range(10)], at=0)
    landed(landing, "a", lead(3, 4, Name="x3"), lead(4, 1, Name="x4"), lead(50, 4), at=10)
    settings = Settings(use_watermark=False)
    stream_leads(spark, str(landing), store, files_per_batch=1, settings=settings, run_ts=NOW).awaitTermination()
    batch = Store(spark, str(tmp_path / "batch"), buckets=4)
    run_load(batch, read_leads_csv(spark, str(landing)), "r1", NOW, Settings())
    store.refresh()
    assert names(store) == names(batch) == {"x3", "x4", "n50"} | {f"n{n}" for n in range(10) if n not in (3, 4)}
    assert store.read("stg_leads").exceptAll(batch.read("stg_leads")).isEmpty()
    runs = store.ledger("pipeline_runs").count()
    assert runs == 2
    landed(landing, "c", lead(60, 5), at=20)
    stream_leads(spark, str(landing), store, settings=settings, run_ts=NOW).awaitTermination()
    store.refresh()
    assert "n60" in names(store) and store.ledger("pipeline_runs").count() == 3
    stream_leads(spark, str(landing), store, settings=settings, run_ts=NOW).awaitTermination()
    assert store.ledger("pipeline_runs").count() == 3


def test_json_stream(spark, store, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "p.json").write_text("\n".join(json.dumps({**lead(n), "Prioritized": "Yes"}) for n in range(3)))
    stream_leads(spark, str(landing), store, fmt="json", run_ts=NOW).awaitTermination()
    store.refresh()
    assert names(store) == {"n0", "n1", "n2"}




def test_a_load_shuffles_its_leads_once_for_all_split_tables(spark, store, monkeypatch):
    """Star and index rows are made of the rows that staging has got, which lie in their buckets; a load that writes
    buckets anew still gives the same."""
    calls, by_lead = [], Store.by_lead

    def counted(self, df, *args):
        calls.append(df.columns)
        return by_lead(self, df, *args)

    monkeypatch.setattr(Store, "by_lead", counted)
    run_load(store, raw(spark, *[lead(n) for n in range(40)]), "r1", NOW, S)
    assert len(calls) == 1 and "linkedin_url" in calls[0]
    files = spark.read.parquet(f"{store.root}/fct_leads_star/load_id=r1").select("_metadata.file_path", "bucket").distinct()
    assert files.count() == files.select("bucket").distinct().count() == 4
    run_load(store, raw(spark, *[lead(n, 2, Name=f"m{n}") for n in range(40)]), "r2", NOW + timedelta(days=1), S)
    for name in ("stg_leads", "fct_leads_star", "lead_index"):
        rows_ = store.read(name)
        assert rows_.count() == rows_.select("staging_id").distinct().count() == 40
    assert names(store) == {f"m{n}" for n in range(40)}
    total = store.read("lead_sums").where("kind = 'all'").first()
    assert (total.total_rows, total.rows_with_url) == (40, 40)
