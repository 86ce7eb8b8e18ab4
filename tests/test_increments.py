"""Increments: what they read and write, changes found by content, maintained sums, dates ahead, failed runs."""

from __future__ import annotations

import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from leadlake.operators import maintained, quality, reports, risk
from leadlake.operators.star import ReferentialError
from leadlake.operators.warehouse import fct_leads
from leadlake.plans.daily_run import Settings, run_load, tables
from leadlake.sources.store import Store
from tests.leads import T0, raw, stg
from tests.test_daily_run import NOW, S, lead, names

CONTENT = Settings(order=("src_ordinal",), detect="content", dq_threshold=0)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "warehouse"), buckets=4)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def same_sums(store):
    """The maintained sums are those of the leads that staging holds."""
    rebuilt = maintained.merged(maintained.sums_of(maintained.index_rows(fct_leads(store.read("stg_leads")))))
    assert rows(store.read("lead_sums")) == rows(rebuilt)
    assert rows(store.read("lead_index")) == rows(maintained.index_rows(fct_leads(store.read("stg_leads"))))


# ---------------------------------------------------------------- changes by content


def test_edits_without_a_date_are_loaded(spark, store):
    run_load(store, raw(spark, *[lead(n) for n in range(30)]), "r1", NOW, S)
    edited = [lead(n, **({"SDR Status": "Rejected"} if n % 5 == 0 else {})) for n in range(30)]
    blind = run_load(store, raw(spark, *edited), "r2", NOW, S)
    assert blind.rows_changed == 0
    out = run_load(store, raw(spark, *edited, lead(77)), "r3", NOW + timedelta(days=1), CONTENT)
    assert (out.rows_changed, out.rows_inserted, out.rows_unchanged, out.rows_loaded) == (7, 1, 24, 31)
    found = {r.name: (r.sdr_status, r.load_timestamp) for r in store.read("stg_leads").collect()}
    assert {n for n, (s, _) in found.items() if s == "Rejected"} == {f"n{n}" for n in range(0, 30, 5)}
    assert len({t for _, t in found.values()}) == 2  # unchanged leads keep their load time
    star = {r.name: r.lead_status for r in store.read("fct_leads_star").collect()}
    assert star["n5"] == "rejected" and star["n1"] == "replied"
    same_sums(store)
    again = run_load(store, raw(spark, *edited, lead(77)), "r4", NOW, CONTENT)
    assert (again.rows_changed, again.rows_unchanged) == (0, 31)


def test_late_and_undated_changes_are_found_by_content(spark, store):
    run_load(store, raw(spark, lead(1, 10), lead(2, 10)), "r1", NOW, S)
    late = raw(spark, lead(1, 10), lead(2, 3), lead(3, 1))
    assert run_load(store, late, "r2", NOW, CONTENT).rows_changed == 2
    assert names(store) == {"n1", "n2", "n3"}


def test_digest_tells_nulls_and_columns_apart(spark):
    cases = [
        {}, {"name": "a"}, {"job_title": "a"}, {"company": "a"}, {"name": ""}, {"hot_score": 0.0}, {"hot_score": 1.0},
        {"added_on": T0}, {"last_contacted": T0}, {"name": "a", "job_title": "b"}, {"name": "b", "job_title": "a"},
        {"name": "ab"}, {"sdr_status": " Replied"}, {"sdr_status": "Replied"}, {"record_updated_at": T0},
    ]
    df = stg(spark, *[{"staging_id": "x", **c} for c in cases]).select(*maintained.digests())
    assert len({r.digest_1 for r in df.collect()}) == len({r.digest_2 for r in df.collect()}) == len(cases)
    one = stg(spark, {"staging_id": "x", "load_timestamp": T0}, {"staging_id": "x"}).select(*maintained.digests())
    assert one.distinct().count() == 1


def test_unknown_detection_is_refused(spark, store):
    with pytest.raises(ValueError, match="sometimes"):
        run_load(store, raw(spark, lead(1)), "r1", NOW, Settings(order=S.order, detect="sometimes"))


# ---------------------------------------------------------------- cost of an increment


def written(store, run_id):
    """Rows that a run has written of each split table."""
    out = {}
    for name in ("stg_leads", "fct_leads_star", "lead_index"):
        path = f"{store.root}/{name}/load_id={run_id}"
        out[name] = store.spark.read.parquet(path).count() if os.path.exists(path) else 0
    return out


def test_small_increment_reads_no_leads_and_writes_only_its_own(spark, store, monkeypatch):
    run_load(store, raw(spark, *[lead(n) for n in range(400)]), "r1", NOW, S)
    read = []
    real = Store.read

    def watched(self, name, buckets=None, **more):
        read.append(name)
        return real(self, name, buckets, **more)

    with monkeypatch.context() as patched:
        patched.setattr(Store, "read", watched)
        change = [lead(n, 2, Name=f"c{n}") for n in (5, 50, 350)] + [lead(999, 2)]
        out = run_load(store, raw(spark, *change), "r2", NOW, S)
    assert (out.rows_changed, out.rows_loaded) == (4, 401)
    assert written(store, "r2") == {"stg_leads": 4, "fct_leads_star": 4, "lead_index": 4}
    assert not {"stg_leads", "fct_leads_star"} & set(read)
    assert store.read("stg_leads").count() == store.read("fct_leads_star").count() == 401
    assert {"c5", "c50", "c350", "n999"} < names(store) and not {"n5", "n50", "n350"} & names(store)
    same_sums(store)


def test_buckets_are_written_anew_when_deltas_grow(spark, store):
    run_load(store, raw(spark, *[lead(n) for n in range(100)]), "r1", NOW, S)
    for k in range(2, 7):
        run_load(store, raw(spark, *[lead(n, k, Name=f"v{k}") for n in range(10 * k, 10 * k + 8)]), f"r{k}", NOW, S)
    layers = store.layers("stg_leads")
    assert max(len(x) for x in layers.values()) <= 5  # 8 of 100 rows each: the fourth delta passes a quarter
    assert any(sum(written(store, f"r{k}").values()) > 24 for k in range(2, 7))  # carried over unchanged rows
    expected = {f"n{n}" for n in range(100) if not any(10 * k <= n < 10 * k + 8 for k in range(2, 7))}
    assert names(store) == expected | {f"v{k}" for k in range(2, 7)}
    assert store.read("stg_leads").count() == store.read("fct_leads_star").count() == 100
    assert store.read("stg_leads").select("staging_id").distinct().count() == 100
    same_sums(store)


def test_many_small_deltas_are_folded(spark, tmp_path):
    store = Store(spark, str(tmp_path / "one"), buckets=1)
    few = Settings(order=S.order, most_deltas=2, delta_share=10.0)
    for k in range(1, 6):
        run_load(store, raw(spark, lead(1, k, Name=f"v{k}"), lead(10 + k, k)), f"r{k}", NOW, few)
    assert len(store.layers("stg_leads")[0]) <= 3
    assert names(store) == {"v5", *(f"n{10 + k}" for k in range(1, 6))}


def test_large_deltas_are_joined_without_a_broadcast(spark, store, monkeypatch):
    run_load(store, raw(spark, *[lead(n) for n in range(40)]), "r1", NOW, S)
    run_load(store, raw(spark, lead(3, 2, Name="x")), "r2", NOW, S)
    with_hint = store.read("stg_leads")._jdf.queryExecution().logical().toString()
    monkeypatch.setattr("leadlake.sources.store._SMALL_DELTAS", 0)
    without = store.read("stg_leads")
    assert "broadcast" in with_hint.lower() and "broadcast" not in without._jdf.queryExecution().logical().toString().lower()
    assert without.count() == 40 and "x" in names(store) and "n3" not in names(store)


def test_full_refresh_after_deltas(spark, store):
    run_load(store, raw(spark, *[lead(n) for n in range(20)]), "r1", NOW, S)
    run_load(store, raw(spark, lead(3, 2, Name="x")), "r2", NOW, S)
    run_load(store, raw(spark, *[lead(n, Name="f") for n in range(3)]), "r3", NOW, Settings(order=S.order, mode="full"))
    assert rows(store.read("stg_leads"), "name") == [("f",)] * 3
    same_sums(store)


# ---------------------------------------------------------------- maintained sums


def random_lead(rng, n, day):
    moment = f"2026-08-{day:02d}"
    return lead(
        n, day,
        **{
            "Agent": rng.choice(["Ada", " Ada ", "Bob", "Cyd"]),
            "SDR Status": rng.choice(["Replied", "invite sent", "Invite_Sent", "linkedin rate limited", None, "odd"]),
            "Hot Score": rng.choice([None, "10", "70", "500"]),
            "Prioritized": rng.choice(["Yes", "no", "perhaps", None]),
            "Name": rng.choice(["x", " ", None]),
            "Source": rng.choice(["A", "B", None]), "Industry": rng.choice(["I", "J"]),
            "Last Contacted": rng.choice([None, moment]),
            "Invite Sent At": rng.choice([None, "2026-08-01", moment]),
            "Connected At": rng.choice([None, moment]),
        },
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_after_many_loads_equal_a_rebuild(spark, store, seed):
    rng = random.Random(seed)
    for k in range(1, 6):
        some = [random_lead(rng, n, rng.randint(1, 28)) for n in rng.sample(range(120), 100 if k == 1 else 25)]
        run_load(store, raw(spark, *some), f"r{k}", NOW + timedelta(days=k), CONTENT)
    same_sums(store)
    as_of = (NOW + timedelta(days=9)).date()
    stg_, sums, built = store.read("stg_leads"), store.read("lead_sums"), store.dims()
    fct, star = fct_leads(stg_), store.read("fct_leads_star")
    assert rows(maintained.lead_funnel(sums)) == rows(reports.lead_funnel(fct))
    assert rows(maintained.lead_status(sums)) == rows(reports.lead_status(fct))
    assert rows(maintained.agent_performance(sums)) == rows(reports.agent_performance(fct))
    assert rows(maintained.kpi_overview(sums, as_of)) == rows(reports.kpi_overview(fct, as_of))
    for segment in ("source", "industry"):
        assert rows(maintained.segment_performance(sums, segment)) == rows(reports.segment_performance(fct, segment))
    assert rows(maintained.star_funnel(sums)) == rows(reports.star_funnel(star))
    assert rows(maintained.star_agent_performance(sums, built)) == rows(reports.star_agent_performance(star, built.agent))
    assert rows(maintained.star_status(sums, built)) == rows(reports.star_status(star, built.status))
    assert rows(maintained.star_daily_trend(sums, built)) == rows(reports.star_daily_trend(star, built.date))
    later = NOW + timedelta(days=9)
    assert rows(maintained.dq_scores(sums, later)) == rows(quality.dq_scores(fct, later))
    base = risk.risk_base(fct, as_of)
    assert rows(maintained.risk_base(sums, as_of), *base.columns) == rows(base)
    assert rows(tables(store)["analytics_star_status"]) == rows(reports.star_status(star, built.status))


def test_sums_of_nothing(spark):
    none = maintained.merged(maintained.sums_of(maintained.index_rows(fct_leads(stg(spark)))))
    assert none.isEmpty()
    assert rows(maintained.lead_funnel(none)) == rows(reports.lead_funnel(fct_leads(stg(spark))))
    assert maintained.dq_scores(none, T0).first().dq_status == "FAIL"


def test_dates_ahead_of_a_load_become_timely_later(spark, store):
    soon = (NOW + timedelta(hours=5)).strftime("%Y-%m-%d %H:%M:%S")
    run_load(store, raw(spark, lead(1), lead(2, **{"Last Contacted": soon})), "r1", NOW, Settings(order=S.order, dq_threshold=0))
    fct, sums = fct_leads(store.read("stg_leads")), store.read("lead_sums")
    for as_of in (NOW, NOW + timedelta(hours=4), NOW + timedelta(hours=6)):
        assert rows(maintained.dq_scores(sums, as_of)) == rows(quality.dq_scores(fct, as_of))


# ---------------------------------------------------------------- dates ahead, failed runs


def test_a_wrong_date_does_not_end_later_loads(spark, store):
    typo = lead(0, **{"Last Contacted": "2062-08-01"})
    first = run_load(store, raw(spark, *[lead(n) for n in range(1, 61)], typo), "r1", NOW, S)
    assert (first.rows_loaded, first.dead_letters, first.watermark_end) == (60, 1, T0)
    letter = store.ledger("dead_letter_leads").first()
    assert (letter.name, letter.error_reason) == ("n0", "Date in the future;")
    out = run_load(store, raw(spark, *[lead(n, 2) for n in range(100, 140)]), "r2", NOW + timedelta(days=1), S)
    assert (out.rows_changed, out.rows_loaded) == (40, 100)
    assert store.read("dim_date").count() < 100
    # the corrected lead comes in, also where its true date lies below the mark
    fixed = run_load(store, raw(spark, lead(0)), "r3", NOW + timedelta(days=2), CONTENT)
    assert fixed.rows_inserted == 1 and "n0" in names(store)


def test_kept_dates_ahead_never_move_the_mark_past_the_clock(spark, store):
    keep = Settings(order=S.order, ahead=None, dq_threshold=0)
    run_load(store, raw(spark, lead(1), lead(2, **{"Connected At": "2026-12-24"})), "r1", NOW, keep)
    assert names(store) == {"n1", "n2"}
    out = run_load(store, raw(spark, lead(3, **{"Last Contacted": "2026-10-05"})), "r2", NOW + timedelta(days=9), keep)
    assert out.watermark_start == NOW and names(store) == {"n1", "n2", "n3"}


def test_failed_run_keeps_its_malformed_records(spark, store):
    broken = spark.createDataFrame([("f.json", '{"Name": ', "Malformed record;")], "src_file string, raw_record string, error_reason string")
    with pytest.raises(ReferentialError):
        run_load(store, raw(spark, lead(1, Agent=" ")), "r1", NOW, S, broken)
    assert store.ledger("malformed_records").count() == 1
    row = store.ledger("pipeline_runs").first()
    assert (row.status, row.rows_read) == ("FAILED", 2)


def test_work_tables_are_removed(spark, store):
    run_load(store, raw(spark, lead(1)), "r1", NOW, S)
    run_load(store, raw(spark, lead(1, Name="x")), "r2", NOW, CONTENT)
    with pytest.raises(ReferentialError):
        run_load(store, raw(spark, lead(2, Agent=" ")), "r3", NOW, CONTENT)
    for name in ("_staged", "_changed"):
        assert not [x for x in os.listdir(f"{store.root}/{name}") if x.startswith("load_id")]
