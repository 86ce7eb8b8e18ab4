"""Golden vectors of the quality scores and the risk model."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from leadlake.operators import quality, reports, risk
from leadlake.operators.warehouse import fct_leads
from tests.leads import T0, stg, url

COUNTS = "agent string, total_leads long, contacted_leads long, invite_sent_leads long, connected_leads long, replied_leads long, ghosted_leads long"


def scored(spark, *agents):
    base = spark.createDataFrame(agents, COUNTS).withColumns(
        {"hot_leads": F.lit(0).cast("long"), "avg_days_to_connection": F.lit(None).cast("double")}
    )
    return {r.agent: r for r in risk.score_agents(base).collect()}


#: agent, total, contacted, invited, connected, replied, ghosted -> bound, z, points, score, level, capacity
BOUNDARY = [
    (("a_big", 1000, 900, 800, 300, 45, 100), (0.272406, 8.777161, 0, 0, 0, 0, "LOW", 18)),
    (("b_highrisk", 400, 380, 200, 8, 2, 120), (0.010168, -8.697430, 35, 30, 35, 100, "HIGH", 50)),
    (("c_small", 29, 20, 10, 0, 0, 6), (0, 0, 35, 30, 0, 65, "HIGH", 100)),
    (("d_zero", 60, 50, 40, 0, 0, 20), (0, -3.762676, 35, 30, 35, 100, "HIGH", 50)),
    (("e_few_inv", 40, 10, 4, 2, 0, 2), (0.013820, -2.267605, 0, 0, 25, 25, "LOW", 100)),
    (("f_b15", 200, 150, 100, 50, 1, 15), (0.195081, 2.126109, 10, 0, 0, 10, "LOW", 25)),
    (("g_b30", 200, 150, 100, 14, 1, 30), (0.042152, -4.350855, 20, 10, 35, 65, "HIGH", 50)),
    (("h_noinv", 30, 0, 0, 0, 0, 0), (0, -2.660614, 0, 0, 25, 25, "LOW", 50)),
]


def test_risk_boundary_agents(spark):
    got = scored(spark, *[a for a, _ in BOUNDARY])
    for agent, want in BOUNDARY:
        r = got[agent[0]]
        assert (r.connection_rate_lower_95, r.connection_rate_zscore) == pytest.approx(want[:2], abs=1e-6)
        assert (
            r.ghosting_risk_points, r.acceptance_risk_points, r.connection_anomaly_points, r.risk_score,
            r.risk_level, r.recommended_daily_capacity,
        ) == want[2:]
        assert (r.model_status == "MONITOR_ONLY") == (r.total_leads < 30)


def test_risk_of_the_published_run(spark):
    r = scored(spark, ("only", 468, 430, 350, 116, 1, 203))["only"]
    assert r.connection_rate == pytest.approx(0.2479, abs=5e-5)
    assert r.acceptance_rate == pytest.approx(0.3314, abs=5e-5)
    assert r.ghosting_rate == pytest.approx(0.58, abs=5e-5)
    assert r.connection_rate_lower_95 == pytest.approx(0.2109026, abs=1e-7)
    assert (r.connection_rate_zscore, r.risk_score, r.risk_level, r.recommended_daily_capacity) == (0, 35, "MEDIUM", 23)


def test_no_connections_mean_bound_zero(spark):
    r = scored(spark, ("n44", 44, 44, 0, 0, 0, 0), ("peer", 44, 44, 0, 0, 0, 0))["n44"]
    assert (r.connection_rate_lower_95, r.recommended_daily_capacity, r.risk_level) == (0.0, 50, "LOW")


def test_acceptance_may_exceed_one(spark):
    assert scored(spark, ("x", 100, 0, 10, 20, 0, 0))["x"].acceptance_rate == 2.0


def test_risk_base_counts(spark):
    def lead(i, agent, **more):
        return {"staging_id": f"id{i}", "agent": agent, "added_on": T0, **more}

    as_of = date(2026, 8, 10)
    rows = fct_leads(stg(
        spark,
        lead(1, "Ada", invite_sent_at=T0 + timedelta(days=2, hours=23)),  # 7 days
        lead(2, "Ada", invite_sent_at=T0 + timedelta(days=3)),  # 6 days
        lead(3, "Ada", invite_sent_at=T0, connected_at=T0 + timedelta(days=4)),
        lead(4, "Ada", sdr_status=" Replied\t"),
        lead(5, "  "), lead(6, None),
    ))
    got = {r.agent: r for r in risk.risk_base(rows, as_of).collect()}
    assert set(got) == {"Ada", "  "}
    a = got["Ada"]
    assert (a.total_leads, a.invite_sent_leads, a.ghosted_leads, a.replied_leads) == (4, 3, 1, 1)
    assert a.avg_days_to_connection == 4.0
    with pytest.raises(RuntimeError, match="agent"):
        risk.require_agents(risk.risk_scores(rows.where("agent is null"), as_of))


def test_capacity_overview(spark):
    base = spark.createDataFrame([a for a, _ in BOUNDARY], COUNTS).withColumns(
        {"hot_leads": F.lit(0).cast("long"), "avg_days_to_connection": F.lit(None).cast("double")}
    )
    got = {r.agent: r.capacity_reduction for r in reports.capacity_overview(risk.score_agents(base)).collect()}
    assert got["a_big"] == 82 and got["c_small"] == 0


def quality_rows(spark):
    """468 leads of which 85 have an unknown status: 1319 of 1404 validity checks pass."""
    return fct_leads(stg(spark, *[
        {"staging_id": f"id{i}", "name": "N", "linkedin_url": url(i), "agent": "Ada", "added_on": T0,
         "record_updated_at": T0, "hot_score": float(i % 101), "prioritized": " yes",
         "sdr_status": "enriched" if i < 85 else "Invite Sent "}
        for i in range(468)
    ]))


def test_quality_of_the_published_run(spark):
    r = quality.dq_scores(quality_rows(spark), T0).first()
    assert r.total_rows == 468
    assert (r.completeness_score, r.uniqueness_score, r.timeliness_score, r.referential_integrity_score) == (100, 100, 100, 100)
    assert round(r.validity_score, 3) == 93.946
    assert round(r.composite_dq_score, 3) == 98.486
    assert (r.threshold, r.dq_status) == (95.0, "PASS")


def test_quality_faults_and_gate(spark):
    rows = fct_leads(stg(
        spark,
        {"staging_id": "a", "name": " ", "linkedin_url": url(1), "agent": "\t", "hot_score": 101.0,
         "prioritized": "maybe", "record_updated_at": T0 + timedelta(days=1)},
        {"staging_id": "a", "name": "N", "linkedin_url": url(1), "agent": "Ada", "added_on": T0,
         "record_updated_at": T0, "hot_score": -1.0},
    ))
    r = quality.dq_scores(rows, T0).first()
    assert r.completeness_score == 5 / 8 * 100
    assert r.uniqueness_score == 50.0
    assert r.validity_score == pytest.approx(3 / 6 * 100)
    assert (r.timeliness_score, r.referential_integrity_score, r.dq_status) == (50.0, 50.0, "FAIL")
    with pytest.raises(quality.QualityError, match="score"):
        quality.require_quality(r.dq_status, r.composite_dq_score)
    stricter = quality.dq_scores(rows, T0, threshold=10.0).first()
    assert stricter.dq_status == "PASS"


def test_quality_parts_agree_with_the_single_pass(spark):
    rows = quality_rows(spark)
    whole = quality.dq_scores(rows, T0, stg=rows).first()
    assert quality.dq_completeness(rows).first().completeness_score == whole.completeness_score
    assert quality.dq_uniqueness(rows).first().uniqueness_score == whole.uniqueness_score
    assert quality.dq_validity(rows).first().validity_score == whole.validity_score
    assert quality.dq_timeliness(rows, T0).first().timeliness_score == whole.timeliness_score
    assert quality.dq_referential(rows).first().referential_integrity_score == whole.referential_integrity_score
    assert quality.dq_uniqueness(rows, rsd=0.01).first().uniqueness_score == pytest.approx(100, abs=3)


def test_quality_of_an_empty_table_is_zero(spark):
    r = quality.dq_scores(quality_rows(spark).limit(0), T0).first()
    assert (r.total_rows, r.composite_dq_score, r.dq_status) == (0, 0.0, "FAIL")


def test_history_row(spark):
    moment = datetime(2026, 9, 3, 11, 47, 5, 123456, tzinfo=timezone.utc)
    row = quality.dq_record(quality.dq_scores(quality_rows(spark), T0), moment).first()
    assert row.dq_run_id == "20260903114705123456" and row.dq_status == "PASS"


def test_reports_of_an_empty_fact(spark):
    empty = quality_rows(spark).limit(0)
    r = reports.lead_funnel(empty).first()
    assert (r.total_leads, r.connection_rate) == (0, None)
    assert reports.star_funnel(empty).first().contact_rate is None
    assert reports.agent_performance(empty).isEmpty()
    assert reports.kpi_overview(empty, T0.date()).first().acceptance_rate is None


def test_agent_totals_add_up(spark):
    rows = quality_rows(spark).withColumn("agent", F.expr("if(hot_score < 20, null, agent)"))
    total = reports.agent_performance(rows).agg(F.sum("total_leads")).first()[0]
    assert total == rows.count()
    assert {r.agent for r in reports.agent_performance(rows).collect()} == {"Ada", None}
