"""Watermark, incremental filter and upsert."""

from __future__ import annotations

from datetime import timedelta

import pytest

from leadlake.operators import incremental as inc
from leadlake.schemas import PIPELINE_RUNS
from tests.leads import T0, stg


def lead(n, day, score=1.0):
    moment = T0 + timedelta(days=day)
    return {"staging_id": f"id{n}", "hot_score": score, "added_on": moment, "record_updated_at": moment}


def content(df):
    return {(r.staging_id, r.hot_score) for r in df.collect()}


def run_row(name, status, mark):
    return ("r", name, T0, T0, 1, 1, status, None, mark, None)


def test_watermark_is_the_newest_of_successful_runs(spark):
    late = T0 + timedelta(days=9)
    runs = spark.createDataFrame(
        [
            run_row(inc.PIPELINE, "SUCCESS", T0),
            run_row(inc.PIPELINE, "SUCCESS", None),
            run_row(inc.PIPELINE, "FAILED", late),
            run_row("other", "SUCCESS", late),
        ],
        PIPELINE_RUNS,
    )
    assert inc.moment(inc.current_watermark(runs)) == T0
    assert inc.moment(inc.current_watermark(runs.limit(0))) is None


def test_filter_is_strict_and_skips_undated_rows(spark):
    rows = stg(spark, lead(1, -1), lead(2, 0), lead(3, 1), {"staging_id": "id4"})
    assert content(inc.incremental_rows(rows, T0)) == {("id3", 1.0)}
    assert content(inc.incremental_rows(rows, T0, timedelta(days=1))) == {("id2", 1.0), ("id3", 1.0)}
    assert inc.incremental_rows(rows, None).count() == 4


def test_late_row_is_lost_by_default_and_found_with_overlap(spark):
    known, late = stg(spark, lead(1, 0)), stg(spark, lead(1, 0), lead(2, -3))
    assert len(content(inc.incremental_step(late, known, T0)[0])) == 1
    kept, _ = inc.incremental_step(late, known, T0, overlap=timedelta(days=5))
    assert len(content(kept)) == 2


def test_upsert_new_rows_win(spark):
    known = stg(spark, *[lead(n, 0) for n in range(10)])
    new = stg(spark, lead(3, 1, 5.0), lead(99, 1, 5.0))
    once = inc.upsert(known, new)
    want = {(f"id{n}", 1.0) for n in range(10) if n != 3} | {("id3", 5.0), ("id99", 5.0)}
    assert content(once) == want
    assert content(inc.upsert(once, new)) == want


def test_modes(spark):
    src, known = stg(spark, lead(1, 1, 2.0), lead(2, 2, 2.0)), stg(spark, lead(1, 0), lead(3, 0))
    full, mark = inc.incremental_step(src, known, T0, mode="full")
    assert len(content(full)) == 2 and inc.moment(mark) == T0 + timedelta(days=2)
    first, mark = inc.incremental_step(src, known.limit(0), None)
    assert content(first) == content(src) and inc.moment(mark) == T0 + timedelta(days=2)
    third, mark = inc.incremental_step(src, known, T0)
    assert content(third) == {("id1", 2.0), ("id2", 2.0), ("id3", 1.0)}
    nothing, mark = inc.incremental_step(src, known, T0 + timedelta(days=5))
    assert content(nothing) == content(known) and inc.moment(mark) == T0 + timedelta(days=5)
    with pytest.raises(ValueError, match="mode"):
        inc.incremental_step(src, known, T0, mode="sometimes")


def test_fold_of_increments_equals_full_load(spark):
    rows = [lead(n % 30, n // 10, float(n)) for n in range(90)]
    state, mark = stg(spark).limit(0), None
    for cut in (0, 30, 60):
        batch = stg(spark, *{r["staging_id"]: r for r in rows[cut : cut + 30]}.values())
        state, advanced = inc.incremental_step(batch, state, mark)
        mark = inc.moment(advanced)
    assert content(state) == {(r["staging_id"], r["hot_score"]) for r in rows[60:]}
