"""Scans, staging, deduplication and validation."""

from __future__ import annotations

import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from leadlake.operators import staging, validation, warehouse
from leadlake.operators.dedup import keep_last
from leadlake.schemas import DATE_PATCH, RAW_TO_STAGING, STAGING_COLUMNS
from leadlake.sources.files import read_date_patch, read_leads_csv, read_leads_json
from tests.leads import raw, url

ORDER = ["src_ordinal"]


def checkable(spark, link, lead, added):
    return spark.createDataFrame(
        [(link, lead, added)], "linkedin_url string, staging_id string, added_on timestamp"
    )


@pytest.mark.parametrize(
    ("link", "lead", "added", "reason"),
    [
        ("https://x/in/a", "abc", datetime(2026, 8, 1), None),
        (None, "abc", datetime(2026, 8, 1), "Missing linkedin_url;"),
        (" \t", "abc", datetime(2026, 8, 1), "Missing linkedin_url;"),
        ("https://x/in/a", None, datetime(2026, 8, 1), "Missing staging_id;"),
        ("https://x/in/a", "abc", None, "Missing added_on;"),
        (None, None, datetime(2026, 8, 1), "Missing linkedin_url; Missing staging_id;"),
        (None, None, None, "Missing linkedin_url; Missing staging_id; Missing added_on;"),
    ],
)
def test_validation(spark, link, lead, added, reason):
    good, dead = validation.validate(checkable(spark, link, lead, added))
    assert good.count() == (reason is None)
    assert [r.error_reason for r in dead.collect()] == ([] if reason is None else [reason])


def test_extra_rules_are_reported_in_order(spark):
    rules = [*validation.default_rules(), (F.length("staging_id") != 32, "Odd staging_id; ")]
    _, dead = validation.validate(checkable(spark, None, "abc", None), rules)
    assert dead.first().error_reason == "Missing linkedin_url; Missing added_on; Odd staging_id;"


def test_staging_columns_and_values(spark, run_ts):
    staged = staging.stage_leads(raw(spark, {}), run_ts, ORDER)
    assert staged.columns == STAGING_COLUMNS
    row = staged.withColumn("updated", F.col("record_updated_at").cast("string")).first()
    assert (row.name, row.company, row.hot_score, row.updated) == (
        "Test User", "Test Company", 80.0, "2026-08-03 00:00:00",
    )


def test_equal_rows_become_one(spark, run_ts):
    blank = {"Last Contacted": None, "Invite Sent At": None, "Connected At": None}
    assert staging.stage_leads(raw(spark, blank, blank), run_ts, ORDER).count() == 1


def test_last_row_in_file_order_wins(spark, run_ts):
    rows = [{"Name": f"n{i}", "LinkedIn URL": url(i % 3)} for i in range(30)]
    got = staging.stage_leads(raw(spark, *rows), run_ts, ORDER).collect()
    assert {r.name for r in got} == {"n27", "n28", "n29"}


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_keep_last_does_not_depend_on_partitions(spark, parts):
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(40)]), i, f"p{i}") for i in range(2000)]
    last = {k: p for k, _, p in rows}
    df = spark.createDataFrame(rows, "k int, o int, p string").repartition(parts)
    got = {r.k: r.p for r in keep_last(df, ["k"], ["o"]).collect()}
    assert got == last


def test_rows_without_url_collapse_unless_kept(spark, run_ts):
    rows = [{"LinkedIn URL": None, "Name": f"n{i}"} for i in range(5)] + [{}]
    collapsed = validation.validate(staging.stage_leads(raw(spark, *rows), run_ts, ORDER))[1]
    assert [r.name for r in collapsed.collect()] == ["n4"]
    kept = staging.stage_leads(raw(spark, *rows), run_ts, ORDER, dedup_nulls=False)
    assert validation.validate(kept)[1].count() == 5
    assert kept.count() == 6


def test_scores_and_flags(spark, run_ts):
    scores = ["49.9", "50", "-1", "100", "101", "NaN", None, "n/a?"]
    rows = [{"Hot Score": s, "LinkedIn URL": url(i), "Prioritized": p}
            for i, (s, p) in enumerate(zip(scores, [" yes", "YES", "no", None, "Y", "", "maybe", "Yes\t"], strict=True))]
    fct = warehouse.fct_leads(staging.stage_leads(raw(spark, *rows), run_ts, ORDER))
    got = {r.linkedin_url: (r.is_hot_lead, r.is_prioritized) for r in fct.collect()}
    assert [got[url(i)][0] for i in range(8)] == [0, 1, 0, 1, 1, 0, 0, 0]
    assert [got[url(i)][1] for i in range(8)] == [1, 1, 0, 0, 0, 0, 0, 1]


def test_fact_measures(spark, run_ts):
    rows = [
        {"LinkedIn URL": url(1), "Added On": "2026-08-01 23:59", "Connected At": "2026-08-02 00:01"},
        {"LinkedIn URL": url(2), "Added On": "2026-08-05", "Connected At": "2026-08-01", "SDR Status": None},
        {"LinkedIn URL": url(3), "Connected At": None, "SDR Status": "  "},
    ]
    fct = warehouse.fct_leads(staging.stage_leads(raw(spark, *rows), run_ts, ORDER))
    got = {r.linkedin_url: (r.days_to_connection, r.is_connected, r.lead_status) for r in fct.collect()}
    assert got == {
        url(1): (1, 1, "Connected"), url(2): (-4, 1, "unknown"), url(3): (None, 0, "  "),
    }


def test_dead_letters_carry_run(spark, run_ts):
    staged = staging.stage_leads(raw(spark, {"Added On": "soon"}), run_ts, ORDER)
    row = validation.dead_letters(validation.validate(staged)[1], "run-9", run_ts).first()
    assert (row.dead_letter_run_id, row.error_reason) == ("run-9", "Missing added_on;")


# ---------------------------------------------------------------- files

HEADER = ",".join(RAW_TO_STAGING)


def line(name, link, agent="Ada", score="80", title="Analyst"):
    return f'{name},{title},Co,Ind,Loc,{agent},replied,,{score},Feed,Yes,{link},2026-08-01,,,'


def test_csv_quotes_line_breaks_and_missing_texts(spark, tmp_path, run_ts):
    body = [
        line('"Lee, ""Bo"""', url(1), title='"two\nlines"'),
        line("None", url(2), agent="N/A", score="null"),
        line("  pad ", url(3), score="x"),
    ]
    (tmp_path / "a.csv").write_text("﻿" + "\n".join([HEADER, *body]) + "\n")
    got = {r.linkedin_url: r for r in staging.stage_leads(read_leads_csv(spark, str(tmp_path)), run_ts).collect()}
    assert (got[url(1)].name, got[url(1)].job_title) == ('Lee, "Bo"', "two\nlines")
    assert (got[url(2)].name, got[url(2)].agent, got[url(2)].hot_score) == (None, None, None)
    assert (got[url(3)].name, got[url(3)].hot_score, got[url(3)].comment_status) == ("  pad ", None, None)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    names = list(reversed(RAW_TO_STAGING))
    (tmp_path / "a.csv").write_text(",".join(names) + ",Extra\n" + ",".join(n.lower() for n in names) + ",x\n")
    row = read_leads_csv(spark, str(tmp_path)).first()
    assert row["Agent"] == "agent" and row["Name"] == "name"


def test_csv_without_a_column_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Name,Agent\na,b\n")
    with pytest.raises(ValueError, match="LinkedIn URL"):
        read_leads_csv(spark, str(tmp_path))


def test_csv_order_survives_splits(spark, tmp_path, run_ts):
    lines = [line(f"n{i}", url(i % 50)) for i in range(4000)]
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = read_leads_csv(spark, str(tmp_path), multi_line=False)
        assert scan.select("src_block").distinct().count() > 5
        got = {r.name for r in staging.stage_leads(scan, run_ts).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"n{i}" for i in range(3950, 4000)}


def test_json_feed_after_a_moment(spark, tmp_path):
    cells = [{"Name": n, "Added On": d, "Connected At": c} for n, d, c in (
        ("old", "2026-08-01", None), ("edge", "8/2/2026", None), ("new", "2026-08-01", "2026-08-02T00:00:01Z"), ("none", None, None))]
    import json

    (tmp_path / "p1.json").write_text("\n".join(json.dumps(c) for c in cells))
    after = datetime(2026, 8, 2, tzinfo=timezone.utc)
    assert [r.Name for r in read_leads_json(spark, str(tmp_path), after).collect()] == ["new"]
    assert read_leads_json(spark, str(tmp_path)).count() == 4
    (tmp_path / "p1.json").write_text(json.dumps(cells))
    assert read_leads_json(spark, str(tmp_path), after, multi_line=True).count() == 1


def test_date_patch(spark, tmp_path):
    (tmp_path / "d.csv").write_text(
        "date_key,full_date,year,month,month_name,quarter\n20260820,2026-08-20,2026,8,August,3\n"
    )
    patch = read_date_patch(spark, str(tmp_path))
    assert patch.schema.names == DATE_PATCH.names
    assert patch.first().date_key == 20260820


def test_malformed_records_are_kept_one_by_one(spark, tmp_path):
    from leadlake.plans.daily_run import Settings, run_load
    from leadlake.sources.files import malformed_records
    from leadlake.sources.store import Store
    from leadlake.streaming.ingest import stream_leads

    good = {"LinkedIn URL": "https://x/1", "Name": "a", "Agent": "b", "Added On": "2026-08-01", "Comment Status": "NA"}
    (tmp_path / "in").mkdir()
    lines = [json.dumps(good), '{"Name": "cut', "nonsense", '{"Name": "cut']
    (tmp_path / "in" / "page.json").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "in")
    texts = sorted(r.raw_record for r in malformed_records(spark, path, "json").collect())
    assert texts == sorted(lines[1:])
    batch = read_leads_json(spark, path)
    assert [r["Comment Status"] for r in batch.collect()] == [None]
    now = datetime(2026, 9, 1, tzinfo=timezone.utc)
    one, two = (Store(spark, str(tmp_path / name), buckets=2) for name in ("batch", "stream"))
    out = run_load(one, batch, "r1", now, Settings(), malformed_records(spark, path, "json"))
    assert (out.rows_read, out.rows_loaded, out.dead_letters) == (4, 1, 3)
    stream_leads(spark, path, two, fmt="json", run_ts=now).awaitTermination()
    for store in (one, two):
        assert sorted(r.raw_record for r in store.ledger("malformed_records").collect()) == sorted(lines[1:])
    assert one.read("stg_leads").collect() == two.read("stg_leads").collect()

    header = ",".join(RAW_TO_STAGING)
    (tmp_path / "x.csv").write_text(f"{header}\n" + ",".join("v" for _ in RAW_TO_STAGING) + "\na,b\n" + "c," * 20 + "\n")
    assert [r.raw_record for r in malformed_records(spark, str(tmp_path / "x.csv")).collect()] == ["a,b", "c," * 20]
    assert read_leads_csv(spark, str(tmp_path / "x.csv")).count() == 1


def test_a_load_keeps_the_malformed_records_of_its_reader(spark, tmp_path):
    from leadlake.plans.daily_run import Settings, run_load
    from leadlake.sources.store import Store

    good = {"LinkedIn URL": "https://x/1", "Name": "a", "Agent": "b", "Added On": "2026-08-01"}
    (tmp_path / "page.json").write_text(json.dumps(good) + '\n{"Name": "cut\n')
    cells = ",".join(good.get(h, "") for h in RAW_TO_STAGING)
    (tmp_path / "x.csv").write_text(",".join(RAW_TO_STAGING) + f"\n{cells}\na,b\n")
    now = datetime(2026, 9, 1, tzinfo=timezone.utc)
    frames = {
        "csv": read_leads_csv(spark, str(tmp_path / "x.csv")),
        "json": read_leads_json(spark, str(tmp_path / "page.json")),
        "late": read_leads_json(spark, str(tmp_path / "page.json"), datetime(2026, 1, 1)),
    }
    for name, frame in frames.items():
        store = Store(spark, str(tmp_path / name), buckets=2)
        out = run_load(store, frame, "r1", now, Settings())
        assert (out.rows_read, out.rows_loaded, out.dead_letters) == (2, 1, 1)
        kept = [r.raw_record for r in store.ledger("malformed_records").collect()]
        assert kept == (["a,b"] if name == "csv" else ['{"Name": "cut'])
    with pytest.raises(ValueError, match="malformed"):
        run_load(store, frames["csv"].where("true"), "r2", now, Settings())


def test_staging_carries_the_order_of_the_source_once(spark):
    """The order columns, such as the file's name, are compared but not carried as values beside that."""
    raw_ = spark.range(3).selectExpr("id AS src_ordinal", "'file' AS src_file", *[f"'x' AS `{h}`" for h in RAW_TO_STAGING])
    staged = staging.stage_leads(raw_, datetime(2026, 8, 1, tzinfo=timezone.utc), ["src_file", "src_ordinal"], copies="n")
    assert staged.first().n == 3 and not {"src_file", "src_ordinal"} & set(staged.columns)
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    carried = plan[plan.index("max_by(") :].split("struct(src_file")[0]
    assert "src_file" not in carried
