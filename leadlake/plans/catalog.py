"""Named queries over the test tables: every operator on leads derived from whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions import text
from leadlake.operators import (
    checks,
    dims,
    history,
    incremental,
    maintained,
    quality,
    reports,
    risk,
    staging,
    star,
    validation,
    warehouse,
)
from leadlake.operators.dedup import keep_last
from leadlake.plans.daily_run import Settings, register_views, run_load
from leadlake.schemas import DATE_COLUMNS, DATE_PATCH, DIM_LEAD_STATUS, RAW_TO_STAGING, SOURCE_ORDER
from leadlake.session import prepare, work_dir, write_work
from leadlake.sources.files import malformed_records, read_date_patch, read_leads_csv, read_leads_json
from leadlake.sources.store import Store
from leadlake.sources.testleads import raw_leads
from leadlake.streaming.ingest import stream_leads

RUN_TS = datetime(2002, 1, 1, tzinfo=timezone.utc)
AS_OF = date(2000, 1, 1)
AS_OF_TS = datetime(2000, 1, 1, tzinfo=timezone.utc)
#: Leads arrive in three batches, cut by their newest date.
BATCH_CUTS = (datetime(1997, 1, 1, tzinfo=timezone.utc), datetime(1999, 1, 1, tzinfo=timezone.utc))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: plain timestamps, days as text, booleans as 0 or 1."""
    cast = {
        "timestamp": lambda c: c.cast("timestamp_ntz"),
        "date": lambda c: c.cast("string"),
        "boolean": lambda c: c.cast("int"),
    }
    return df.select(
        *[cast.get(t, lambda c: c)(F.col(f"`{n}`")).alias(n) for n, t in df.dtypes]
    )


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _portable(fn(prepare(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


# ---------------------------------------------------------------- inputs of the queries


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_leads(raw_leads(spark, sf), RUN_TS, order=["src_ordinal"])


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return validation.validate(staged(spark, sf))[0]


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.fct_leads(valid(spark, sf))


def written_fact(spark: SparkSession, sf: str) -> DataFrame:
    """All fact rows, written once: dimensions and star both read them."""
    return write_work(fact(spark, sf))


def star_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, dims.Dims]:
    rows = written_fact(spark, sf)
    built = dims.build_dims(rows, RUN_TS)
    return star.star_fact(rows, built), built


def batch_of(updated: Column | str = "record_updated_at"):
    """1, 2 or 3: the batch a lead arrives in."""
    first, second = (F.lit(c) for c in BATCH_CUTS)
    date_ = F.col(updated) if isinstance(updated, str) else updated
    return F.when(date_ < first, 1).when(date_ < second, 2).otherwise(3)


def batches(df: DataFrame, *numbers: int) -> DataFrame:
    return df.where(batch_of().isin(*numbers))


def run_ledger(leads: DataFrame) -> DataFrame:
    """Ledger of three runs, one per batch, derived from the leads; the third one failed.

    A run lasts a second per row it loaded and leaves the newest date of its batch as watermark.
    """
    per_batch = leads.groupBy(batch_of().alias("batch")).agg(
        F.count(F.lit(1)).alias("rows_read"), F.max("record_updated_at").alias("watermark_end")
    )
    third = F.col("batch") == 3
    start = F.lit(RUN_TS).cast("timestamp")
    return per_batch.select(
        F.concat(F.lit("run-"), F.col("batch").cast("string")).alias("run_id"),
        F.lit(incremental.PIPELINE).alias("pipeline_name"),
        start.alias("started_at"),
        F.timestamp_add("SECOND", F.col("rows_read"), start).alias("completed_at"),
        "rows_read",
        F.when(third, 0).otherwise(F.col("rows_read")).alias("rows_loaded"),
        F.when(third, "FAILED").otherwise("SUCCESS").alias("status"),
        F.lit(None).cast("timestamp").alias("watermark_start"),
        "watermark_end",
        F.when(third, "load failed").alias("error_message"),
    )


def resent(first: DataFrame) -> DataFrame:
    """Leads of the first batch that come in again: contacted in the meantime and scored higher."""
    contacted = F.lit(datetime(2001, 12, 1, tzinfo=timezone.utc)).cast("timestamp")
    return (
        first.where("sdr_status = 'captured'")
        .withColumns({"last_contacted": contacted, "hot_score": F.col("hot_score") + 1})
        .withColumn("record_updated_at", F.greatest(*DATE_COLUMNS))
    )


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def as_export(raw: DataFrame) -> DataFrame:
    """Raw leads as text cells, in source order within and across the partitions."""
    cells = [
        (F.date_format(f"`{h}`", "yyyy-MM-dd HH:mm:ss") if c in DATE_COLUMNS else F.col(f"`{h}`").cast("string")).alias(h)
        for h, c in RAW_TO_STAGING.items()
    ]
    return raw.repartitionByRange("src_ordinal").sortWithinPartitions("src_ordinal").select(*cells)


#: Exports that one job writes all at once are ordered by file name, not by time.
EXPORT_ORDER = ["src_file", "src_block", "src_row"]


# ---------------------------------------------------------------- sources


@query
def csv_scan(spark, sf):
    path = _scratch(spark, "csv")
    keep_blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    as_export(raw_leads(spark, sf)).write.options(header="true", escape='"', **keep_blanks).csv(path)
    return staging.stage_leads(read_leads_csv(spark, path), RUN_TS, order=EXPORT_ORDER)


def _mixed_exports(spark: SparkSession, raw: DataFrame) -> str:
    """Path of exports of three kinds: columns in source order, in reverse, and with one more column in between."""
    path, cells = _scratch(spark, "mixed"), list(RAW_TO_STAGING)
    headers = {0: cells, 1: cells[::-1], 2: [*cells[:5], "Remark", *cells[5:]]}
    keep_blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    for part, columns in headers.items():
        some = as_export(raw.where(F.pmod("src_ordinal", F.lit(3)) == part))
        some = some.withColumn("Remark", F.concat(F.lit('said "no",\n'), F.col("Name"))).select(*columns)
        some.write.mode("append").options(header="true", escape='"', **keep_blanks).csv(path)
    return path


@query
def csv_mixed_headers(spark, sf):
    """Exports of different headers, some with line breaks in cells, read as one."""
    path = _mixed_exports(spark, raw_leads(spark, sf))
    return read_leads_csv(spark, path).drop(*SOURCE_ORDER).withColumnsRenamed(RAW_TO_STAGING)


@query
def stream_mixed_headers(spark, sf):
    """The same exports, loaded as they land."""
    path = _mixed_exports(spark, write_work(_sound_raw(spark, sf).where(F.col("src_ordinal") % 50 > 1)))
    store = _store(spark)
    stream_leads(spark, path, store, run_ts=RUN_TS, settings=Settings(use_watermark=False, as_of=AS_OF_TS)).awaitTermination()
    store.refresh()
    return store.read("stg_leads")


def _broken_feed(spark: SparkSession, raw: DataFrame) -> str:
    """Path of feed pages of which one line in 211 breaks off."""
    path = _scratch(spark, "broken")
    line = F.to_json(F.struct(*as_export(raw).columns))
    keyed = raw.select("src_ordinal", *[F.col(f"`{h}`").cast("string").alias(h) for h in RAW_TO_STAGING])
    broken = F.when(F.col("src_ordinal") % 211 == 0, F.concat(F.lit('{"Name": '), F.col("src_ordinal"))).otherwise(line)
    keyed.select(broken.alias("value")).write.text(path)
    return path


@query
def dead_letters_malformed(spark, sf):
    """Feed lines that break off are set aside one by one, the others are staged."""
    path = _broken_feed(spark, raw_leads(spark, sf))
    set_aside = malformed_records(spark, path, "json")
    staged_ = read_leads_json(spark, path).agg(F.count(F.lit(1)).alias("leads_read")).scalar()
    return set_aside.select("raw_record", "error_reason", staged_.alias("leads_read"))


@query
def json_updated_after(spark, sf):
    path = _scratch(spark, "json")
    as_export(raw_leads(spark, sf)).write.json(path)
    page = read_leads_json(spark, path, updated_after=BATCH_CUTS[1])
    return staging.stage_leads(page, RUN_TS, order=EXPORT_ORDER)


# ---------------------------------------------------------------- staging


@query
def lead_id(spark, sf):
    raw = raw_leads(spark, sf)
    return raw.select("src_ordinal", text.lead_id("`LinkedIn URL`").alias("staging_id"))


@query
def stg_leads(spark, sf):
    return staged(spark, sf)


@query
def dedup_keep_last(spark, sf):
    leads = staging.identify(raw_leads(spark, sf))
    return keep_last(leads, ["staging_id"], ["src_ordinal"]).select("staging_id", "src_ordinal")


@query
def fct_leads(spark, sf):
    return fact(spark, sf)


@query
def lead_lookup(spark, sf):
    return warehouse.lookup(staged(spark, sf), warehouse.STAGING_LOOKUP, name="Customer#000000042")


@query
def fact_lookup(spark, sf):
    return warehouse.lookup(fact(spark, sf), warehouse.FACT_LOOKUP, name="Customer#000000042")


# ---------------------------------------------------------------- validation


@query
def validation_reasons(spark, sf):
    checked = validation.with_reasons(staged(spark, sf))
    return checked.groupBy("error_reason").agg(F.count(F.lit(1)).alias("records"))


@query
def valid_leads(spark, sf):
    return valid(spark, sf)


@query
def dead_letters(spark, sf):
    return validation.dead_letters(validation.validate(staged(spark, sf))[1], "run-1", RUN_TS)


@query
def dead_letters_every_row(spark, sf):
    raw = raw_leads(spark, sf)
    every = staging.stage_leads(raw, RUN_TS, order=["src_ordinal"], dedup_nulls=False)
    return validation.dead_letters(validation.validate(every)[1], "run-1", RUN_TS)


# ---------------------------------------------------------------- incremental load


@query
def run_records(spark, sf):
    return run_ledger(valid(spark, sf))


@query
def current_watermark(spark, sf):
    return incremental.current_watermark(run_ledger(valid(spark, sf)))


@query
def incremental_rows(spark, sf):
    return incremental.incremental_rows(valid(spark, sf), BATCH_CUTS[0])


@query
def incremental_overlap(spark, sf):
    return incremental.incremental_rows(valid(spark, sf), BATCH_CUTS[1], overlap=timedelta(days=30))


@query
def upsert_leads(spark, sf):
    leads = write_work(valid(spark, sf))
    again = resent(batches(leads, 1))
    return incremental.upsert(batches(leads, 1, 2), batches(leads, 3).unionByName(again))


@query
def incremental_staging(spark, sf):
    leads = write_work(valid(spark, sf))
    first = batches(leads, 1)
    source = leads.unionByName(resent(first)).where("record_updated_at is not null")
    source = keep_last(source, ["staging_id"], ["record_updated_at", "hot_score"])
    mark = incremental.moment(incremental.newest(first))
    return incremental.incremental_step(source, first, mark)[0]


def _sound_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw leads with an agent, as the key gate of a load demands; some lack a URL or a date of adding."""
    return raw_leads(spark, sf).where(~text.is_blank("Agent"))


def _loaded_in_batches(spark: SparkSession, sf: str) -> Store:
    """Published warehouse after three loads, each with the source as it stood after one more batch."""
    store = Store(spark, _scratch(spark, "store"), buckets=8)
    raw = write_work(
        _sound_raw(spark, sf).withColumnsRenamed({h: c for h, c in RAW_TO_STAGING.items()})
    )
    arrival = raw.withColumn("record_updated_at", F.greatest(*DATE_COLUMNS))
    settings = Settings(order=("src_ordinal",), as_of=AS_OF_TS)
    for n in (1, 2, 3):
        so_far = batches(arrival, *range(1, n + 1)).drop("record_updated_at")
        run_load(store, so_far, f"load-{n}", RUN_TS + timedelta(days=n - 1), settings)
    return store


@query
def load_in_batches(spark, sf):
    stg = _loaded_in_batches(spark, sf).read("stg_leads")
    return stg.drop("load_timestamp")


@query
def load_then_risk(spark, sf):
    return _loaded_in_batches(spark, sf).read("analytics_risk_scores")


@query
def stream_staging(spark, sf):
    path = _scratch(spark, "landing")
    as_export(_sound_raw(spark, sf)).write.json(path)
    store = Store(spark, _scratch(spark, "store"), buckets=8)
    settings = Settings(order=tuple(EXPORT_ORDER), use_watermark=False)
    stream_leads(spark, path, store, fmt="json", settings=settings, run_ts=RUN_TS).awaitTermination()
    return store.read("stg_leads")


def _newer_and_older(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Raw leads of the later batches, and those of the first one, which are older."""
    raw = _sound_raw(spark, sf).withColumnsRenamed({h: c for h, c in RAW_TO_STAGING.items()})
    dated = write_work(raw.withColumn("_batch", batch_of(F.greatest(*DATE_COLUMNS))))
    first = F.col("_batch") == 1
    return dated.where(~first).drop("_batch"), dated.where(first).drop("_batch")


@query
def load_two_pipelines(spark, sf):
    """The second pipeline brings older leads; none may be lost."""
    store = Store(spark, _scratch(spark, "store"), buckets=8)
    for name, raw in zip(("one", "two"), _newer_and_older(spark, sf), strict=True):
        run_load(store, raw, name, RUN_TS, Settings(order=("src_ordinal",), as_of=AS_OF_TS, pipeline=name))
    return store.read("stg_leads")


@query
def load_broken_export(spark, sf):
    """What a load of feed pages with broken lines has kept of them, and all it says it has read."""
    path = _broken_feed(spark, _sound_raw(spark, sf))
    store = Store(spark, _scratch(spark, "store"), buckets=8)
    run_load(store, read_leads_json(spark, path), "broken", RUN_TS, Settings(order=tuple(EXPORT_ORDER), as_of=AS_OF_TS))
    read = store.ledger("pipeline_runs").agg(F.sum("rows_read").alias("rows_read")).scalar()
    return store.ledger("malformed_records").select("raw_record", "error_reason", read.alias("rows_read"))


def _edited(raw: DataFrame) -> DataFrame:
    """The source a day later: one lead in seven has replied and is scored higher, and no date has moved."""
    hit = F.col("src_ordinal") % 7 == 0
    return raw.withColumns(
        {
            "SDR Status": F.when(hit, "replied").otherwise(F.col("SDR Status")),
            "Hot Score": F.when(hit, F.col("Hot Score") + 1).otherwise(F.col("Hot Score")),
        }
    )


def _store(spark: SparkSession, buckets: int = 8) -> Store:
    return Store(spark, _scratch(spark, "store"), buckets=buckets)


_BY_ORDINAL = Settings(order=("src_ordinal",), as_of=AS_OF_TS)
_NEXT_DAY = RUN_TS + timedelta(days=1)


@query
def load_edited_leads(spark, sf):
    """Edits that move no date, found by content; unchanged leads keep the time they were loaded at."""
    store, raw = _store(spark), write_work(_sound_raw(spark, sf).withColumnsRenamed(RAW_TO_STAGING))
    raw = raw.withColumnsRenamed({c: h for h, c in RAW_TO_STAGING.items()})
    run_load(store, raw, "one", RUN_TS, _BY_ORDINAL)
    run_load(store, _edited(raw), "two", _NEXT_DAY, replace(_BY_ORDINAL, detect="content"))
    return store.read("stg_leads")


def _arrived(spark: SparkSession, sf: str, raw: DataFrame) -> DataFrame:
    """Raw leads, written, with the batch they arrive in; columns are named as in staging, which the load takes too."""
    dated = raw.withColumnsRenamed(RAW_TO_STAGING)
    return write_work(dated.withColumn("_batch", batch_of(F.greatest(*DATE_COLUMNS))))


@query
def load_future_date(spark, sf):
    """Some dates of the first load are typed wrongly, decades ahead; no lead of the second load may be lost."""
    store, arrived = _store(spark), _arrived(spark, sf, _sound_raw(spark, sf))
    typo = F.lit(datetime(2062, 8, 1)).cast("timestamp_ntz").cast(arrived.schema["last_contacted"].dataType)
    wrong = F.when(F.col("src_ordinal") % 211 == 5, typo).otherwise(F.col("last_contacted"))
    first = arrived.where("_batch = 1").drop("_batch").withColumn("last_contacted", wrong)
    run_load(store, first, "one", RUN_TS, _BY_ORDINAL)
    run_load(store, arrived.drop("_batch"), "two", _NEXT_DAY, _BY_ORDINAL)
    late = store.ledger("dead_letter_leads").where("error_reason LIKE '%Date in the future;'")
    return store.read("stg_leads").withColumn("set_aside", late.agg(F.count(F.lit(1))).scalar())


@query
def load_failed_gate(spark, sf):
    """The ledger after a good load and one that fails on leads without an agent; the good one stays."""
    store, arrived = _store(spark), _arrived(spark, sf, raw_leads(spark, sf))
    sound = arrived.where(~text.is_blank("agent") & (F.col("_batch") == 1))
    run_load(store, sound.drop("_batch"), "good", RUN_TS, _BY_ORDINAL)
    try:
        run_load(store, arrived.drop("_batch"), "bad", _NEXT_DAY, _BY_ORDINAL)
    except star.ReferentialError:
        pass
    kept = store.read("stg_leads").agg(F.count(F.lit(1))).scalar().alias("staging_rows")
    return store.ledger("pipeline_runs").select("run_id", "status", "rows_read", "rows_loaded", kept)


@query
def load_repeated(spark, sf):
    """One load, its retry under the same id, and the same source again: nothing is doubled."""
    store, raw = _store(spark), _sound_raw(spark, sf)
    outcomes = [run_load(store, raw, name, RUN_TS, _BY_ORDINAL) for name in ("one", "one", "two")]
    again = F.lit(",".join(o.status for o in outcomes)).alias("outcomes")
    kept = store.read("stg_leads").agg(F.count(F.lit(1))).scalar().alias("staging_rows")
    return store.ledger("pipeline_runs").select("run_id", "status", "rows_read", "rows_loaded", kept, again)


@query
def load_empty(spark, sf):
    """A full load whose rows are all invalid leaves staging as it is."""
    store, arrived = _store(spark), _arrived(spark, sf, _sound_raw(spark, sf))
    run_load(store, arrived.where("_batch < 3").drop("_batch"), "one", RUN_TS, _BY_ORDINAL)
    undated = arrived.drop("_batch").withColumn("added_on", F.lit(None).cast(arrived.schema["added_on"].dataType))
    run_load(store, undated, "two", _NEXT_DAY, replace(_BY_ORDINAL, mode="full"))
    return store.read("stg_leads")


@query
def load_then_reports(spark, sf):
    """Reports from the sums that three loads have maintained, one row a group."""
    sums = _loaded_in_batches(spark, sf).read("lead_sums")
    counts = ("total_leads", "contacted_leads", "invite_sent_leads", "connected_leads", "hot_leads")

    def rows(report: DataFrame, name: str, key: Column | str, columns: tuple = counts) -> DataFrame:
        key = F.col(key) if isinstance(key, str) else key
        return report.select(F.lit(name).alias("report"), key.cast("string").alias("key"), *[
            F.col(c).alias(n) for c, n in zip(columns, counts, strict=True)
        ])

    status = ("lead_count", "contacted_count", None, "connected_count", "hot_lead_count")
    by_status = maintained.lead_status(sums).withColumn("none", F.lit(None).cast("long"))
    parts = [
        rows(maintained.lead_funnel(sums), "funnel", F.lit(None)),
        rows(maintained.agent_performance(sums), "agent", "agent"),
        rows(by_status, "status", "lead_status", tuple(c or "none" for c in status)),
    ]
    for segment in ("source", "industry"):
        found = maintained.segment_performance(sums, segment)
        renamed = found.withColumnRenamed("invites_sent", "invite_sent_leads").withColumns(
            {c: F.lit(None).cast("long") for c in ("contacted_leads", "hot_leads")}
        )
        parts.append(rows(renamed, segment, segment))
    return reduce(DataFrame.unionByName, parts)


@query
def load_then_daily_trend(spark, sf):
    store = _loaded_in_batches(spark, sf)
    return maintained.star_daily_trend(store.read("lead_sums"), store.dims())


@query
def load_then_quality(spark, sf):
    """The quality rows that three loads have left, from maintained sums."""
    return _loaded_in_batches(spark, sf).ledger("dq_results")


@query
def published_views(spark, sf):
    """Reports by SQL, from the views that a load's tables are published under."""
    store = _store(spark)
    run_load(store, _sound_raw(spark, sf), "one", RUN_TS, _BY_ORDINAL)
    register_views(store)
    return spark.sql(
        """SELECT agent_name, s.total_leads, s.connection_rate, f.total_leads AS all_leads
           FROM analytics_star_agent_performance s CROSS JOIN analytics_lead_funnel f"""
    )


@query
def required_tables(spark, sf):
    """Which tables are there: one created empty, one loaded and loaded again, one never written."""
    store, dim = _store(spark), dims.dim_agent(fact(spark, sf), RUN_TS)
    for _ in range(2):
        store.ensure("dim_lead_status")
        store.replace("dim_agent", dim, "agents")
    store.replace("dim_agent", dim.limit(0), "nothing")
    names = ["dim_agent", "dim_lead_status", "dim_date"]
    present = store.required_tables(names)
    sizes = reduce(
        DataFrame.unionByName,
        [store.read(n).agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(n)) for n in names],
    )
    return present.join(sizes, "table")


@query
def load_stream_then_batch(spark, sf):
    """A stream brings the newer leads, then a daily load the older ones; none may be lost."""
    path = _scratch(spark, "landing")
    newer, older = _newer_and_older(spark, sf)
    headers = {c: h for h, c in RAW_TO_STAGING.items()}
    as_export(newer.withColumnsRenamed(headers)).write.json(path)
    store = Store(spark, _scratch(spark, "store"), buckets=8)
    settings = Settings(order=tuple(EXPORT_ORDER), use_watermark=False, as_of=AS_OF_TS)
    stream_leads(spark, path, store, fmt="json", settings=settings, run_ts=RUN_TS).awaitTermination()
    run_load(store, older, "daily", RUN_TS, Settings(order=("src_ordinal",), as_of=AS_OF_TS))
    return store.read("stg_leads")


@query
def watermark_advance(spark, sf):
    leads = write_work(valid(spark, sf))
    known = batches(leads, 1, 2)
    mark = incremental.moment(incremental.newest(known))
    rows, advanced = incremental.incremental_step(leads, known, mark)
    return advanced.select(
        F.lit(mark).cast("timestamp").alias("watermark_start"),
        F.col("watermark").alias("watermark_end"),
        rows.agg(F.count(F.lit(1)).alias("n")).scalar().alias("staging_rows"),
    )


@query
def full_refresh(spark, sf):
    leads = write_work(valid(spark, sf))
    gone = leads.withColumn("staging_id", F.reverse("staging_id"))  # leads that the source no longer holds
    stale = leads.withColumn("hot_score", F.lit(-1.0)).unionByName(gone)
    return incremental.incremental_step(leads, stale, BATCH_CUTS[0], mode="full")[0]


# ---------------------------------------------------------------- dimensions


@query
def dim_agent(spark, sf):
    return dims.dim_agent(fact(spark, sf), RUN_TS)


@query
def dim_agent_incremental(spark, sf):
    rows = write_work(fact(spark, sf).select("agent", "location"))
    known = dims.dim_agent(rows.where("location = 'ASIA'"), RUN_TS)
    return dims.dim_agent(rows, RUN_TS + timedelta(days=1), existing=known)


@query
def dim_lead_status(spark, sf):
    return dims.dim_lead_status(fact(spark, sf))


@query
def dim_status_incremental(spark, sf):
    known = [(1, "captured"), (2, "connected"), (5, "invite sent")]
    return dims.dim_status_incremental(
        spark.createDataFrame(known, DIM_LEAD_STATUS), fact(spark, sf)
    )


@query
def dim_date_observed(spark, sf):
    return dims.dim_date_observed(fact(spark, sf))


@query
def dim_date_calendar(spark, sf):
    return dims.dim_date_calendar(valid(spark, sf))


@query
def dim_date_gap_fill(spark, sf):
    leads = write_work(valid(spark, sf).select("record_updated_at", "added_on"))
    span = dims.day_range(F.col("record_updated_at"), F.col("record_updated_at"), leads)
    holed = dims.dim_date_calendar(leads).where("day_of_month <> 24")
    return dims.fill_date_gaps(holed, dims.days_between(span))


@query
def date_patch(spark, sf):
    """A calendar without its 24ths, filled from a patch file that holds them."""
    calendar = write_work(dims.dim_date_calendar(valid(spark, sf)))
    path = _scratch(spark, "patch")
    missing = calendar.where("day_of_month = 24").select(*DATE_PATCH.names)
    missing.write.option("header", "true").csv(path)
    return dims.fill_date_gaps(calendar.where("day_of_month <> 24"), read_date_patch(spark, path))


@query
def dim_date_range(spark, sf):
    return dims.dim_date_range(dims.dim_date_calendar(valid(spark, sf), first="added_on"))


def _agent_profile(rows: DataFrame) -> DataFrame:
    share = F.sum("is_connected") * 100 >= F.count(F.lit(1)) * 28
    named = rows.where(~text.is_blank("agent"))
    return named.groupBy(F.trim("agent").alias("agent_name")).agg(
        F.when(share, "strong").otherwise("weak").alias("profile")
    )


@query
def dim_agent_scd2(spark, sf):
    rows = written_fact(spark, sf)
    first = _agent_profile(batches(rows, 1))
    dim = dims.dim_agent(batches(rows, 1), RUN_TS).join(first, "agent_name")
    return dims.scd2_apply(
        dim,
        _agent_profile(rows),
        key="agent_key",
        natural="agent_name",
        tracked=["profile"],
        run_ts=RUN_TS + timedelta(days=1),
    )


def _quarterly_profiles(rows: DataFrame) -> DataFrame:
    """What is seen of each agent, quarter by quarter."""
    share = F.sum("is_connected") * 100 >= F.count(F.lit(1)) * 28
    named = rows.where(~text.is_blank("agent"))
    by_quarter = named.groupBy(F.trim("agent").alias("agent_name"), F.date_trunc("quarter", "added_on").alias("seen_at"))
    return by_quarter.agg(F.when(share, "strong").otherwise("weak").alias("profile"))


def _agent_history(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(fact rows, agent versions): the quarters arrive in three parts, mixed in time."""
    rows = written_fact(spark, sf)
    seen = write_work(_quarterly_profiles(rows))
    of = {"natural": "agent_name", "at": "seen_at", "tracked": ["profile"]}
    dim = spark.createDataFrame([], AGENT_VERSIONS)
    known = seen.limit(0)
    for n in (1, 2, 0):
        part = seen.where(F.pmod(F.quarter("seen_at") * 5 + F.year("seen_at"), F.lit(3)) == n)
        dim, known = history.merge_history(dim, known, part, "agent_key", **of)
        dim = write_work(dim)
    return rows, dim


#: Versions of agents with a profile.
AGENT_VERSIONS = "agent_key long, agent_name string, valid_from timestamp, valid_to timestamp, is_current boolean, profile string"


@query
def dim_agent_late_changes(spark, sf):
    """Agent versions from changes that come late; keys follow the order of arrival and are left out."""
    return _agent_history(spark, sf)[1].drop("agent_key")


@query
def star_fact_as_of(spark, sf):
    """Each lead with the version of its agent that was valid when it was added."""
    rows, dim = _agent_history(spark, sf)
    facts = rows.select("staging_id", F.trim("agent").alias("agent_name"), "added_on")
    versions = dim.withColumn("version_from", F.col("valid_from"))
    joined = history.as_of_join(facts, versions, "agent_name", "added_on", "valid_from", ["version_from", "profile"])
    return joined.withColumnRenamed("agent_name", "agent")


@query
def scd_retype(spark, sf):
    dim = dims.dim_agent(fact(spark, sf), RUN_TS)
    as_text = dim.select(
        F.col("agent_key").cast("string").alias("agent_key"),
        "agent_name",
        F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss").alias("valid_from"),
        F.when(F.col("agent_name") < "NATION_15", "  ")
        .when(F.col("agent_name") < "NATION_2", "2003-05-06 07:08:09")
        .otherwise("not a date")
        .alias("valid_to"),
        F.col("is_current").cast("string").alias("is_current"),
    )
    return dims.retype_scd(as_text)


# ---------------------------------------------------------------- star schema


@query
def star_fact(spark, sf):
    return star_inputs(spark, sf)[0]


@query
def star_missing_keys(spark, sf):
    rows = write_work(fact(spark, sf))
    return star.missing_keys(star.star_fact(rows, dims.build_dims(rows, RUN_TS)))


@query
def fact_leads(spark, sf):
    return star.fact_leads(star_inputs(spark, sf)[0])


@query
def vw_leads_analytics(spark, sf):
    rows, built = star_inputs(spark, sf)
    return star.vw_leads_analytics(star.fact_leads(rows), built)


def _stale_dates(built: dims.Dims) -> DataFrame:
    """The calendar as it stood after the first batch."""
    return built.date.where(F.col("full_date") < F.lit(BATCH_CUTS[0].date()))


@query
def orphans_nonnull(spark, sf):
    rows, built = star_inputs(spark, sf)
    return star.orphans(rows, _stale_dates(built), "date_key")


@query
def orphans_all(spark, sf):
    rows = write_work(fact(spark, sf))
    built = dims.build_dims(rows, RUN_TS)
    return star.orphans(star.star_fact(rows, built), built.agent, "agent_key", count_null=True)


@query
def status_unmatched(spark, sf):
    known = [(1, "captured"), (2, "connected"), (5, "invite sent")]
    return star.status_unmatched(fact(spark, sf), spark.createDataFrame(known, DIM_LEAD_STATUS))


# ---------------------------------------------------------------- reports


@query
def lead_funnel(spark, sf):
    return reports.lead_funnel(fact(spark, sf))


@query
def lead_funnel_prioritized(spark, sf):
    return reports.lead_funnel_prioritized(fact(spark, sf))


@query
def lead_status(spark, sf):
    return reports.lead_status(fact(spark, sf))


@query
def lead_status_counts(spark, sf):
    return reports.lead_status_counts(fact(spark, sf))


@query
def agent_performance(spark, sf):
    return reports.agent_performance(fact(spark, sf))


@query
def agent_performance_prioritized(spark, sf):
    return reports.agent_performance_prioritized(fact(spark, sf))


@query
def star_funnel(spark, sf):
    return reports.star_funnel(star_inputs(spark, sf)[0])


@query
def star_agent_performance(spark, sf):
    rows, built = star_inputs(spark, sf)
    return reports.star_agent_performance(rows, built.agent)


@query
def star_status(spark, sf):
    rows, built = star_inputs(spark, sf)
    return reports.star_status(rows, built.status)


@query
def star_daily_trend(spark, sf):
    rows, built = star_inputs(spark, sf)
    return reports.star_daily_trend(rows, built.date)


@query
def fact_uniqueness(spark, sf):
    return checks.uniqueness(fact(spark, sf))


@query
def source_performance(spark, sf):
    return reports.segment_performance(fact(spark, sf), "source")


@query
def industry_performance(spark, sf):
    return reports.segment_performance(fact(spark, sf), "industry")


@query
def kpi_overview(spark, sf):
    return reports.kpi_overview(fact(spark, sf), AS_OF)


@query
def daily_leads(spark, sf):
    return reports.daily_leads(fact(spark, sf))


@query
def capacity_overview(spark, sf):
    return reports.capacity_overview(risk.risk_scores(fact(spark, sf), AS_OF))


# ---------------------------------------------------------------- data quality


@query
def dq_completeness(spark, sf):
    return quality.dq_completeness(fact(spark, sf))


@query
def dq_uniqueness(spark, sf):
    return quality.dq_uniqueness(write_work(fact(spark, sf).select("staging_id", "linkedin_url")))


@query
def dq_validity(spark, sf):
    return quality.dq_validity(fact(spark, sf))


@query
def dq_timeliness(spark, sf):
    return quality.dq_timeliness(valid(spark, sf), AS_OF_TS)


@query
def dq_referential(spark, sf):
    return quality.dq_referential(fact(spark, sf))


@query
def dq_composite(spark, sf):
    return quality.dq_scores(written_fact(spark, sf), AS_OF_TS)


@query
def dq_history(spark, sf):
    return quality.dq_record(quality.dq_scores(written_fact(spark, sf), AS_OF_TS), RUN_TS)


# ---------------------------------------------------------------- risk


@query
def risk_base(spark, sf):
    return risk.risk_base(fact(spark, sf), AS_OF)


@query
def risk_rates(spark, sf):
    return risk.risk_rates(risk.risk_base(fact(spark, sf), AS_OF))


@query
def risk_wilson(spark, sf):
    rates = risk.risk_rates(risk.risk_base(fact(spark, sf), AS_OF))
    return risk.risk_wilson(rates).select(
        "agent", "connected_leads", "total_leads", "connection_rate_lower_95"
    )


@query
def risk_zscore(spark, sf):
    rates = risk.risk_rates(risk.risk_base(fact(spark, sf), AS_OF))
    return risk.risk_zscore(rates).select(
        "agent", "connection_rate", "total_leads", "connection_rate_zscore"
    )


@query
def risk_scores(spark, sf):
    return risk.risk_scores(fact(spark, sf), AS_OF)


# ---------------------------------------------------------------- verification


@query
def duplicate_ids(spark, sf):
    leads = staging.identify(raw_leads(spark, sf))
    return checks.duplicate_ids(leads)


@query
def scd_check(spark, sf):
    return checks.scd_check(dims.dim_agent(fact(spark, sf), RUN_TS))


@query
def scd_check_broken(spark, sf):
    """A history whose rows lack the time they are valid from, for one agent in five."""
    dim = dims.dim_agent(fact(spark, sf), RUN_TS)
    return checks.scd_check(dim.withColumn("valid_from", F.when(F.col("agent_key") % 5 > 0, F.col("valid_from"))))


@query
def dim_counts(spark, sf):
    return checks.dim_counts(dims.build_dims(written_fact(spark, sf), RUN_TS))


@query
def star_verification(spark, sf):
    rows, built = star_inputs(spark, sf)
    return checks.verify_star(write_work(rows), built)


@query
def star_verification_failing(spark, sf):
    """A star with rows twice, against a calendar that ends early and statuses of which one is missing."""
    rows, built = star_inputs(spark, sf)
    doubled = rows.unionByName(rows.where("date_key % 100 = 13"))
    stale = dims.Dims(built.agent, built.status.where("lead_status <> 'replied'"), _stale_dates(built))
    return checks.verify_star(write_work(doubled), stale)


@query
def alert_events(spark, sf):
    leads = write_work(valid(spark, sf))
    scores = quality.dq_scores_by(warehouse.fct_leads(leads).withColumn("batch", batch_of()), "batch", AS_OF_TS)
    named = scores.withColumns({"dq_run_id": F.concat(F.lit("run-"), "batch"), "dq_timestamp": F.lit(RUN_TS).cast("timestamp")})
    return checks.alert_events(run_ledger(leads), named)

