"""The daily load: source rows to staging, star schema, quality gate and risk table.

Nothing becomes visible before every gate has passed; a failed run leaves a ledger row and unread directories.
Every result that is read twice is a written table, so lost executors cost a task, not the run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from leadlake.functions.stats import rows
from leadlake.operators import dims as dimensions
from leadlake.operators import incremental, maintained, quality, risk, staging, star, validation
from leadlake.operators.checks import alert_events, run_record
from leadlake.operators.dedup import keep_last
from leadlake.operators.warehouse import fct_leads
from leadlake.schemas import RISK_SCORES, SOURCE_ORDER
from leadlake.session import together
from leadlake.sources.files import malformed_of
from leadlake.sources.store import Store


@dataclass(frozen=True)
class Settings:
    """What a run may vary. `as_of` is the day ghosting is judged on, by default the day of the run.

    `detect` says how an incremental run finds changed leads: by the `watermark`, or by `content`, which compares
    every lead of the source with the digest of what is known of it, so edits that move no date load too. Leads dated
    later than the run's clock plus `ahead` are set aside; None keeps them.
    """

    mode: str = "incremental"  # or "full"
    detect: str = "watermark"  # or "content"
    ahead: timedelta | None = timedelta(days=1)
    use_watermark: bool = True
    overlap: timedelta | None = None
    order: tuple[str, ...] = tuple(SOURCE_ORDER)
    dedup_nulls: bool = True
    as_of: datetime | None = None
    dq_threshold: float = 95.0
    pipeline: str = incremental.PIPELINE
    #: A bucket is written anew once its deltas hold more than this share of its rows, or are this many (up to twice
    #: as many, by its number, so that buckets don't all come due at once).
    delta_share: float = 0.25
    most_deltas: int = 32


@dataclass
class Outcome:
    run_id: str
    status: str = "SUCCESS"
    rows_read: int = 0
    rows_loaded: int = 0
    rows_changed: int = 0
    rows_inserted: int | None = None  # of the changed ones, where changes are found by content
    rows_unchanged: int | None = None
    dead_letters: int = 0
    watermark_start: datetime | None = None
    watermark_end: datetime | None = None
    quality: dict = field(default_factory=dict)


def run_load(
    store: Store,
    raw: DataFrame,
    run_id: str,
    run_ts: datetime,
    settings: Settings = Settings(),
    malformed: DataFrame | None = None,
) -> Outcome:
    """Load one source snapshot. Repeating a finished run id does nothing; a failed run is recorded and raised.

    `malformed` holds the records that the reader could not read, by default those that the frame of a reader
    brings along (see `malformed_of`); each of them is kept in a ledger with its text, and counted as read and as a
    dead letter.
    """
    if malformed is None:
        malformed = malformed_of(raw)
    out = Outcome(run_id)
    store.refresh()
    if store.is_published(run_id):
        out.status = "ALREADY_LOADED"
        return out
    started = datetime.now(timezone.utc)

    def record(status: str, error: str | None = None) -> DataFrame:
        return run_record(
            store.spark, run_id, settings.pipeline, started, datetime.now(timezone.utc), out.rows_read,
            out.rows_loaded, status, out.watermark_start, out.watermark_end, error,
        )

    try:
        loaded = _load(store, raw, run_ts, settings, out, malformed)
        store.append("pipeline_runs", record("SUCCESS"), run_id)
        store.publish(run_id, *loaded)
    except Exception as error:
        out.status = "FAILED"
        store.append("pipeline_runs", record("FAILED", str(error)), f"{run_id}-failed")
        raise
    finally:
        for name in ("_staged", "_changed"):
            store.discard(name, run_id)
    return out


@dataclass(frozen=True)
class _Plan:
    """How the changed rows go into the buckets: their rows by bucket, and the buckets to write anew."""

    touched: dict[int, int]
    sizes: dict[int, int]
    anew: frozenset[int]

    @property
    def deltas(self) -> list[int]:
        return sorted(set(self.touched) - self.anew)


def _load(
    store: Store, raw: DataFrame, run_ts: datetime, settings: Settings, out: Outcome, malformed: DataFrame | None
) -> tuple:
    """All steps up to publishing; returns what to publish: tables, whether they replace everything, sizes, deltas."""
    if settings.detect not in ("watermark", "content"):
        raise ValueError(f"unknown way to detect changes {settings.detect!r}")
    source = _stage(store, raw, run_ts, settings, out)
    if malformed is not None:
        _set_aside(store, malformed, run_ts, out)
    valid = source.where("error_reason = ''").drop("error_reason")

    out.watermark_start = incremental.moment(
        incremental.current_watermark(store.finished_runs(), settings.pipeline)
    )
    complete = settings.mode == "full" or not store.exists("stg_leads")
    changed = valid
    if not complete and settings.detect == "content":
        changed = _edited(store, valid, out)
    elif not complete and settings.use_watermark:
        changed = incremental.incremental_rows(valid, out.watermark_start, settings.overlap)
    plan = _measure(store, changed, run_ts, settings, complete, out)

    tables: dict = {}
    sums = store.read("lead_sums")
    if plan.touched:
        sums = _write_leads(store, changed, run_ts, plan, complete, out)
        split = dict.fromkeys(("stg_leads", "fct_leads_star", "lead_index"), list(plan.touched))
        tables = {**split, "lead_sums": None, "dim_agent": None, "dim_lead_status": None, "dim_date": None}
    _, scores = together(
        store.spark,
        partial(_check_quality, store, sums, run_ts, settings, out),
        partial(_write_risk, store, sums, (settings.as_of or run_ts).date(), out),
    )
    risk.require_agents(scores)
    replaced = complete and bool(plan.touched)
    return {**tables, "analytics_risk_scores": None}, replaced, plan.sizes, plan.deltas


def _stage(
    store: Store, raw: DataFrame, run_ts: datetime, settings: Settings, out: Outcome
) -> DataFrame:
    """Stage and check the source once, written; set invalid rows aside.

    A date ahead of the run's clock is a typing error: its lead goes to the dead letters, where it is seen, as one such
    date would end all later increments and stretch the calendar to it.
    """
    staged = staging.stage_leads(
        raw, run_ts, list(settings.order), settings.dedup_nulls, copies="_copies"
    )
    rules = validation.default_rules()
    if settings.ahead is not None:
        rules.append(validation.dated_after(run_ts + settings.ahead))
    checked = store.write("_staged", validation.with_reasons(staged, rules), out.run_id)
    is_dead = F.col("error_reason") != ""
    seen = checked.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("read"), F.count_if(is_dead).alias("dead")
    ).first()
    out.rows_read, out.dead_letters = seen.read, seen.dead
    if out.dead_letters:
        letters = validation.dead_letters(checked.where(is_dead), out.run_id, run_ts)
        store.append("dead_letter_leads", letters, out.run_id)
    return checked.drop("_copies")


def _set_aside(store: Store, malformed: DataFrame, run_ts: datetime, out: Outcome) -> None:
    """Keep unreadable records, every one with its text."""
    stamped = malformed.withColumns(
        {"run_id": F.lit(out.run_id), "set_aside_at": F.lit(run_ts).cast("timestamp")}
    )
    store.append("malformed_records", stamped, out.run_id)
    n = store.ledger("malformed_records").where(F.col("run_id") == out.run_id).count()
    out.rows_read += n
    out.dead_letters += n


def _edited(store: Store, valid: DataFrame, out: Outcome) -> DataFrame:
    """Leads that are new, or differ from what is known of them; written.

    The index is read by three narrow columns. Both sides are shuffled on the lead id, or the smaller one is
    broadcast; unchanged leads end here.
    """
    known = store.read("lead_index").select("staging_id", F.col("digest_1").alias("_1"), F.col("digest_2").alias("_2"))
    one, two = maintained.digests()
    same = (one == F.col("_1")) & (two == F.col("_2"))
    compared = valid.join(known, "staging_id", "left")
    found = compared.where(~F.coalesce(same, F.lit(False))).withColumn("_is_new", F.col("_1").isNull()).drop("_1", "_2")
    changed = store.write("_changed", found, out.run_id)
    counts = changed.agg(rows().alias("n"), F.count_if("_is_new").alias("new")).first()
    out.rows_inserted, out.rows_unchanged = counts.new, valid.count() - counts.n
    return changed.drop("_is_new")


def _measure(
    store: Store, changed: DataFrame, run_ts: datetime, settings: Settings, complete: bool, out: Outcome
) -> _Plan:
    """Count the changed rows by bucket, move the watermark, and choose the buckets that are written anew.

    The mark never passes the run's clock, so a date ahead of it can't hide later leads.
    """
    counted = changed.groupBy(store.bucket().alias("bucket")).agg(
        rows().alias("n"), F.max("record_updated_at").cast("timestamp_ntz").alias("newest")
    )
    found = counted.collect()  # one row a bucket
    touched = {r.bucket: r.n for r in sorted(found)}
    out.rows_changed = sum(touched.values())
    marks = [min(incremental.utc(r.newest), run_ts) for r in found if r.newest is not None]
    if out.watermark_start is not None:
        marks.append(out.watermark_start)
    out.watermark_end = max(marks, default=None)

    sizes, anew = dict(touched), set(touched)
    if not complete:
        for bucket, layers in store.layers("stg_leads").items():
            if bucket not in touched:
                continue
            base, late = layers[0].rows, touched[bucket] + sum(x.rows for x in layers[1:])
            due = len(layers) > settings.most_deltas + bucket % settings.most_deltas
            if due or late > settings.delta_share * base:
                sizes[bucket] = base + late
            else:
                anew.discard(bucket)
    return _Plan(touched, sizes, frozenset(anew))


#: Rows of dimensions that Spark broadcasts for sure, so that joined rows stay in the tasks of their buckets.
_SMALL_DIMS = 50_000


def _write_split(
    store: Store, name: str, fresh: DataFrame, plan: _Plan, complete: bool, out: Outcome, placed: bool = False
) -> None:
    """Write the changed rows of a split table, beside what is there or, in buckets that are due, instead of it.

    Rows are shuffled on the lead id, once, so that each task writes one bucket; `placed` rows lie so already.
    Unchanged rows of buckets that are written anew are carried over as they are; per lead, the changed row comes last.
    """
    rows_ = sum(plan.sizes.values())
    if complete or not plan.anew:
        store.write_buckets(name, fresh if placed else store.by_lead(fresh, rows_), out.run_id)
        return
    both = store.read(name, plan.anew).withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    placed = store.by_lead(both, rows_)
    store.write_buckets(name, keep_last(placed, ["staging_id"], ["_new"]).drop("_new"), out.run_id)


def _write_leads(
    store: Store, changed: DataFrame, run_ts: datetime, plan: _Plan, complete: bool, out: Outcome
) -> DataFrame:
    """Write dimensions, and staging, star and index rows of the changed leads, and the sums as they are with them.

    Missing star keys are counted on the way and stop the run. Of the known leads only the narrow index is read, for
    the shares that the old versions of changed leads have in the sums.

    Where no bucket is written anew, the rows that staging has got lie in their buckets, and star and index rows are
    made of them without a shuffle of their own; the sums then come from the index rows as written.
    """
    built, _ = together(
        store.spark,
        partial(_write_dims, store, changed, run_ts, out),
        partial(_write_split, store, "stg_leads", changed, plan, complete, out),
    )
    lies = complete or not plan.anew
    facts = fct_leads(store.written("stg_leads", out.run_id) if lies else changed)

    def keyed() -> None:
        missing, small = Observation(), sum(d.count() for d in (built.agent, built.status, built.date)) <= _SMALL_DIMS
        rows_ = star.star_fact(facts, built).observe(missing, *star.missing_key_counts())
        _write_split(store, "fct_leads_star", rows_, plan, complete, out, lies and small)
        star.require_keys(missing.get)

    def summed() -> DataFrame:
        index = maintained.index_rows(facts)
        _write_split(store, "lead_index", index, plan, complete, out, lies)
        parts = [maintained.sums_of(store.written("lead_index", out.run_id) if lies else index)]
        if not complete:
            old = store.read("lead_index", plan.touched).join(changed.select("staging_id"), "staging_id", "left_semi")
            parts += [maintained.sums_of(old, -1), store.read("lead_sums")]
        return store.write("lead_sums", maintained.merged(*parts), out.run_id)

    return together(store.spark, keyed, summed)[-1]


def _write_dims(
    store: Store, changed: DataFrame, run_ts: datetime, out: Outcome
) -> dimensions.Dims:
    """Extend the dimensions by what the changed rows bring; known keys stay.

    The calendar covers everything from the first day a lead was added to the newest update.
    """
    known = store.dims()
    built = dimensions.build_dims(fct_leads(changed), run_ts, known)
    ends = dimensions.day_range(F.col("added_on"), F.col("record_updated_at"), changed).unionByName(
        known.date.agg(F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"))
    )
    span = ends.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    days = dimensions.fill_date_gaps(known.date, dimensions.days_between(span))
    written = {"dim_agent": built.agent, "dim_lead_status": built.status, "dim_date": days}
    return dimensions.Dims(
        *together(store.spark, *[partial(store.write, name, dim, out.run_id) for name, dim in written.items()])
    )


def _write_risk(store: Store, sums: DataFrame, as_of: date, out: Outcome) -> DataFrame:
    scores = risk.score_agents(maintained.risk_base(sums, as_of))
    typed = scores.select(*[F.col(f.name).cast(f.dataType) for f in RISK_SCORES.fields])
    return store.write("analytics_risk_scores", typed, out.run_id)


def _check_quality(
    store: Store, sums: DataFrame, run_ts: datetime, settings: Settings, out: Outcome
) -> None:
    """Scores from the maintained sums; the one row of results is recorded, then judged."""
    scores = maintained.dq_scores(sums, run_ts, settings.dq_threshold)
    found = scores.first()
    out.quality, out.rows_loaded = found.asDict(), found.total_rows
    row = store.spark.createDataFrame([found], scores.schema)
    store.append("dq_results", quality.dq_record(row, run_ts), out.run_id)
    quality.require_quality(found.dq_status, found.composite_dq_score)


# ---------------------------------------------------------------- reading


def tables(store: Store) -> dict[str, DataFrame]:
    """All published tables and reports by name. Reports come from the maintained sums."""
    stg, keyed, built = store.read("stg_leads"), store.read("fct_leads_star"), store.dims()
    fct, fact, sums = fct_leads(stg), star.fact_leads(keyed), store.read("lead_sums")
    scores = store.read("analytics_risk_scores")
    return {
        "stg_leads": stg,
        "fct_leads": fct,
        "fct_leads_star": keyed,
        "fact_leads": fact,
        "dim_agent": built.agent,
        "dim_lead_status": built.status,
        "dim_date": built.date,
        "vw_leads_analytics": star.vw_leads_analytics(fact, built),
        "lead_sums": sums,
        "analytics_lead_funnel": maintained.lead_funnel(sums),
        "analytics_lead_status": maintained.lead_status(sums),
        "analytics_agent_performance": maintained.agent_performance(sums),
        "analytics_star_funnel": maintained.star_funnel(sums),
        "analytics_star_agent_performance": maintained.star_agent_performance(sums, built),
        "analytics_star_status": maintained.star_status(sums, built),
        "analytics_star_daily_trend": maintained.star_daily_trend(sums, built),
        "analytics_risk_scores": scores,
        "dead_letter_leads": store.ledger("dead_letter_leads"),
        "pipeline_runs": store.ledger("pipeline_runs"),
        "dq_results": store.ledger("dq_results"),
        "alert_events": alert_events(store.ledger("pipeline_runs"), store.ledger("dq_results")),
    }


def register_views(store: Store) -> list[str]:
    """Offer all published tables and reports to SQL as temporary views."""
    found = tables(store)
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return sorted(found)
