"""Lookups and verification read little, or once."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.operators import checks, dims, star
from leadlake.operators.warehouse import STAGING_LOOKUP, fct_leads, lookup
from leadlake.schemas import STG_LEADS
from leadlake.sources.store import Store
from tests.leads import T0


def leads(spark, n):
    named = spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("staging_id"),
        F.concat(F.lit("name "), F.md5((F.col("id") * 7).cast("string"))).alias("name"),
        F.concat(F.lit("agent "), F.col("id") % 5).alias("agent"),
        F.lit("replied").alias("sdr_status"),
        F.lit(T0).cast("timestamp").alias("added_on"),
    )
    return named.select(*[F.col(f.name) if f.name in named.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in STG_LEADS])


def rows_scanned(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_lookup_by_name_reads_a_small_share(spark, tmp_path):
    store, n = Store(spark, str(tmp_path), buckets=16), 32_000
    store.write_buckets("stg_leads", store.by_lead(leads(spark, n), n), "r1")
    store.publish("r1", {"stg_leads": list(range(16))}, True)
    sought = leads(spark, n).where("staging_id = md5('77')").first().name
    found = lookup(store.read("stg_leads"), STAGING_LOOKUP, name=sought)
    assert rows_scanned(found) <= n / 8 and [r.name for r in found.collect()] == [sought]
    assert rows_scanned(lookup(store.read("stg_leads"), STAGING_LOOKUP, name="nobody")) <= n / 8


def test_verification_reads_the_fact_once(spark, tmp_path):
    facts = fct_leads(leads(spark, 200))
    built = dims.build_dims(facts, T0)
    star.star_fact(facts, built).write.parquet(str(tmp_path / "star"))
    checked = checks.verify_star(spark.read.parquet(str(tmp_path / "star")), built)
    plan = checked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("/star]") == 1
    assert {r["check"]: r.passed for r in checked.collect()}["verdict"] == 1
