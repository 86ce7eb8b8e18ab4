"""Raw leads derived from the generated test tables: one lead per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw export columns plus `src_ordinal`, with missing, duplicate and odd values planted by key.

    The item dates are aggregated per order before the join, so a huge order costs one row per map task.
    Orders and aggregated items are of one size; the hint keeps Spark from broadcasting either.
    """
    k = F.col("o_orderkey")
    open_item = F.col("l_linestatus") == "O"
    returned = open_item & (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25)
    ship = F.col("l_shipdate")
    items = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max(ship).alias("contacted"),
            F.min(F.when(open_item, ship)).alias("invited"),
            F.max(F.when(returned, ship)).alias("connected"),
        )
    )
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    leads = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(items.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )
    url = F.lit("https://www.linkedin.com/in/u")
    status = (
        F.when(k % 9 == 0, "captured")
        .when(k % 9 == 1, "invite sent")
        .when(k % 9 == 2, "Connected")
        .when(k % 9 == 3, "replied")
        .when(k % 9 == 4, "rejected")
        .when(k % 9 == 5, " Invite Sent ")
        .when(k % 9 == 6, "linkedin rate limited")
        .when(k % 9 == 7, "enriched")
    )
    priority = (
        F.when(k % 5 == 0, "Yes").when(k % 5 == 1, " no ").when(k % 5 == 2, "YES").when(k % 5 == 3, "maybe")
    )
    return leads.select(
        k.alias("src_ordinal"),
        F.col("c_name").alias("Name"),
        F.col("o_orderpriority").alias("Job Title"),
        F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("Company"),
        F.col("c_mktsegment").alias("Industry"),
        F.col("r_name").alias("Location"),
        F.when(k % 101 == 0, "  ").otherwise(F.col("n_name")).alias("Agent"),
        status.alias("SDR Status"),
        F.lit(None).cast("string").alias("Comment Status"),
        F.when(k % 10 != 0, (k % 104).cast("double")).alias("Hot Score"),
        F.col("o_orderstatus").alias("Source"),
        priority.alias("Prioritized"),
        F.when(k % 97 == 0, None)
        .when(k % 50 == 1, F.concat(F.lit(" HTTPS://www.linkedin.com/in/U"), (k - 1).cast("string"), F.lit(" ")))
        .otherwise(F.concat(url, k.cast("string")))
        .alias("LinkedIn URL"),
        F.when(k % 89 != 0, F.col("o_orderdate")).cast("timestamp").alias("Added On"),
        F.col("contacted").cast("timestamp").alias("Last Contacted"),
        F.col("invited").cast("timestamp").alias("Invite Sent At"),
        F.col("connected").cast("timestamp").alias("Connected At"),
    )
