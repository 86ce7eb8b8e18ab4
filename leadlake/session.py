"""Session settings shared by tests, bench and jobs."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: SQL settings the operators rely on; safe to set on a session someone else built.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(master: str | None = None, app: str = "leadlake", **conf: str) -> SparkSession:
    """A session with our settings; `master` stays unset on a cluster (spark-submit names it)."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set our SQL settings on an existing session."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees: `spark.checkpoint.dir`, else the context's checkpoint dir.

    Only a local session without either gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="leadlake-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: written once to the shared folder, so later passes neither recompute the
    plan above it nor depend on the executors that computed it."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run steps that don't wait for one another at once, so that small jobs fill the gaps of others.

    All have ended when this returns or raises; the first error is raised.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [s.result() for s in started]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, by Spark's file system API."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def as_path(spark: SparkSession, uri: str) -> str:
    """The path that a reader takes for the URI of a file, in which odd characters are escaped."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system API; one that is not there is fine."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_swept: set[str] = set()


def work_dir(spark: SparkSession) -> str:
    """The application's own folder for frames that outlive a step; removed when the process ends."""
    path = f"{shared_dir(spark)}/leadlake-work/{spark.sparkContext.applicationId}"
    if path not in _swept:
        _swept.add(path)
        atexit.register(_sweep, spark, path)
    return path


def _sweep(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        remove(spark, path)


def write_work(df: DataFrame) -> DataFrame:
    """Write a frame that several later steps read, and return the scan of it.

    Parquet in the shared folder: it outlives executors, and each reader scans only its own columns.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
