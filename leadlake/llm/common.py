"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import atexit
import ctypes
import gc
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.session import prepare, shared_dir

#: Rows in one Arrow batch handed to Python: texts of some KB make a batch of a few MB.
ARROW_ROWS = 500
#: Bytes at which an Arrow batch is closed early, so that long texts do not add up.
ARROW_BYTES = 16 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and Arrow batches that stay small."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column):
    """A-Z to a-z, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/llm-work/{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows through Spark's file system API."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Writes frames to the shared folder and returns the scans of them.

    The tables outlive lost executors, as no task keeps them on its own disk.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.made = spark, []

    def folder(self, name: str) -> str:
        """A new path, removed with the rest."""
        self.made.append(work_path(self.spark, name))
        return self.made[-1]

    def write(self, df: DataFrame, name: str) -> str:
        path = self.folder(name)
        df.write.parquet(path, compression="zstd")
        return path

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(self.write(df, name))


def lasting(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder for the rest of the session, and return the scan of it: for results of
    the size of the corpus, which a checkpoint would hold uncompressed. Removed when the process ends."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path, compression="zstd")
    atexit.register(_remove_late, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove_late(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        remove(spark, path)


@contextmanager
def scratch(spark: SparkSession):
    """A Scratch whose tables are removed when the block ends; what leaves the block is checkpointed before."""
    keep = Scratch(spark)
    try:
        yield keep
    finally:
        for path in keep.made:
            remove(spark, path)


@contextmanager
def measured(spark: SparkSession):
    """Steps that run in the block broadcast a side of a join only by the size its shuffle had, not by an estimate."""
    planned, seen = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {name: spark.conf.get(name, None) for name in (planned, seen)}
    spark.conf.set(seen, before[seen] or spark.conf.get(planned))
    spark.conf.set(planned, "-1")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def tidy(work):
    """`work`, an iterator function of a Python task, that hands memory back when it has ended.

    Spark keeps a Python worker for a while after its task; what the allocators hold would stay with it.
    """

    def run(*arguments):
        try:
            yield from work(*arguments)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def arrow_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
