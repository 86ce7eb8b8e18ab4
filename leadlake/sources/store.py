"""Warehouse tables as partition directories of parquet files.

A load writes `<table>/load_id=<run>/` and becomes visible when the run is published: one small file append
that names all its tables at once. Repeating a load rewrites its own directory only, and nothing that is
being read is ever overwritten. Where a table format with MERGE is installed, use that instead.

`stg_leads`, the star fact and the lead index are split into buckets by lead id. A run either writes a bucket anew
or puts its changed rows beside what is there (a delta): readers take the newest row of each lead, by a join with the
ids of the deltas, which are a bounded share of the bucket. The number of buckets is kept with them: opening a store
with another one is an error, as leads would land in other buckets than before. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.operators.checks import table_presence
from leadlake.operators.dims import Dims
from leadlake.schemas import TABLES
from leadlake.session import exists, remove

_PUBLISHED = "seq long, run_id string, table string, bucket int, complete boolean, buckets int, delta boolean, rows long"
_WHOLE = -1  # bucket of a table that is not split
SOUGHT = ["name"]  # columns of point lookups
_ROWS_PER_TASK = 1_000_000  # leads a task shuffles and writes, some 300 MB
_SMALL_DELTAS = 250_000  # rows of deltas whose ids are broadcast to readers, some 30 MB


@dataclass(frozen=True)
class Layer:
    """What one run has published of a bucket: all of it, or a delta. `rows` is an upper bound for the former."""

    seq: int
    run_id: str
    rows: int


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 256):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._runs: dict[str, dict[int, list[Layer]]] | None = None

    def refresh(self) -> None:
        """Forget what was published when last looked; other writers may have published since."""
        self._runs = None

    # ------------------------------------------------------------ reading

    def _scan(self, schema, *paths: str, base: str | None = None) -> DataFrame:
        """Parquet scan; no rows when nothing was written yet."""
        reader = self.spark.read.schema(schema)
        if base:
            reader = reader.option("basePath", base)
        if len(paths) == 1 and not exists(self.spark, paths[0]):
            return self.spark.createDataFrame([], schema)
        return reader.parquet(*paths)

    def published(self) -> DataFrame:
        return self._scan(_PUBLISHED, f"{self.root}/_published")

    def layers(self, name: str) -> dict[int, list[Layer]]:
        """Per bucket the load that last wrote it anew and the deltas since; one small row each reaches the driver.

        A complete load voids every bucket of its tables published before it.
        """
        if self._runs is None:
            entries = self.published().withColumn("_whole", ~F.coalesce("delta", F.lit(False)))
            since = entries.where("complete").groupBy("table").agg(F.max("seq").alias("_since"))
            base = entries.where("_whole").groupBy("table", "bucket").agg(F.max("seq").alias("_base"))
            current = (
                entries.join(since, "table", "left")
                .join(base, ["table", "bucket"])
                .where((F.col("seq") >= F.coalesce("_since", F.lit(0))) & (F.col("seq") >= F.col("_base")))
            )
            runs: dict[str, dict[int, list[Layer]]] = {}
            for r in current.orderBy("seq").collect():
                if r.bucket != _WHOLE and r.buckets not in (None, self.buckets):
                    raise ValueError(f"{r.table} is kept in {r.buckets} buckets, not in {self.buckets}")
                layer = Layer(r.seq, r.run_id, r.rows or 0)
                runs.setdefault(r.table, {}).setdefault(r.bucket, []).append(layer)
            self._runs = runs
        return self._runs.get(name, {})

    def _current(self, name: str) -> dict[int, str]:
        """Latest published run per bucket."""
        return {bucket: layers[-1].run_id for bucket, layers in self.layers(name).items()}

    def _path(self, name: str, run_id: str, bucket: int = _WHOLE) -> str:
        path = f"{self.root}/{name}/load_id={run_id}"
        return path if bucket == _WHOLE else f"{path}/bucket={bucket}"

    def read(self, name: str, buckets: Iterable[int] | None = None, key: str = "staging_id") -> DataFrame:
        """Published content of a table, or of some of its buckets. Only their directories are listed.

        Of leads that several layers of a bucket hold, the newest row counts. Runs are in the order of their
        publishing; the ids of the deltas are joined, broadcast if they are few.
        """
        schema, found = TABLES[name], self.layers(name)
        if buckets is not None:
            wanted = set(buckets)
            found = {b: layers for b, layers in found.items() if b in wanted}
        if not found:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{name}"
        paths = [self._path(name, x.run_id, b) for b, layers in sorted(found.items()) for x in layers]
        deltas = [(b, x) for b, layers in sorted(found.items()) for x in layers[1:]]
        if not deltas:
            return self._scan(schema, *paths, base=base).select(*schema.names)
        order = {x.run_id: x.seq for layers in found.values() for x in layers}
        seq = F.create_map(*[F.lit(v) for pair in order.items() for v in pair])[F.col("load_id")]
        placed = T.StructType([*schema.fields, T.StructField("load_id", T.StringType()), T.StructField("bucket", T.IntegerType())])
        rows = self._scan(placed, *paths, base=base).withColumn("_seq", seq)
        late = self._scan(placed, *[self._path(name, x.run_id, b) for b, x in deltas], base=base)
        newest = late.withColumn("_seq", seq).groupBy(key).agg(F.max("_seq").alias("_newest"))
        if sum(x.rows for _, x in deltas) <= _SMALL_DELTAS:
            newest = F.broadcast(newest)
        visible = rows.join(newest, key, "left").where("_newest IS NULL OR _seq = _newest")
        return visible.select(*schema.names)

    def exists(self, name: str) -> bool:
        return bool(self._current(name))

    def required_tables(self, names: Iterable[str]) -> DataFrame:
        """Rows (table, exists)."""
        return table_presence(self.spark, ((n, self.exists(n)) for n in names))

    def require_tables(self, names: Iterable[str]) -> None:
        """Raise when a table was never published."""
        absent = [n for n in names if not self.exists(n)]
        if absent:
            raise RuntimeError(f"required tables are missing: {absent}")

    def dims(self) -> Dims:
        return Dims(self.read("dim_agent"), self.read("dim_lead_status"), self.read("dim_date"))

    # ------------------------------------------------------------ writing

    def bucket(self, key: str = "staging_id") -> Column:
        """Bucket of a lead, by the same hash that Spark shuffles on."""
        return F.pmod(F.hash(key), F.lit(self.buckets))

    def by_lead(self, df: DataFrame, rows: int, key: str = "staging_id") -> DataFrame:
        """Shuffle on the lead id into a multiple of the buckets, as many tasks as the rows need.

        With a multiple, all rows of a task belong to one bucket, however large the table gets.
        """
        tasks = self.buckets * max(1, ceil(rows / (self.buckets * _ROWS_PER_TASK)))
        return df.repartition(tasks, key)

    def write(
        self, name: str, df: DataFrame, run_id: str, observe: Observation | None = None, *metrics: Column
    ) -> DataFrame:
        """Write one load of a table (not yet visible) and return it as written."""
        if observe is not None:
            df = df.observe(observe, *metrics)
        df.write.mode("overwrite").parquet(self._path(name, run_id))
        return self._scan(df.schema, self._path(name, run_id))

    def write_buckets(
        self, name: str, df: DataFrame, run_id: str, observe: Observation | None = None, *metrics: Column
    ) -> None:
        """Write one load split by lead id; rows should come grouped by `bucket()` already.

        Buckets are sorted by the columns that leads are looked up by, and hold Bloom filters of them, so a lookup
        reads the pages that may hold its value, of the row groups that may.
        """
        if observe is not None:
            df = df.observe(observe, *metrics)
        split, sought = df.withColumn("bucket", self.bucket()), [c for c in SOUGHT if c in df.columns]
        writer = split.sortWithinPartitions("bucket", *sought).write.mode("overwrite").partitionBy("bucket")
        for column in sought:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(self._path(name, run_id))

    def written(self, name: str, run_id: str) -> DataFrame:
        """What a run has written of a split table. A task reads files of one bucket or a few, so rows made of these
        can be written by bucket as they lie."""
        schema = TABLES[name]
        return self._scan(schema, self._path(name, run_id)).select(*schema.names)

    def discard(self, name: str, run_id: str) -> None:
        """Delete what a run has written of a table that is never published."""
        remove(self.spark, self._path(name, run_id))

    def is_published(self, run_id: str) -> bool:
        return not self.published().where(F.col("run_id") == run_id).isEmpty()

    def publish(
        self,
        run_id: str,
        tables: dict[str, Iterable[int] | None],
        complete: bool = False,
        sizes: dict[int, int] | None = None,
        deltas: Iterable[int] = (),
    ) -> None:
        """Make the loads of a run visible, all at once. A table maps to its buckets, or to None if whole.

        `complete` says that the named buckets are all there is of a split table, `deltas` names those buckets of
        which only changed rows were written, and `sizes` tells the rows of buckets.
        """
        self.layers("")  # the newest entry of any table is a layer of it
        last = max((x.seq for buckets in self._runs.values() for found in buckets.values() for x in found), default=0)
        sizes, deltas = sizes or {}, set(deltas)
        rows = [
            (last + 1, run_id, name, bucket, complete, self.buckets, bucket in deltas, sizes.get(bucket))
            for name, buckets in tables.items()
            for bucket in ([_WHOLE] if buckets is None else sorted(buckets))
        ]
        entry = self.spark.createDataFrame(rows, _PUBLISHED).coalesce(1)
        entry.write.mode("append").parquet(f"{self.root}/_published")
        self.refresh()

    def replace(self, name: str, df: DataFrame, run_id: str) -> None:
        """Truncate-and-load: write, then publish. A repeated or empty load changes nothing."""
        if self.is_published(run_id) or df.isEmpty():
            return
        self.write(name, df, run_id)
        self.publish(run_id, {name: None})

    def ensure(self, name: str) -> None:
        """Create an empty table unless it exists."""
        if not self.exists(name):
            run_id = f"create-{name}"
            self.write(name, self.spark.createDataFrame([], TABLES[name]), run_id)
            self.publish(run_id, {name: None})

    # ------------------------------------------------------------ ledgers

    def append(self, name: str, df: DataFrame, part: str) -> None:
        """Append to a ledger under a part name; repeating the part replaces its rows."""
        df.select(*TABLES[name].names).write.mode("overwrite").parquet(
            f"{self.root}/{name}/part={part}"
        )

    def ledger(self, name: str) -> DataFrame:
        """All rows of a ledger."""
        schema = TABLES[name]
        return self._scan(schema, f"{self.root}/{name}").select(*schema.names)

    def finished_runs(self) -> DataFrame:
        """Ledger rows of runs whose tables are visible. A run enters the ledger before it is published, so
        a crash in between leaves neither tables nor watermark behind."""
        visible = self.published().select("run_id").distinct()
        return self.ledger("pipeline_runs").join(visible, "run_id", "left_semi")
