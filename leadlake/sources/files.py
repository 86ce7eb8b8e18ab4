"""Scans of landed files: lead exports (CSV, JSON pages) and date patches."""

from __future__ import annotations

import csv
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.functions.dates import parse_mixed_ts
from leadlake.schemas import DATE_COLUMNS, DATE_PATCH, RAW, RAW_TO_STAGING, SOURCE_ORDER
from leadlake.sources import csv_records

#: Cell texts that the usual CSV readers of data frames take as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

#: Column that Spark puts the text of an unreadable record in.
CORRUPT = "_corrupt_record"
#: Reason that such a record is set aside for.
MALFORMED = "Malformed record;"

_ORDER_FIELDS = [
    T.StructField("src_time", T.TimestampType()),
    T.StructField("src_file", T.StringType()),
    T.StructField("src_block", T.LongType()),
    T.StructField("src_row", T.LongType()),
]

# RFC 4180 quoting: a quote inside a quoted cell is doubled.
_CSV = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}


def with_source_split(df: DataFrame) -> DataFrame:
    """Add the columns that order the splits of a scan: file time, file name, split start."""
    return df.select(
        "*",
        F.col("_metadata.file_modification_time").alias("src_time"),
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
    )


def with_row_counter(df: DataFrame) -> DataFrame:
    """Add a counter that orders rows within a split."""
    return df.withColumn("src_row", F.monotonically_increasing_id())


def with_source_order(df: DataFrame) -> DataFrame:
    """Add the columns that order rows as the files hold them.

    One task reads one split from start to end, so (split start, row counter) orders rows within a file.
    Across files the order is modification time, then name.
    """
    return with_row_counter(with_source_split(df))


def missing_to_null(df: DataFrame) -> DataFrame:
    """Null for cells whose text means a missing value."""
    return df.withColumns(
        {h: F.when(~F.col(f"`{h}`").isin(MISSING_TEXTS), F.col(f"`{h}`")) for h in RAW_TO_STAGING}
    )


def readable(scan: DataFrame, yes: bool = True) -> DataFrame:
    """The rows of a scan that could be read, or the others.

    Spark refuses to read only the column of unreadable texts, so the condition names another one too.
    """
    first = F.col(f"`{scan.columns[0]}`")
    read = F.col(CORRUPT).isNull() if yes else F.col(CORRUPT).isNotNull()
    return scan.where(read & (F.coalesce(F.length(first), F.lit(0)) >= 0))


def _header_names(header: str) -> list[str]:
    return next(csv.reader([header], doublequote=True), [])


def _split_csv(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(raw leads with their source order, malformed records) of exports whose cells may hold line breaks.

    Files are grouped by header, and the columns of each group are found by name.
    """
    found = csv_records.layout(spark, path)
    groups: dict[str, list[str]] = {}
    for file, header in sorted(found.headers.items()):
        groups.setdefault(header, []).append(file)
    leads, malformed = [], []
    options = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": CORRUPT}
    for header, files in groups.items():
        names = [n.strip() for n in _header_names(header)]
        absent = [h for h in RAW_TO_STAGING if h not in names]
        if absent:
            raise ValueError(f"lead export {files[0]} lacks columns {absent}")
        cells = ", ".join([*(f"c{i} string" for i in range(len(names))), f"{CORRUPT} string"])
        rows = csv_records.records(spark, files, found)
        parsed = rows.withColumn("cells", F.from_csv("record", cells, options))
        broken = F.col(f"cells.{CORRUPT}").isNotNull()
        leads.append(
            parsed.where(~broken).select(
                *[F.col(f"cells.c{names.index(h)}").alias(h) for h in RAW_TO_STAGING], *SOURCE_ORDER
            )
        )
        malformed.append(
            parsed.where(broken).select(
                "src_file", F.col("record").alias("raw_record"), F.lit(MALFORMED).alias("error_reason")
            )
        )
    if not groups:
        empty = spark.createDataFrame([], T.StructType([*RAW.fields, *_ORDER_FIELDS]))
        return empty, empty.select(*[F.lit(None).cast("string").alias(c) for c in ("src_file", "raw_record", "error_reason")])
    return reduce(DataFrame.unionByName, leads), reduce(DataFrame.unionByName, malformed)


def _scan_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All cells as text, and the whole text of rows that do not fit the header; a record is a line."""
    options = {**_CSV, "columnNameOfCorruptRecord": CORRUPT}
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, CORRUPT)])
    return spark.read.options(**options).schema(schema).csv(path)


def _scan_json(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    """All fields as text, and the whole text of unreadable lines."""
    options = {"multiLine": str(multi_line).lower(), "columnNameOfCorruptRecord": CORRUPT}
    schema = T.StructType([*RAW.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.options(**options).schema(schema).json(path)


def _malformed(scan: DataFrame) -> DataFrame:
    return readable(scan, False).select(
        F.col("_metadata.file_path").alias("src_file"),
        F.col(CORRUPT).alias("raw_record"),
        F.lit(MALFORMED).alias("error_reason"),
    )


def malformed_records(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool | None = None) -> DataFrame:
    """Rows (src_file, raw_record, error_reason): every record that the readers leave out, one by one."""
    if fmt == "csv" and multi_line is not False:
        return _split_csv(spark, path)[1]
    return _malformed(_scan_csv(spark, path) if fmt == "csv" else _scan_json(spark, path, bool(multi_line)))


def _beside(leads: DataFrame, malformed: DataFrame) -> DataFrame:
    """`leads` with the unreadable records of their files, for `malformed_of`."""
    leads._malformed = malformed
    return leads


def malformed_of(leads: DataFrame) -> DataFrame | None:
    """The unreadable records that a reader left out of `leads`; None if `leads` does not come from files.

    A frame made from a reader's frame no longer knows them: it raises, so that none are lost unseen.
    """
    found = vars(leads).get("_malformed")
    if found is None and "src_file" in leads.columns:
        raise ValueError("leads read from files and changed since need malformed=malformed_records(...)")
    return found


def read_leads_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Scan lead exports with a header row; every cell is text, missing cells are null.

    Columns are found by header name; files may have headers of different order, or more columns than others. A
    file without a column that leads need raises. Files are read in splits, also where quoted cells hold line breaks
    (`csv_records`), at the price of a pass over the text before the one that reads it. `multi_line=False` saves that
    pass where no cell holds a line break; then a file whose header differs from the first one raises. Rows with too
    few or too many cells are left out; `malformed_of` the result has them.
    """
    if multi_line:
        leads, malformed = _split_csv(spark, path)
        return _beside(missing_to_null(leads), malformed)
    scan = _scan_csv(spark, path)
    by_name = {c.lstrip("\ufeff").strip(): c for c in scan.columns}
    absent = [h for h in RAW_TO_STAGING if h not in by_name]
    if absent:
        raise ValueError(f"lead export lacks columns {absent}")
    named = with_source_order(readable(scan)).select(
        *[F.col(f"`{by_name[h]}`").alias(h) for h in RAW_TO_STAGING],
        "src_time", "src_file", "src_block", "src_row",
    )
    return _beside(missing_to_null(named), _malformed(scan))


def read_leads_json(
    spark: SparkSession,
    path: str | list[str],
    updated_after: datetime | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Scan landed feed pages; with `updated_after`, keep leads whose newest date lies after it.

    Pages hold one lead per line, or one JSON array each with `multi_line`. Texts that mean a missing value are
    null, as in a CSV export; unreadable lines are left out, and `malformed_of` the result has all of them.
    """
    scan = _scan_json(spark, path, multi_line)
    leads = missing_to_null(with_source_order(readable(scan)).drop(CORRUPT))
    if updated_after is None:
        return _beside(leads, _malformed(scan))
    headers = [h for h, c in RAW_TO_STAGING.items() if c in DATE_COLUMNS]
    late = leads.where(F.greatest(*[parse_mixed_ts(f"`{h}`") for h in headers]) > F.lit(updated_after))
    return _beside(late, _malformed(scan))


def read_date_patch(spark: SparkSession, path: str) -> DataFrame:
    """Scan a CSV of days to add to the calendar (declared columns, header skipped)."""
    return spark.read.schema(DATE_PATCH).csv(path, header=True)
