"""Run named queries against their DuckDB counterparts and report differences."""

from __future__ import annotations

import datetime
import math
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    if isinstance(value, float):
        return float(f"{value:.12g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([c[0] for c in cur.description], cur.fetchall())


def difference(spark, con, query, sql, sf_dir) -> str:
    """Empty when equal, else what differs."""
    got_cols, got = spark_rows(query(spark, sf_dir))
    want_cols, want = oracle_rows(con, sql)
    if got_cols != want_cols:
        return f"columns {set(got_cols) ^ set(want_cols)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w or [type(a) for a in g] != [type(b) for b in w]:
            off = [(c, a, b) for c, a, b in zip(got_cols, g, w, strict=True) if a != b or type(a) is not type(b)]
            return f"values {off}"
    return ""


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from leadlake.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name, query in queries.items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            if name in oracle:
                found = difference(spark, con, query, oracle[name], sf_dir)
            else:
                found = "" if query(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"error {str(error)[:600]}"
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {time.time() - began:.2f}s {found[:900]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    import sys

    sys.path.insert(0, ".")
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
