"""CSV records over splits of any size, against Python's reader."""

from __future__ import annotations

import csv
import io
import random

import pytest

from leadlake.schemas import RAW_TO_STAGING
from leadlake.sources import csv_records
from leadlake.sources.files import malformed_of, malformed_records, read_leads_csv

HEADERS = list(RAW_TO_STAGING)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(rng):
    return rng.choice(["x", "", "two\nlines", 'say "no"', "a,b", '"', "\n\n", "é 東", " pad ", 'q",\n"r', "x" * 400, "\r\nwin"])


def write(path, rows, header=HEADERS, end="\n"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header)
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())


def read(spark, path):
    leads = read_leads_csv(spark, path)
    found = leads.orderBy("src_file", "src_block", "src_row").collect()
    return [tuple(r[h] for h in HEADERS) for r in found]


def kept(value):
    return None if value in ("", "None", "NA") else value


@pytest.mark.parametrize("size", [50, 300, 1500, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_cells_equal_pythons_reader(spark, small_splits, tmp_path, size, end):
    rng = random.Random(size)
    rows = [[cell(rng) for _ in HEADERS] for _ in range(40)]
    write(tmp_path / "a.csv", rows, end=end)
    small_splits(size)
    assert read(spark, str(tmp_path)) == [tuple(kept(c) for c in r) for r in rows]
    assert malformed_records(spark, str(tmp_path)).isEmpty()
    if size == 300:
        assert read_leads_csv(spark, str(tmp_path)).rdd.getNumPartitions() > 5


def test_one_cell_over_many_splits(spark, small_splits, tmp_path):
    long = "\n".join(f"line {k}, of a cell" for k in range(200))
    write(tmp_path / "a.csv", [["first", *["x"] * 15], ["long", long, *["y"] * 14], ["last", *["z"] * 15]])
    small_splits(200)
    got = read(spark, str(tmp_path))
    assert [r[0] for r in got] == ["first", "long", "last"] and got[1][1] == long


def test_malformed_rows_go_aside_whatever_the_splits(spark, small_splits, tmp_path):
    rows = [[f"n{k}", *["a\nb"] * 15] for k in range(30)]
    write(tmp_path / "a.csv", rows)
    text = (tmp_path / "a.csv").read_text()
    broken = ["too,few", ",".join(["m"] * 17), '"open\nquote,x']
    (tmp_path / "a.csv").write_text(text + broken[0] + "\n\n\r\n" + broken[1] + "\n" + broken[2] + "\n")
    for size in (64, 1 << 20):
        small_splits(size)
        leads = read_leads_csv(spark, str(tmp_path))
        assert leads.count() == 30
        assert {r.raw_record.rstrip("\n") for r in malformed_of(leads).collect()} == set(broken)


def test_files_of_different_headers(spark, small_splits, tmp_path):
    write(tmp_path / "a.csv", [[f"{h}-a" for h in HEADERS]])
    write(tmp_path / "b c.csv", [[f"{h}-b" for h in HEADERS[::-1]]], HEADERS[::-1])
    write(tmp_path / "d.csv", [["r\n", *[f"{h}-d" for h in HEADERS], "s"]], ["Remark", *HEADERS, "Name"])
    (tmp_path / "e.csv").write_text("﻿" + ",".join(HEADERS) + "\n")  # no rows
    (tmp_path / "f.csv").write_text("")
    for size in (40, 1 << 20):
        small_splits(size)
        assert sorted(read(spark, str(tmp_path))) == sorted(tuple(f"{h}-{f}" for h in HEADERS) for f in "abd")
    write(tmp_path / "g.csv", [["x"]], ["Name"])
    with pytest.raises(ValueError, match="g.csv lacks columns"):
        read_leads_csv(spark, str(tmp_path))


def test_no_files_with_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_text("")
    leads = read_leads_csv(spark, str(tmp_path))
    assert leads.count() == 0 and malformed_of(leads).count() == 0


@pytest.mark.parametrize(
    ("line", "inside", "open_"),
    [
        ("a,b", False, False), ('a,"b', False, True), ('a"b,c', False, False), ('"a""', False, True), ('"a"""', False, False),
        ('b",c', True, False), ('b"",c', True, True), ('",",', True, True), ('","', True, True), ('" "x,"', False, True),
        ("", True, True), ("", False, False), ('""', False, False), ('"', True, False), ('a ,"","', False, True),
    ],
)
def test_end_of_a_line(line, inside, open_):
    assert csv_records.ends_inside(line, inside) == open_
