"""CSV records from splits of text: line breaks in quoted cells, files of any size, files of different headers.

Spark cuts text into splits at line ends. Whether a line begins inside a quoted cell depends on all lines before it,
but a split as a whole is a function of two values: inside or not at its begin, inside or not at its end. So one pass
finds that function for every split (and the header of every file), the functions are chained file by file, and a
second pass puts lines together to records. A record that crosses splits comes in pieces, which are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadlake.session import as_path

#: What a row of text is: a record, the end or middle of one that began in an earlier split, the begin of one that
#: does not end in its split.
WHOLE, LATER, BEGUN = 0, 1, 2


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of a line. Only a quote at the begin of a cell opens one; a doubled
    quote inside is data, and what follows a closing quote belongs to the cell up to the comma."""
    at = 0
    if not inside and line.startswith('"'):
        inside, at = True, 1
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        at = line.find(',"', at)
        if at < 0:
            return False
        inside, at = True, at + 2


@dataclass(frozen=True)
class Layout:
    """Header of each file, the splits that begin inside a quoted cell, and the files with records in pieces."""

    headers: dict[str, str]
    inside: frozenset[tuple[str, int]]
    pieced: frozenset[str]


def _lines(spark: SparkSession, paths: str | list[str], are_uris: bool = False) -> DataFrame:
    if are_uris:
        paths = [as_path(spark, p) for p in paths]
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_modification_time").alias("src_time"),
        F.col("_metadata.file_block_start").alias("src_block"),
        "value",
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, split, first row, last row + 1) of the splits in a batch."""
    if not len(batch):
        return
    files, blocks = batch.column("src_file"), batch.column("src_block")
    cuts = [0, len(batch)]
    if len(batch) > 1:
        for column in (files, blocks):
            turns = pc.not_equal(column.slice(1), column.slice(0, len(batch) - 1))
            cuts += (np.flatnonzero(turns.to_numpy(zero_copy_only=False)) + 1).tolist()
    cuts = sorted(set(cuts))
    for low, high in zip(cuts, cuts[1:], strict=False):
        yield files[low].as_py(), blocks[low].as_py(), low, high


def layout(spark: SparkSession, paths: str | list[str]) -> Layout:
    """First pass: one row a split reaches the driver."""

    def scan(batches):
        now, outside, inside, header, open_ = None, False, True, None, False

        def found():
            columns = zip((now[0], now[1], outside, inside, None if open_ else header), kinds.split(", "), strict=True)
            return pa.RecordBatch.from_pydict({kind.split()[0]: [value] for value, kind in columns}, schema)

        for batch in batches:
            quoted = pc.match_substring(batch.column("value"), '"')
            for file, block, low, high in _runs(batch):
                if (file, block) != now:
                    if now is not None:
                        yield found()
                    now, outside, inside, header, open_ = (file, block), False, True, None, False
                at = low
                while block == 0 and at < high and (header is None or open_):
                    text = batch.column("value")[at].as_py()
                    if header is not None or text.strip():
                        header = text if header is None else f"{header}\n{text}"
                        open_ = ends_inside(text, open_)
                    at += 1
                some = np.flatnonzero(quoted.slice(low, high - low).to_numpy(zero_copy_only=False))
                for text in batch.column("value").slice(low, high - low).take(pa.array(some)).to_pylist():
                    outside, inside = ends_inside(text, outside), ends_inside(text, inside)
        if now is not None:
            yield found()

    kinds = "src_file string, src_block long, outside boolean, inside boolean, header string"
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(k.split()[0], types[k.split()[1]]) for k in kinds.split(", ")])
    splits = _lines(spark, paths).select("src_file", "src_block", "value").mapInArrow(scan, kinds).collect()
    headers, inside, pieced, state, file = {}, set(), set(), False, None
    for split in sorted(splits, key=lambda s: (s["src_file"], s["src_block"])):
        if split["src_file"] != file:
            file, state = split["src_file"], False
        if split["src_block"] == 0:
            if split["header"] is None:
                raise ValueError(f"{file} has no header that ends in its first split")
            headers[file] = split["header"].lstrip("﻿").rstrip("\r")
        if state:
            inside.add((file, split["src_block"]))
        state = split["inside"] if state else split["outside"]
        if state:
            pieced.add(file)
    return Layout(headers, frozenset(inside), frozenset(pieced))


def _parts(spark: SparkSession, paths: list[str], found: Layout) -> DataFrame:
    """Second pass: (src_file, src_time, src_block, src_row, part, record) without headers and empty lines."""
    shared = spark.sparkContext.broadcast(found.inside)

    def read(batches):
        now, row, held, held_row, part, header = None, 0, None, 0, WHOLE, False
        for batch in batches:
            values = batch.column("value")
            quoted = pc.match_substring(values, '"').to_numpy(zero_copy_only=False)
            empty = pc.is_in(values, pa.array(["", "\r"], values.type)).to_numpy(zero_copy_only=False)
            rows, parts, records, at = [], [], [], []

            def put(kind, first, text, source):
                rows.append(first)
                parts.append(kind)
                records.append(text)
                at.append(source)

            texts = None
            for file, block, low, high in _runs(batch):
                if (file, block) != now:
                    if held is not None:
                        yield _piece(now_row, part if part == LATER else BEGUN, held_row, held)
                    now, row, header = (file, block), 0, block == 0
                    held, held_row, part = ([], 0, LATER) if now in shared.value else (None, 0, WHOLE)
                now_row = batch.slice(low, 1)
                if held is None and not quoted[low:high].any():
                    # lines without quotes are records as they are
                    some = np.flatnonzero(~empty[low:high])
                    if header and len(some):
                        header, some = False, some[1:]
                    if rows:
                        yield _columns(batch.take(pa.array(at)), rows, parts, records)
                        rows, parts, records, at = [], [], [], []
                    if len(some):
                        lines = batch.take(pa.array(low + some))
                        yield _columns(lines, row + 1 + some, np.full(len(some), WHOLE), lines.column("value"))
                    row += high - low
                    continue
                if texts is None:
                    texts = values.to_pylist()
                for i in range(low, high):
                    text = texts[i]
                    row += 1
                    if held is None and not quoted[i]:
                        if not text or text == "\r":
                            continue
                        if header:
                            header = False
                            continue
                        put(WHOLE, row, text, i)
                        continue
                    inside = held is not None
                    if not inside:
                        held, held_row, part = [], row, WHOLE
                    held.append(text)
                    if not ends_inside(text, inside):
                        if header:
                            header = False
                        else:
                            put(part, held_row, "\n".join(held), i)
                        held, part = None, WHOLE
            if rows:
                yield _columns(batch.take(pa.array(at)), rows, parts, records)
        if held is not None:
            yield _piece(now_row, part if part == LATER else BEGUN, held_row, held)

    kinds = "src_file string, src_time timestamp, src_block long, src_row long, part int, record string"
    return _lines(spark, paths, are_uris=True).mapInArrow(read, kinds)


def _columns(source: pa.RecordBatch, rows, parts, records) -> pa.RecordBatch:
    columns = [source.column(c) for c in ("src_file", "src_time", "src_block")]
    columns += [pa.array(rows, pa.int64()), pa.array(parts, pa.int32())]
    columns.append(records.cast(pa.string()) if isinstance(records, pa.Array) else pa.array(records, pa.string()))
    return pa.RecordBatch.from_arrays(columns, ["src_file", "src_time", "src_block", "src_row", "part", "record"])


def _piece(source: pa.RecordBatch, part: int, row: int, lines: list[str]) -> pa.RecordBatch:
    return _columns(source, [row], [part], ["\n".join(lines)])


def records(spark: SparkSession, paths: list[str], found: Layout) -> DataFrame:
    """(src_file, src_time, src_block, src_row, record) of files of the layout, headers left out. Split and row of its first line
    order the records of a file.

    A quoted cell that is never closed takes the rest of its file into one record, as in any CSV reader.
    """
    parts = _parts(spark, paths, found)
    whole = parts.where(F.col("part") == WHOLE).drop("part")
    crossing = sorted(set(paths) & found.pieced)
    if crossing:
        pieces = _parts(spark, crossing, found).where(F.col("part") != WHOLE)
        # of a split, the end of an earlier record comes before the begin of a later one; two rows a split at most
        in_order = W.partitionBy("src_file").orderBy("src_block", "part")
        begun = F.sum((F.col("part") == BEGUN).cast("int")).over(in_order)
        joined = pieces.withColumn("_record", begun).groupBy("src_file", "_record").agg(
            F.max("src_time").alias("src_time"),
            F.min(F.struct("src_block", "src_row")).alias("_first"),
            F.sort_array(F.collect_list(F.struct("src_block", "part", "record"))).alias("_pieces"),
        )
        text = F.array_join(F.col("_pieces.record"), "\n")
        joined = joined.select("src_file", "src_time", "_first.src_block", "_first.src_row", text.alias("record"))
        whole = whole.unionByName(joined)
    return whole.withColumn("record", F.regexp_replace("record", "\r$", ""))
