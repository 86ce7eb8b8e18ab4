"""Benchmark decontamination with a positional inverted index.

The corpus is indexed in segments of whole documents, as Spark tasks read it: a segment stores, for each of its
terms, the positions of all occurrences, counted through the segment with a gap between documents, so one number
tells document and place. Nothing is shuffled to build it, and a very common word is only a long list in each
segment. A search reads the lists of its own terms; in each segment it takes the list of a phrase's rarest term,
shifts it by the term's place in the phrase, and intersects it with the shifted lists of the next rarest terms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.llm.arrow_text import blocks_of, text_bytes
from leadlake.llm.common import Scratch, arrow_column, tidy
from leadlake.llm.words import LOWERED, word_hashes, word_spans

#: Fixed value: bytes of words are digits, letters and all that is not ASCII; A-Z are lower-cased before.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
WORD_BYTES[0x80:] = True


@dataclass(frozen=True)
class Settings:
    #: Consecutive words of a benchmark window.
    window: int = 10
    #: Text in a segment of the index.
    segment_bytes: int = 8 << 20
    #: Words of benchmark items that are searched, and so broadcast, at once.
    block_words: int = 1_000_000


@dataclass(frozen=True)
class Index:
    """`segments` (segment, ids, words): ids of the documents in order (packed), words of each.
    `postings` (segment, term, n, gaps): occurrences of a term, as steps between positions."""

    segments: DataFrame
    postings: DataFrame


def positions_of(counts: np.ndarray) -> np.ndarray:
    """Position of each document's first word: one place between documents stays free."""
    return np.cumsum(counts) - counts + np.arange(len(counts))


def term_lists(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, pa.Array]:
    """Words of each text; and of each different word: itself, its occurrences, and the steps between them."""
    data = LOWERED[data]
    begins, ends = word_spans(data, offsets, WORD_BYTES)
    counts = np.diff(np.searchsorted(begins, offsets))
    place = np.arange(len(begins)) + np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(word_hashes(data, begins, ends), kind="stable")
    begins, ends, place = begins[order], ends[order], place[order]
    # equal hashes stand together; words that differ all the same start a list of their own
    sizes = ends - begins
    new = np.ones(len(order), bool)
    new[1:] = sizes[1:] != sizes[:-1]
    open_, k = np.flatnonzero(~new), 0
    while len(open_):
        same = data[begins[open_] + k] == data[begins[open_ - 1] + k]
        new[open_[~same]] = True
        k += 1
        open_ = open_[same]
        open_ = open_[sizes[open_] > k]
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(order)))
    steps = np.diff(place, prepend=0)
    steps[first] = place[first]
    widths = sizes[first]
    at = np.arange(widths.sum()) - np.repeat(np.cumsum(widths) - widths, widths) + np.repeat(begins[first], widths)
    return counts, _binary(data[at], widths), n, _binary(steps.astype(np.uint32).view(np.uint8), 4 * n)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values of the given sizes, one after the other in `data`."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers).cast(pa.binary())


def build_index(
    docs: DataFrame, keep: Scratch, settings: Settings, *, id_col: str = "doc_id", text_col: str = "text"
) -> Index:
    """Index every word of every document. Segments and postings are written in one pass over the texts."""
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids_type = T.ArrayType(id_type)

    def index(batches):
        for table in blocks_of(batches, "text", settings.segment_bytes):
            name = uuid4().hex
            counts, terms, n, gaps = term_lists(*text_bytes(table.column("text")))
            ids = table.column("id").combine_chunks()
            ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name]),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([counts.astype(np.int64).tobytes()], pa.binary()),
                    pa.nulls(1, pa.binary()),
                    pa.nulls(1, pa.int64()),
                    pa.nulls(1, pa.binary()),
                ],
                ["segment", "ids", "words", "term", "n", "gaps"],
            )
            for at in range(0, len(terms), 20_000):
                some = slice(at, at + 20_000)
                m = len(terms[some])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name]).take(pa.array(np.zeros(m, np.int32))),
                        pa.nulls(m, pa.list_(ids.type)),
                        pa.nulls(m, pa.binary()),
                        terms[some],
                        pa.array(n[some], pa.int64()),
                        gaps[some],
                    ],
                    ["segment", "ids", "words", "term", "n", "gaps"],
                )

    schema = T.StructType.fromDDL("segment string")
    schema = schema.add("ids", ids_type).add("words", "binary").add("term", "binary").add("n", "long").add("gaps", "binary")
    path = keep.write(rows.mapInArrow(tidy(index), schema), "index")
    scan = lambda: docs.sparkSession.read.schema(schema).parquet(path)
    return Index(
        scan().where("term is null").select("segment", "ids", "words"),
        scan().where("term is not null").select("segment", "term", "n", "gaps"),
    )


# ---------------------------------------------------------------- search in one segment


def phrase_starts(lists: Sequence[np.ndarray]) -> np.ndarray:
    """Positions at which the words with these occurrence lists follow one another."""
    rarest = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    found = lists[rarest[0]] - rarest[0]
    for k in rarest[1:]:
        if not len(found):
            break
        other = lists[k] - k
        at = np.minimum(np.searchsorted(other, found), len(other) - 1)
        found = found[other[at] == found]
    return found


def proximity_spans(lists: Sequence[np.ndarray], span: int, firsts: np.ndarray) -> list[tuple[int, int]]:
    """Least stretches of at most `span` words of one document that hold all words, as often as they are given
    (equal words have one and the same list). `firsts`: first positions of the documents."""
    times: dict[int, int] = {}
    for words in lists:
        times[id(words)] = times.get(id(words), 0) + 1
    own = {id(words): words for words in lists}
    starts = np.unique(np.concatenate(list(own.values())))
    ends = starts.copy()
    for key, words in own.items():
        at = np.searchsorted(words, starts) + times[key] - 1
        last = np.where(at < len(words), words[np.minimum(at, len(words) - 1)], np.iinfo(np.int64).max)
        ends = np.maximum(ends, last)
    near = (ends - starts < span) & (ends != np.iinfo(np.int64).max)
    near &= np.searchsorted(firsts, starts, side="right") == np.searchsorted(firsts, ends, side="right")
    starts, ends = starts[near], ends[near]
    least = np.append(ends[1:] > ends[:-1], True) if len(ends) else near[:0]
    return list(zip(starts[least].tolist(), (ends[least] + 1).tolist(), strict=True))


def merged(begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs covered by stretches of `length` from sorted begins."""
    cut = np.flatnonzero(np.diff(begins) > length) + 1
    edges = np.concatenate([[0], cut, [len(begins)]])
    return begins[edges[:-1]], begins[edges[1:] - 1] + length


def item_words(text: str | None) -> list[bytes]:
    data, offsets = text_bytes(pa.array([text], pa.string()))
    data = LOWERED[data]
    buffer = data.tobytes()
    return [buffer[a:b] for a, b in zip(*(x.tolist() for x in word_spans(data, offsets, WORD_BYTES)), strict=True)]


def item_windows(words: list[bytes], size: int) -> list[list[bytes]]:
    size = min(size, len(words))
    return [words[i : i + size] for i in range(len(words) - size + 1)] if size else []


def _item_blocks(items: DataFrame, id_col: str, text_col: str, settings: Settings):
    """Lists of (id, words), of a bounded number of words: the stated query set passes in blocks."""
    held, n = [], 0
    for row in items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).toLocalIterator():
        words = item_words(row["text"])
        if not words:
            continue
        held.append((row["id"] if row["id"] is not None else "null", words))
        n += len(words)
        if n >= settings.block_words:
            yield held
            held, n = [], 0
    if held:
        yield held


def _search(index: Index, items: list[tuple[str, list[bytes]]], find, schema: str):
    """`find(lists, items, firsts)` over the postings of the items' terms, segment by segment: the hits, and the
    broadcast that they need until they are written."""
    spark = index.postings.sparkSession
    terms = spark.createDataFrame([(bytearray(t),) for t in sorted({w for _, ws in items for w in ws})], "term binary")
    shared = spark.sparkContext.broadcast(items)

    def in_segment(segments: pa.Table, postings: pa.Table) -> pa.Table:
        lists = {
            term.as_py(): np.cumsum(np.frombuffer(gaps.as_buffer(), np.uint32).astype(np.int64))
            for term, gaps in zip(postings.column("term"), postings.column("gaps"), strict=True)
        }
        name = segments.column("segment")[0].as_py()
        counts = np.frombuffer(segments.column("words")[0].as_buffer(), np.int64)
        firsts = positions_of(counts)
        rows = [] if not lists else find(lists, shared.value, firsts)
        columns = [np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)]
        row = np.searchsorted(firsts, columns[0], side="right") - 1
        return pa.table(
            {
                "segment": pa.array([name] * len(rows), pa.string()),
                "row": pa.array(row, pa.int64()),
                "item_id": pa.array([r[0] for r in rows], pa.string()),
                "begin": pa.array(columns[0] - firsts[row], pa.int64()),
                "end": pa.array(columns[1] - firsts[row], pa.int64()),
            }
        )

    own = index.postings.join(F.broadcast(terms), "term").select("segment", "term", "gaps")
    found = (
        index.segments.select("segment", "words")
        .groupBy("segment")
        .cogroup(own.groupBy("segment"))
        .applyInArrow(in_segment, schema)
    )
    return found, shared


HIT = "segment string, row long, item_id string, begin long, end long"


def phrase_hits(
    index: Index, items: DataFrame, settings: Settings, *, id_col: str = "item_id", text_col: str = "text", keep=None
) -> DataFrame:
    """(segment, row, item_id, begin, end): runs of words covered by an item's windows, for each document of the
    index (row: its place in the segment). Null texts and texts without a word are no items. With `keep` the hits of
    a block of items are written before the next block is drawn; else all blocks are held until the result is used."""

    def find(lists, wanted, firsts):
        del firsts
        rows = []
        for item_id, words in wanted:
            starts = []
            for window in item_windows(words, settings.window):
                if all(w in lists for w in window):
                    starts.append(phrase_starts([lists[w] for w in window]))
            starts = np.unique(np.concatenate(starts)) if starts else ()
            if len(starts):
                begins, ends = merged(starts, min(settings.window, len(words)))
                rows += [(item_id, a, b) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        return rows

    return _all_blocks(index, items, find, settings, id_col, text_col, keep)


def proximity_hits(
    index: Index, items: DataFrame, span: int, settings: Settings, *, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """Like `phrase_hits`, for all words of an item in any order within `span` words of one document."""

    def find(lists, wanted, firsts):
        rows = []
        for item_id, words in wanted:
            if all(w in lists for w in words):
                rows += [(item_id, a, b) for a, b in proximity_spans([lists[w] for w in words], span, firsts)]
        return rows

    return _all_blocks(index, items, find, settings, id_col, text_col)


def _all_blocks(index, items, find, settings, id_col, text_col, keep: Scratch | None = None) -> DataFrame:
    spark, path, hits = index.segments.sparkSession, keep and keep.folder("hits"), None
    for block in _item_blocks(items, id_col, text_col, settings):
        found, shared = _search(index, block, find, HIT)
        if keep:
            found.write.mode("append").parquet(path, compression="zstd")
            shared.destroy()
            found = spark.read.schema(HIT).parquet(path)
        hits = found if hits is None or keep else hits.unionByName(found)
    return spark.createDataFrame([], HIT) if hits is None else hits


def contamination(
    docs: DataFrame,
    items: DataFrame,
    keep: Scratch,
    settings: Settings | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row of `docs`: id, n_words, n_hit (words inside a window of an item), n_items, items_sha256 (of the ids,
    sorted as strings and joined by commas), item_ids, contaminated.

    Null, empty and wordless texts have no words and no hits. Repeated rows are judged one by one; null ids stay
    null. Repeated item ids count once. Other columns are not read. An empty table gives no rows, and without
    items nothing is contaminated. Intermediate tables go to `keep`; the result is lazy and reads them.
    """
    settings = settings or Settings()
    index = build_index(docs, keep, settings, id_col=id_col, text_col=text_col)
    hits = phrase_hits(index, items, settings, id_col=item_id_col, text_col=item_text_col, keep=keep)

    def judge(segments: pa.Table, found: pa.Table) -> pa.Table:
        counts = np.frombuffer(segments.column("words")[0].as_buffer(), np.int64)
        firsts = positions_of(counts)
        row = found.column("row").to_numpy()
        a, b = (firsts[row] + found.column(c).to_numpy() for c in ("begin", "end"))
        change = np.zeros(int(firsts[-1] + counts[-1]) + 2 if len(counts) else 1, np.int64)
        np.add.at(change, a, 1)
        np.add.at(change, b, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(change) > 0)])
        n_hit = covered[firsts + counts] - covered[firsts]
        names: list[set[str]] = [set() for _ in counts]
        for r, name in zip(row.tolist(), found.column("item_id").to_pylist(), strict=True):
            names[r].add(name)
        named = [sorted(n) for n in names]
        ids = pa.concat_arrays([c.flatten() for c in segments.column("ids").chunks])
        return pa.table(
            {
                "id": ids,
                "n_words": pa.array(counts, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "n_items": pa.array([len(n) for n in named], pa.int64()),
                "items_sha256": pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in named]),
                "item_ids": pa.array(named, pa.list_(pa.string())),
                "contaminated": pa.array(n_hit > 0, pa.bool_()),
            }
        )

    result = T.StructType().add("id", docs.schema[id_col].dataType)
    for field in T.StructType.fromDDL(
        "n_words long, n_hit long, n_items long, items_sha256 string, item_ids array<string>, contaminated boolean"
    ):
        result = result.add(field)
    judged = index.segments.groupBy("segment").cogroup(hits.groupBy("segment")).applyInArrow(judge, result)
    return judged.withColumnRenamed("id", id_col)
