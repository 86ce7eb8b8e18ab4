"""Removal of byte strings that an earlier document holds, by suffix order over shards of shared text.

A string of `length` bytes is removed from a document if it also starts in a document with a smaller id. Every
window of `length` bytes has an anchor, the least hash of the seeds in it, so equal windows have equal anchors.
Anchors that occur once in the corpus rule their windows out; around the others the text is cut into segments,
and segments of one range of anchors form a shard. A shard's different segments are put in suffix order by
external induced sorting; neighbours that share `length` bytes are equal windows, and the smallest id among them
goes back to the blocks of documents that sent the segments.

A segment that is the only different one of its anchor in all blocks has no window in common with another: its
smallest id holds for all of its windows, and only the others are put in order.

An anchor with more than `hot_segments` different segments (a byline between texts of every document's own) would
fill one shard. Its segments are cut to single windows, and a hash of the window takes the anchor's place: equal
windows still meet, different ones spread over all shards.

Nothing is sent by document: a block sends each anchor and each different segment once, with the smallest id, so
a passage that a third of all documents share costs one row a block.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.llm.arrow_text import blocks_of, pack, text_bytes, unpack
from leadlake.llm.common import Scratch, arrow_column, tidy
from leadlake.llm.external_suffix import MEMORY_ITEMS, Workspace, suffixes_with_prefixes
from leadlake.llm.words import mixed, word_hashes

#: Bytes of a seed, whose hash makes it an anchor.
SEED = 20
#: Windows of one segment at most.
MOST_WINDOWS = 256
#: Positions that are hashed at once.
HASHED = 1 << 14
#: Odd numbers of the hash.
FACTOR, MIXER = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
NO_ID = np.iinfo(np.int64).max

#: Result columns beside those of the input.
RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
#: The same with the rest as text.
TEXT_RESULT = RESULT.replace("kept binary", "kept string")


@dataclass(frozen=True)
class Settings:
    length: int = 50
    #: Text in a block of documents, and corpus text for each shard.
    block_bytes: int = 4 << 20
    shard_bytes: int = 3 << 20
    #: Different segments, added up over blocks, that one anchor may bring to its shard before it is split by windows.
    hot_segments: int = 1 << 17
    #: Tuples of the sort kept in memory before disk is used.
    memory_items: int = MEMORY_ITEMS


# ---------------------------------------------------------------- anchors


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes from each position on: of 1, 2, 4 ... bytes, and of those that make up SEED."""

    def joined(a, b, a_bytes: int, b_bytes: int):
        n = len(b) - a_bytes
        return a[:n] * np.uint64(pow(FACTOR, b_bytes, 1 << 64)) + b[a_bytes : a_bytes + n]

    h, width = data.astype(np.uint64) + np.uint64(1), 1
    whole, done = None, 0
    while True:
        if SEED & width:
            whole = h if whole is None else joined(h, whole, width, done)
            done += width
        if 2 * width > SEED:
            break
        h = joined(h, h, width, width)
        width *= 2
    whole = whole ^ (whole >> np.uint64(29))
    whole *= np.uint64(MIXER)
    return whole ^ (whole >> np.uint64(32))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[: len(values) - step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of texts that lie one after the other: first window, number of windows, anchor.

    Windows of a segment follow one another in one text and have one anchor.
    """
    begins, ends = offsets[:-1], offsets[1:] - length + 1
    full = ends > begins
    begins, ends = begins[full], ends[full]
    cuts, values = [], []
    last = None
    for at in range(0, max(0, len(data) - length + 1), HASHED):
        lowest = window_minima(seed_hashes(data[at : at + HASHED + length - 1]), length - SEED + 1)
        changed = np.flatnonzero(lowest[1:] != lowest[:-1]) + 1
        if last is None or lowest[0] != last:
            changed = np.concatenate([[0], changed])
        first, last = lowest[changed], lowest[-1]
        cuts.append(changed + at)
        values.append(first)
    if not len(begins):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    cuts, values = np.concatenate(cuts), np.concatenate(values)
    start = np.concatenate([cuts, begins, ends])
    start.sort(kind="stable")  # three sorted runs
    start = start[np.append(True, start[1:] != start[:-1])]
    text = np.searchsorted(begins, start, side="right") - 1
    inside = (text >= 0) & (start < ends[np.maximum(text, 0)])
    windows = np.diff(np.append(start, start[-1]))[inside]
    start = start[inside]
    anchor = values[np.searchsorted(cuts, start, side="right") - 1]
    pieces = -(-windows // MOST_WINDOWS)
    if (pieces > 1).any():
        which = np.repeat(np.arange(len(start)), pieces)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = start[which] + nth * MOST_WINDOWS
        windows = np.minimum(windows[which] - nth * MOST_WINDOWS, MOST_WINDOWS)
        anchor = anchor[which]
    return start, windows, mixed(anchor)  # least hashes crowd at the low end; shards are ranges of equal size


def window_hashes(data: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` bytes from each start on."""
    whole = np.zeros(len(start), np.uint64)
    for k in range(length):
        whole = whole * np.uint64(FACTOR) + data[start + k].astype(np.uint64) + np.uint64(1)
    return mixed(whole)


def shard_of(anchors: np.ndarray, shards: int) -> np.ndarray:
    """Shard by range, so sorted anchors are in the order of their shards."""
    return ((anchors >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def runs_of(shard: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The shards of sorted numbers, and where each begins and ends: as many as there are, however many could be."""
    if not len(shard):
        return shard, []
    begins = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    return shard[begins], list(zip(begins.tolist(), [*begins[1:].tolist(), len(shard)], strict=True))


# ---------------------------------------------------------------- one block of documents


class Block:
    """Rows of a block with their segments."""

    def __init__(self, packed, id_col: str, text_col: str, settings: Settings):
        self.rows = unpack(packed)
        self.data, self.offsets = text_bytes(self.rows.column(text_col))
        ids = self.rows.column(id_col).cast(pa.int64()).fill_null(NO_ID)
        self.ids = ids.to_numpy().astype(np.int64)
        self.length = settings.length
        self.start, self.windows, self.anchor = segments_of(self.data, self.offsets, settings.length)
        self.row = np.searchsorted(self.offsets, self.start, side="right") - 1

    def in_order(self) -> tuple[np.ndarray, np.ndarray]:
        """Segments in the order of their anchors, and which of them begin another anchor."""
        order = np.argsort(self.anchor)
        anchor = self.anchor[order]
        return order, np.append(True, anchor[1:] != anchor[:-1])[: len(order)]

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different anchors in order, which of them occur in two of the rows, and their numbers of different segments."""
        order, first = self.in_order()
        begin, row = np.flatnonzero(first), self.row[order]
        if not len(begin):
            return self.anchor[:0], np.empty(0, bool), np.empty(0, np.int64)
        twice = np.minimum.reduceat(row, begin) != np.maximum.reduceat(row, begin)
        return self.anchor[order[begin]], twice, self.variety(order, np.diff(np.append(begin, len(order))))

    def variety(self, order: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Different segments of each anchor; `sizes`: its segments, in `order`."""
        several = np.repeat(sizes > 1, sizes)
        different = np.ones(len(sizes), np.int64)
        if several.any():
            # spans are hashed in the order of the text, and only those of anchors that occur again
            number = np.empty(len(order), np.int64)
            number[order] = np.repeat(np.arange(len(sizes)), sizes)
            at = np.sort(order[several])
            span = word_hashes(self.data, self.start[at], self.start[at] + self.windows[at] + self.length - 1)
            number = number[at]
            ranks = np.lexsort((span, number))
            span, number = span[ranks], number[ranks]
            new = np.append(True, (span[1:] != span[:-1]) | (number[1:] != number[:-1]))
            different = np.maximum(1, np.bincount(number[new], minlength=len(sizes)))
        return different

    def restrict(self, flags: bytes, hot: bytes) -> None:
        """Keep the segments whose anchor is marked, and cut those of hot anchors to windows. `flags` are bits by
        different anchor in order, `hot` the numbers of hot ones."""
        order, first = self.in_order()
        number = np.cumsum(first) - 1
        shared = np.unpackbits(np.frombuffer(flags, np.uint8), count=int(first.sum())).astype(bool) if flags else ~first[first]
        keep = np.empty(len(order), bool)
        keep[order] = shared[number]
        heavy = np.zeros(len(shared), bool)
        heavy[np.frombuffer(hot, np.uint32)] = True
        cut = np.empty(len(order), bool)
        cut[order] = heavy[number]
        cut = cut[keep]
        self.start, self.windows, self.anchor, self.row = (
            x[keep] for x in (self.start, self.windows, self.anchor, self.row)
        )
        if cut.any():
            self.to_windows(cut)

    def to_windows(self, cut: np.ndarray) -> None:
        """Segments of one window each instead of the marked ones, with the hash of the window for an anchor."""
        count = self.windows[cut]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = np.repeat(self.start[cut], count) + within
        row = np.repeat(self.row[cut], count)
        made = (start, np.ones_like(start), window_hashes(self.data, start, self.length), row)
        held = (self.start, self.windows, self.anchor, self.row)
        self.start, self.windows, self.anchor, self.row = (
            np.concatenate([old[~cut], new]) for old, new in zip(held, made, strict=True)
        )

    def different(self, shards: int) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Of each segment the number of its text; of each text: itself, its windows, its smallest id, its shard.
        Texts are numbered shard by shard."""
        number, seen, ids = np.empty(len(self.start), np.int64), {}, []
        buffer = self.data.tobytes()
        ends = (self.start + self.windows + self.length - 1).tolist()
        shard = shard_of(self.anchor, shards)
        owner = self.ids[self.row].tolist()
        firsts = []
        for i, (a, b) in enumerate(zip(self.start.tolist(), ends, strict=True)):
            n = seen.setdefault(buffer[a:b], len(seen))
            number[i] = n
            if n == len(ids):
                ids.append(owner[i])
                firsts.append(i)
            elif owner[i] < ids[n]:
                ids[n] = owner[i]
        firsts = np.array(firsts, np.int64)
        order = np.argsort(shard[firsts], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        texts = list(seen)
        firsts = firsts[order]
        return (
            place[number] if len(order) else number,
            [texts[i] for i in order],
            self.windows[firsts],
            np.array(ids, np.int64)[order],
            shard[firsts].astype(np.int64),
        )

    def removed(self, number: np.ndarray, windows: np.ndarray, holder: np.ndarray) -> np.ndarray:
        """Bytes to remove. `holder`: smallest id for each window of the different texts, one after the other."""
        size = len(self.data) + 1
        if not len(self.start):
            return np.zeros(size - 1, bool)
        begins, owner = np.cumsum(windows) - windows, self.ids[self.row]
        least, greatest = (f.reduceat(holder, begins)[number] for f in (np.minimum, np.maximum))
        whole = greatest < owner  # all windows go: the segment goes from its first byte to its last
        start = self.start[whole]
        change = np.zeros(size, np.int32)
        np.add.at(change, start, 1)
        np.add.at(change, start + self.windows[whole] + self.length - 1, -1)
        partly = np.flatnonzero(~whole & (least < owner))
        for at in range(0, len(partly), 1 << 12):
            some = partly[at : at + (1 << 12)]
            count = self.windows[some]
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            smaller = holder[np.repeat(begins[number[some]], count) + within] < np.repeat(owner[some], count)
            first = (np.repeat(self.start[some], count) + within)[smaller]
            np.add.at(change, first, 1)
            np.add.at(change, first + self.length, -1)
        return np.cumsum(change[:-1], dtype=np.int32) > 0


# ---------------------------------------------------------------- one shard


def first_anchors(texts: list[bytes], length: int) -> np.ndarray:
    """The anchor of the first window of each text, before `mixed`."""
    begins = np.cumsum([0, *map(len, texts)])[:-1]
    data, width = np.frombuffer(b"".join(texts), np.uint8), length - SEED + 1
    found = np.empty(len(texts), np.uint64)
    for at in range(0, len(data), HASHED):
        here = slice(*np.searchsorted(begins, [at, at + HASHED]))
        if here.stop > here.start:
            lowest = window_minima(seed_hashes(data[at : at + HASHED + length - 1]), width)
            found[here] = lowest[begins[here] - at]
    return found


def first_holders(texts: list[bytes], ids: np.ndarray, settings: Settings) -> np.ndarray:
    """For each window of the texts, one after the other: the smallest id of a text that holds it. The texts are
    different segments, so all windows of one have one anchor, and those of other anchors hold none of them."""
    _, number, times = np.unique(first_anchors(texts, settings.length), return_inverse=True, return_counts=True)
    several = times[number] > 1
    windows = np.array([len(t) for t in texts], np.int64) - settings.length + 1
    holder = np.repeat(ids, windows)
    if several.any():
        some = [texts[i] for i in np.flatnonzero(several).tolist()]
        holder[np.repeat(several, windows)] = holders_in_order(some, ids[several], settings)
    return holder


def holders_in_order(texts: list[bytes], ids: np.ndarray, settings: Settings) -> np.ndarray:
    """The same of texts that may share windows, by suffix order."""
    length = settings.length
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    letters = np.frombuffer(b"\0".join([*texts, b"", b""])[: ends[-1] + 1], np.uint8).astype(np.uint16)
    letters += 2
    letters[ends - 1], letters[-1] = 1, 0
    work = Workspace(settings.memory_items)
    try:
        string = work.keep(letters)
        text_at = work.keep(np.repeat(np.arange(len(texts), dtype=np.int32), sizes + 1))
        best = np.full(ends[-1], NO_ID, np.int64)
        open_positions, open_id = [], NO_ID

        def close():
            for some in open_positions:
                best[some] = open_id

        def take(position, common):
            nonlocal open_positions, open_id
            inside = position < ends[-1]
            position, common = position[inside], common[inside]
            owner = text_at[position]
            full = ends[owner] - 1 - position >= length
            position, common, holder = position[full], common[full], ids[owner[full]]
            starts = np.flatnonzero(common < length)
            head = starts[0] if len(starts) else len(position)
            if head:
                open_positions.append(position[:head])
                open_id = min(open_id, int(holder[:head].min()))
            if not len(starts):
                return
            close()
            least = np.minimum.reduceat(holder, starts)
            best[position[head:]] = np.repeat(least, np.diff(np.append(starts, len(position))))
            open_positions, open_id = [position[starts[-1] :]], int(least[-1])

        suffixes_with_prefixes(string, 258, take, work, length)
        close()
        inside = np.ones(ends[-1], bool)
        inside[(ends - 1)[:, None] - np.arange(length)] = False
        return best[inside]
    finally:
        work.close()


# ---------------------------------------------------------------- the jobs


def remove_repeats(
    docs: DataFrame,
    keep: Scratch,
    settings: Settings | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    as_text: bool = False,
) -> DataFrame:
    """`docs` with RESULT columns: bytes of the text, bytes and maximal runs removed, SHA-256 and bytes of the rest.
    With `as_text` the rest is a string, and a character that lost some of its bytes goes as a whole.

    A column of the input with the name of a result column is replaced by it. Null and empty texts have no bytes.
    Rows of one id never remove each other's text, a row without an id counts as the last one, so repeated rows
    all stay as they are. Texts under `length` bytes stay whole. Strings are judged on the input, overlaps count,
    and no string crosses documents. An empty table gives no rows. Intermediate tables go to `keep`; the result
    is lazy and reads them.
    """
    settings = settings or Settings()
    ordered = [c for c in docs.columns]

    def to_blocks(batches):
        for rows in blocks_of(batches, text_col, settings.block_bytes):
            n = int(text_bytes(rows.column(text_col))[1][-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid4().int >> 65], pa.int64()), pa.array([n], pa.int64()), pa.array([pack(rows)], pa.binary())],
                ["block", "n", "rows"],
            )

    blocks = keep(docs.select(*[F.col(f"`{c}`") for c in ordered]).mapInArrow(tidy(to_blocks), "block long, n long, rows binary"), "blocks")
    total = blocks.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // settings.shard_bytes))
    read = lambda packed: Block(packed.as_buffer(), id_col, text_col, settings)

    def send_anchors(batches):
        for batch in batches:
            for block, packed in zip(arrow_column(batch, "block"), arrow_column(batch, "rows"), strict=True):
                anchors, twice, different = read(packed).anchors()
                full, cuts = runs_of(shard_of(anchors, shards))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array([block.as_py()] * len(full), pa.int64()),
                        pa.array([anchors[a:b].tobytes() for a, b in cuts], pa.binary()),
                        pa.array([np.packbits(twice[a:b]).tobytes() for a, b in cuts], pa.binary()),
                        pa.array([several(different[a:b]) for a, b in cuts], pa.binary()),
                    ],
                    ["shard", "block", "anchors", "twice", "several"],
                )

    def several(different: np.ndarray) -> bytes:
        """Places and numbers of more than one segment: few anchors have them."""
        at = np.flatnonzero(different > 1)
        return np.concatenate([at, different[at]]).astype(np.uint32).tobytes()

    def find_shared(rows: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("anchors")]
        sizes = [len(x) for x in lists]
        anchors = np.concatenate(lists)
        order = np.argsort(anchors, kind="stable")
        different = np.ones(len(anchors), np.int64)
        for x, begin in zip(rows.column("several"), (np.cumsum(sizes) - sizes).tolist(), strict=True):
            at, n = np.frombuffer(x.as_buffer(), np.uint32).reshape(2, -1).astype(np.int64)
            different[begin + at] = n
        same = anchors[order][1:] == anchors[order][:-1]
        shared = np.zeros(len(anchors), bool)
        shared[order[1:][same]] = shared[order[:-1][same]] = True
        twice = [
            np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n).astype(bool)
            for x, n in zip(rows.column("twice"), sizes, strict=True)
        ]
        # an anchor that occurs twice in one block and nowhere else has to be marked there only
        shared |= np.concatenate(twice)
        cut = np.split(shared, np.cumsum(sizes)[:-1])
        flags = [np.packbits(c).tobytes() for c in cut]
        begins = np.flatnonzero(np.append(True, ~same))
        heavy = np.add.reduceat(different[order], begins) > settings.hot_segments
        hot = np.zeros(len(anchors), bool)
        if heavy.any():
            hot[order] = np.repeat(heavy, np.diff(np.append(begins, len(anchors))))
            hot &= shared
        hot = [np.flatnonzero(c).astype(np.uint32).tobytes() for c in np.split(hot, np.cumsum(sizes)[:-1])]
        return pa.table(
            {
                "shard": rows.column("shard"),
                "block": rows.column("block"),
                "n": pa.array(sizes, pa.int32()),
                "shared": pa.array(flags, pa.binary()),
                "hot": pa.array(hot, pa.binary()),
            }
        )

    def by_block(df: DataFrame, *columns: str) -> DataFrame:
        """One row per block: what its shards say, in their order; bounded by the block's size."""
        return df.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", *columns))).alias("said"))

    anchors = blocks.mapInArrow(tidy(send_anchors), "shard int, block long, anchors binary, twice binary, several binary")
    flags = anchors.groupBy("shard").applyInArrow(find_shared, "shard int, block long, n int, shared binary, hot binary")

    def shared_of(said) -> np.ndarray:
        parts = [np.unpackbits(np.frombuffer(x["shared"], np.uint8), count=x["n"]) for x in said or ()]
        return np.concatenate(parts).astype(bool) if parts else np.empty(0, bool)

    def hot_of(said) -> bytes:
        """Numbers of hot anchors among all of the block's."""
        sizes = np.array([x["n"] for x in said or ()], np.int64)
        begins = (np.cumsum(sizes) - sizes).astype(np.uint32)
        return b"".join((np.frombuffer(x["hot"], np.uint32) + b).tobytes() for x, b in zip(said or (), begins, strict=True))

    def send_segments(batches):
        for batch in batches:
            columns = (arrow_column(batch, c) for c in ("block", "rows", "said"))
            for name, packed, said in zip(*columns, strict=True):
                block = read(packed)
                said = said.as_py()
                shared, hot = np.packbits(shared_of(said)).tobytes(), hot_of(said)
                block.restrict(shared, hot)
                _, texts, windows, ids, shard = block.different(shards)
                full, cuts = runs_of(shard)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array([name.as_py()] * len(full), pa.int64()),
                        pa.array([windows[a:b].astype(np.uint16).tobytes() for a, b in cuts], pa.binary()),
                        pa.array([ids[a:b].tobytes() for a, b in cuts], pa.binary()),
                        pa.array([b"".join(texts[a:b]) for a, b in cuts], pa.binary()),
                        pa.array([shared if a == 0 else b"" for a, _ in cuts], pa.binary()),
                        pa.array([hot if a == 0 else b"" for a, _ in cuts], pa.binary()),
                    ],
                    ["shard", "block", "windows", "ids", "texts", "shared", "hot"],
                )

    def answer(rows: pa.Table) -> pa.Table:
        seen, ids, numbers = {}, [], []
        for windows, owners, data in zip(*(rows.column(c) for c in ("windows", "ids", "texts")), strict=True):
            ends = np.cumsum(np.frombuffer(windows.as_buffer(), np.uint16).astype(np.int64) + settings.length - 1)
            data, mine, a = data.as_py(), [], 0
            for b, owner in zip(ends.tolist(), np.frombuffer(owners.as_buffer(), np.int64).tolist(), strict=True):
                n = seen.setdefault(data[a:b], len(seen))
                if n == len(ids):
                    ids.append(owner)
                elif owner < ids[n]:
                    ids[n] = owner
                mine.append(n)
                a = b
            numbers.append(np.array(mine, np.int64))
        texts = list(seen)
        del seen
        holder = first_holders(texts, np.array(ids, np.int64), settings)
        windows = np.array([len(t) for t in texts], np.int64) - settings.length + 1
        begins = np.cumsum(windows) - windows
        # runs of windows with one holder
        new = np.ones(len(holder), bool)
        new[1:] = holder[1:] != holder[:-1]
        new[begins] = True
        run_at = np.flatnonzero(new)
        run_holder = holder[run_at]
        run_windows = np.diff(np.append(run_at, len(holder)))
        runs = np.add.reduceat(new, begins, dtype=np.int64)
        run_begins = np.cumsum(runs) - runs
        counts, lengths, holders = [], [], []
        for mine in numbers:
            count = runs[mine]
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            which = np.repeat(run_begins[mine], count) + within
            counts.append(count.astype(np.uint16).tobytes())
            lengths.append(run_windows[which].astype(np.uint16).tobytes())
            holders.append(run_holder[which].tobytes())
        return pa.table(
            {
                "shard": rows.column("shard"),
                "block": rows.column("block"),
                "lengths": pa.array(lengths, pa.binary()),
                "holders": pa.array(holders, pa.binary()),
                "shared": rows.column("shared"),
                "hot": rows.column("hot"),
            }
        )

    segments = blocks.join(by_block(flags, "n", "shared", "hot"), "block", "left").mapInArrow(
        tidy(send_segments), "shard int, block long, windows binary, ids binary, texts binary, shared binary, hot binary"
    )
    answers = segments.groupBy("shard").applyInArrow(
        answer, "shard int, block long, lengths binary, holders binary, shared binary, hot binary"
    )

    results = T.StructType.fromDDL(TEXT_RESULT if as_text else RESULT)
    kept_fields = [f for f in docs.schema.fields if f.name not in results.names]

    def cut(batches):
        for batch in batches:
            for packed, said in zip(arrow_column(batch, "rows"), arrow_column(batch, "said"), strict=True):
                block, said = read(packed), said.as_py() or []
                block.restrict(*(b"".join(x[c] for x in said) for c in ("shared", "hot")))
                number, _, windows, _, _ = block.different(shards)
                lengths = np.frombuffer(b"".join(x["lengths"] for x in said), np.uint16)
                holders = np.frombuffer(b"".join(x["holders"] for x in said), np.int64)
                gone = block.removed(number, windows, np.repeat(holders, lengths))
                yield from result_rows(block, gone)

    def result_rows(block: Block, gone: np.ndarray):
        begins, sizes = block.offsets[:-1], np.diff(block.offsets)
        removed = np.concatenate([[0], np.cumsum(gone, dtype=np.int32)])
        rises = gone.copy()
        rises[1:] &= ~gone[:-1]
        inner = begins[begins < len(gone)]
        rises[inner] = gone[inner]
        spans = np.concatenate([[0], np.cumsum(rises, dtype=np.int32)])
        left = block.data[~gone].tobytes()
        n_removed = removed[block.offsets[1:]] - removed[begins]
        ends = np.cumsum(sizes - n_removed)
        kept = [left[a:b] for a, b in zip((ends - sizes + n_removed).tolist(), ends.tolist(), strict=True)]
        made = {
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(spans[block.offsets[1:]] - spans[begins], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "kept": pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()),
        }
        columns = [block.rows.column(f.name) for f in kept_fields] + [made[n] for n in results.names]
        yield from pa.table(columns, names=[f.name for f in kept_fields] + results.names).to_batches(500)

    schema = T.StructType([*kept_fields, *results.fields])
    return blocks.join(by_block(answers, "lengths", "holders", "shared", "hot"), "block", "left").mapInArrow(tidy(cut), schema)
