"""Spelling variants: words of a corpus that differ by one letter, grouped under the most frequent spelling.

Every word generates its edits: each letter deleted, each letter replaced by a later one of the alphabet. So a pair
of near words is generated once, from its longer word or from the one with the earlier letter. Edits probe blocked
Bloom filters of the vocabulary, one shard for each length of word; only those that a filter lets through become
rows, and an exact join with the vocabulary drops what the filters let through wrongly.

Filters are broadcast in rounds of bounded size, however large the vocabulary is: a length with very many words has
several shards, and what doesn't fit into one broadcast waits for the next.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.arrow_text import text_bytes
from leadlake.llm.common import Scratch, arrow_column, tidy
from leadlake.llm.words import FACTOR, LOWERED, UNFACTOR, mixed, powers, word_spans
from leadlake.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    #: Least code points and least occurrences of a word.
    letters: int = 5
    occurrences: int = 3
    #: A run loses a letter where this divides the checksum of its document and itself; 0 for never.
    misprint: int = 97
    #: A near word is the form of a word if it occurs this many times as often.
    ratio: int = 2
    #: Bits of a filter for each word, most words of a shard, and most bytes of the filters of one broadcast.
    bits: int = 20
    shard_words: int = 1 << 20
    round_bytes: int = 64 << 20


#: Bytes of text whose words are cut out at once: a longer text is cut between two runs.
PIECE = 4 << 20
#: Different words that a task holds before it sends their counts on.
HELD = 500_000
#: Bytes of a run whose checksum is computed with those of others.
SHORT = 64
#: Words of 64 bits in a block of a filter.
BLOCK = 4
#: Edits probed at once.
PROBED = 1 << 18

_IS = np.array([False, True])


# ---------------------------------------------------------------- words


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _checksums(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each run behind a prefix, whose own CRC-32 is `before`."""
    lengths = ends - begins
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = -lengths[order]
    state = ~before[order].astype(np.uint32)
    at = begins[order]
    for k in range(min(SHORT, int(lengths.max(initial=0)))):
        n = int(np.searchsorted(sorted_lengths, -k, side="left"))  # runs of more than k bytes
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + k]) & 0xFF] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(begins), np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = zlib.crc32(data[begins[i] : ends[i]].tobytes(), int(before[i]))
    return out


def letters_of(data: np.ndarray) -> np.ndarray:
    """1 for bytes of a-z and of U+00C0 to U+00FF, which UTF-8 writes as C3 and one byte more."""
    lead = data == 0xC3
    inside = ((data >= ord("a")) & (data <= ord("z"))) | lead
    inside[1:] |= lead[:-1]
    return inside.view(np.uint8)


def _pieces(inside: np.ndarray, offsets: np.ndarray):
    """(low, high) of pieces that cut no run in two, and end where a text does unless it is long."""
    low, n = 0, len(inside)
    while low < n:
        high = low + PIECE
        if high >= n:
            high = n
        else:
            text_end = int(offsets[np.searchsorted(offsets, high, side="right") - 1])
            if text_end > low:
                high = text_end
            else:
                while high < n:
                    gap = np.flatnonzero(inside[high : high + PIECE] == 0)
                    if len(gap):
                        high += int(gap[0])
                        break
                    high = min(n, high + PIECE)
                end = int(offsets[np.searchsorted(offsets, low, side="right")])
                high = min(high, end)
        yield low, high
        low = high


def batch_words(ids: pa.Array, texts: pa.Array, settings: Settings):
    """Arrays of the words of texts, misprints made, as often as they occur."""
    data, offsets = text_bytes(texts)
    data = LOWERED[data]
    inside = letters_of(data)
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids.to_pylist()], np.uint32)
    for low, high in _pieces(inside, offsets):
        some = data[low:high]
        begins, ends = word_spans(inside[low:high], np.clip(offsets, low, high) - low, _IS)
        if not len(begins):
            continue
        points = np.concatenate([[0], np.cumsum((some & 0xC0) != 0x80)])
        size = points[ends] - points[begins]
        plain = np.ones(len(begins), bool)
        changed = []
        if settings.misprint:
            text = np.searchsorted(offsets, begins + low, side="right") - 1
            sums = _checksums(some, begins, ends, prefix[text])
            for i in np.flatnonzero(sums % np.uint32(settings.misprint) == 0).tolist():
                plain[i] = False
                if size[i] > settings.letters:
                    run = some[begins[i] : ends[i]].tobytes().decode()
                    cut = int(sums[i]) % len(run)
                    changed.append(run[:cut] + run[cut + 1 :])
        plain &= size >= settings.letters
        first, last = begins[plain], ends[plain]
        edges = np.zeros(len(some) + 1, np.int8)
        edges[first] += 1
        edges[last] -= 1
        joined = some[np.cumsum(edges[:-1], dtype=np.int8).view(bool)]
        ends_at = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int64)
        yield pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends_at), pa.py_buffer(joined))
        if changed:
            yield pa.array(changed, pa.large_string())


def _counted(words: pa.Array) -> pa.Table:
    found = pc.value_counts(words)
    return pa.table({"word": found.field("values").cast(pa.large_string()), "n": found.field("counts")})


def _merged(tables: list[pa.Table]) -> pa.Table:
    total = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
    return total.select(["word", "n_sum"]).rename_columns(["word", "n"])


def _sent(counts: pa.Table):
    for batch in counts.to_batches(max_chunksize=50_000):
        yield pa.RecordBatch.from_arrays([batch.column("word").cast(pa.string()), batch.column("n")], ["word", "n"])


def vocabulary(docs: DataFrame, settings: Settings) -> DataFrame:
    """(word, n) of `docs` (doc_id, text). Tasks count before they send."""

    def count(batches):
        held, rows = [], 0
        for batch in batches:
            for words in batch_words(arrow_column(batch, "doc_id"), arrow_column(batch, "text"), settings):
                held.append(_counted(words))
                rows += len(held[-1])
            if rows > HELD:
                held = [_merged(held)]
                rows = len(held[0])
                if rows > HELD // 2:
                    yield from _sent(held[0])
                    held, rows = [], 0
        if held:
            yield from _sent(_merged(held))

    found = docs.select("doc_id", "text").mapInArrow(tidy(count), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.occurrences)


# ---------------------------------------------------------------- filters


def filter_keys(codes: np.ndarray) -> np.ndarray:
    """Keys of words of one length: a row of code points each."""
    return _keys((_terms(codes)).sum(axis=1, dtype=np.uint64))


def _terms(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint64) + np.uint64(1)) * powers(FACTOR, codes.shape[1])


def _keys(sums: np.ndarray) -> np.ndarray:
    return mixed(sums)


def _spots(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key, and the bits that mark it there: two in each word of the block."""
    block = ((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    return block.astype(np.int64), mixed(keys + np.uint64(FACTOR))


def _mask(bits: np.ndarray, word: int) -> np.ndarray:
    one = np.uint64(1)
    low = (bits >> np.uint64(12 * word)) & np.uint64(63)
    high = (bits >> np.uint64(12 * word + 6)) & np.uint64(63)
    return (one << low) | (one << high)


def build_filter(keys: np.ndarray, bits: int) -> np.ndarray:
    blocks = max(1, -(-len(keys) * bits // (64 * BLOCK)))
    made = np.zeros((blocks, BLOCK), np.uint64)
    block, marks = _spots(keys, blocks)
    for word in range(BLOCK):
        np.bitwise_or.at(made[:, word], block, _mask(marks, word))
    return made


def may_hold(made: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the keys that may be in the filter."""
    at = np.arange(len(keys))
    block, marks = _spots(keys, len(made))
    for word in range(BLOCK):
        mask = _mask(marks, word)
        held = (made[block, word] & mask) == mask
        at, block, marks = at[held], block[held], marks[held]
    return at


class Shards:
    """Number of filters of each length, and the rounds in which they are broadcast."""

    def __init__(self, words: dict[int, int], settings: Settings):
        self.parts = {size: -(-n // settings.shard_words) for size, n in words.items()}
        self.rounds, filled = [set()], 0
        for size, n in sorted(words.items()):
            for part in range(self.parts[size]):
                cost = n // self.parts[size] * settings.bits // 8 + 8 * BLOCK
                if filled and filled + cost > settings.round_bytes:
                    self.rounds.append(set())
                    filled = 0
                filled += cost
                self.rounds[-1].add((size, part))

    def part(self, size: int, keys: np.ndarray) -> np.ndarray:
        return (keys % np.uint64(self.parts[size])).astype(np.int64)


def _by_length(words: pa.Array):
    """(places, code points) of the words of each length."""
    data, offsets = text_bytes(words)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    sizes = np.diff(begins)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        step = max(1, PROBED // max(1, size))
        for low in range(0, len(at), step):
            some = at[low : low + step]
            yield some, codes[begins[some][:, None] + np.arange(size)]


def round_filters(words: DataFrame, shards: Shards, wanted: set, settings: Settings) -> dict:
    """The filters of one round: built by one task a shard, brought together on the driver."""
    lengths = sorted({size for size, _ in wanted})

    def keyed(batches):
        for batch in batches:
            for _, codes in _by_length(arrow_column(batch, "word")):
                size = codes.shape[1]
                keys = filter_keys(codes)
                part = shards.part(size, keys)
                for one in np.unique(part).tolist():
                    if (size, one) in wanted:
                        some = keys[part == one]
                        n = len(some)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, size, np.int32)), pa.array(np.full(n, one, np.int32)), pa.array(some.view(np.int64))],
                            ["size", "part", "key"],
                        )

    def build(group: pa.Table) -> pa.Table:
        keys = group.column("key").to_numpy().view(np.uint64)
        made = build_filter(keys, settings.bits)
        return pa.table(
            {"size": group.column("size").slice(0, 1), "part": group.column("part").slice(0, 1), "made": [made.tobytes()]}
        )

    own = words.where(F.length("word").between(lengths[0], lengths[-1])).select("word")
    rows = own.mapInArrow(tidy(keyed), "size int, part int, key long")
    built = rows.groupBy("size", "part").applyInArrow(build, "size int, part int, made binary")
    return {(r["size"], r["part"]): np.frombuffer(r["made"], np.uint64).reshape(-1, BLOCK) for r in built.collect()}


# ---------------------------------------------------------------- edits


def _probe(keys: np.ndarray, size: int, shards: Shards, filters: dict) -> np.ndarray:
    """Places of the keys that a filter of this round for words of `size` lets through."""
    if shards.parts.get(size, 0) == 1:
        return may_hold(filters[size, 0], keys) if (size, 0) in filters else np.empty(0, np.int64)
    found = [np.empty(0, np.int64)]
    if size in shards.parts:
        part = shards.part(size, keys)
        for own, one in filters:
            if own == size:
                some = np.flatnonzero(part == one)
                found.append(some[may_hold(filters[own, one], keys[some])])
    return np.concatenate(found)


def edits(codes: np.ndarray, alphabet: np.ndarray, shards: Shards, filters: dict):
    """(word, edit) for the edits of words of one length that the filters let through: a row of `codes` each, and
    the edited code points as text. Deleting one of equal neighbours counts once."""
    size = codes.shape[1]
    terms = _terms(codes)
    prefix = np.cumsum(terms, axis=1, dtype=np.uint64)
    total = prefix[:, -1:]
    if size > 1 and size - 1 in shards.parts:
        sums = prefix - terms + (total - prefix) * np.uint64(UNFACTOR)
        first = np.ones(codes.shape, bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        row, spot = np.nonzero(first)
        for k in _probe(_keys(sums[row, spot]), size - 1, shards, filters).tolist():
            yield row[k], np.delete(codes[row[k]], spot[k]).tobytes().decode("utf-32-le")
    if size in shards.parts:
        weight = powers(FACTOR, size)
        for letter in alphabet:
            row, spot = np.nonzero(codes < letter)
            more = (np.uint64(letter) - codes[row, spot].astype(np.uint64)) * weight[spot]
            for k in _probe(_keys(total[row, 0] + more), size, shards, filters).tolist():
                edited = codes[row[k]].copy()
                edited[spot[k]] = letter
                yield row[k], edited.tobytes().decode("utf-32-le")


def candidates(words: DataFrame, alphabet: np.ndarray, shards: Shards, filters: dict) -> DataFrame:
    """(word, n, near): edits of `words` (word, n) that may be words."""
    shared = words.sparkSession.sparkContext.broadcast(filters)

    def generate(batches):
        for batch in batches:
            places, edited = [], []
            for at, codes in _by_length(arrow_column(batch, "word")):
                for row, text in edits(codes, alphabet, shards, shared.value):
                    places.append(int(at[row]))
                    edited.append(text)
            if places:
                rows = batch.select(["word", "n"]).take(pa.array(places))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(edited, pa.string())], ["word", "n", "near"])

    return words.select("word", "n").mapInArrow(tidy(generate), "word string, n long, near string")


def near_words(words: DataFrame, keep: Scratch, settings: Settings) -> DataFrame:
    """(word, n, near, near_n): every pair of near words once. `words`: a written table (word, n)."""
    counts = {r["size"]: r["n"] for r in words.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = Shards(counts, settings)
    # 90 letters at most: what a run may hold
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters.collect()), np.uint32)
    found = None
    for number, wanted in enumerate(shards.rounds):
        if not wanted:
            continue
        filters = round_filters(words, shards, wanted, settings)
        some = keep(candidates(words, alphabet, shards, filters), f"candidates-{number}")
        found = some if found is None else found.unionByName(some)
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    if found is None:
        return words.where(F.lit(False)).select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.join(exact, "near").select("word", "n", "near", "near_n")


# ---------------------------------------------------------------- forms and roots


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for `forms` (word, form): the end of each chain, by jumps that double.

    Words that have arrived leave the loop, so an end that very many words reach is no key of a join. A form occurs
    at least `ratio` times as often as its word, so chains are short and end.
    """
    ended = forms.select(F.col("word").alias("form"), F.lit(True).alias("goes_on"))
    steps = forms.join(ended, "form", "left").select("word", "form", F.coalesce("goes_on", F.lit(False)).alias("goes_on"))
    steps = cut_lineage(steps)
    done = steps.where("not goes_on").select("word", F.col("form").alias("root"))
    while steps.where("goes_on").take(1):
        onward = steps.select(F.col("word").alias("form"), F.col("form").alias("next"), F.col("goes_on").alias("more"))
        moved = steps.where("goes_on").join(onward, "form").select("word", F.col("next").alias("form"), F.col("more").alias("goes_on"))
        # words that have arrived stay as targets of later jumps
        moved = cut_lineage(moved)
        done = done.unionByName(moved.where("not goes_on").select("word", F.col("form").alias("root")))
        steps = cut_lineage(moved.unionByName(steps.where("not goes_on")))
    return done


def group_variants(
    docs: DataFrame, keep: Scratch, settings: Settings | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    A word's form is its near word of largest n (ties: the first in code-point order), if that is `ratio` times the
    word's n at least; its root is the last of the chain of forms, itself without one. Null and empty texts have no
    words; a null id counts as an empty one in the misprint rule; repeated rows count as often as they occur; other
    columns are not read. An empty table, and one without frequent words, gives no rows. Intermediate tables go to
    `keep`; the result is lazy and reads them.
    """
    settings = settings or Settings()
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    words = keep(vocabulary(own, settings), "vocabulary")
    pairs = keep(near_words(words, keep, settings), "near-words")
    back = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    around = pairs.unionByName(back).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best)
    likely = -F.col("best.rank") >= settings.ratio * F.col("n")
    around = around.select(
        "word", "n_near", F.when(likely, F.col("best.near")).alias("form"), F.when(likely, -F.col("best.rank")).alias("form_n")
    )
    around = keep(around, "around")
    roots = _roots(around.where("form is not null").select("word", "form"))
    found = words.join(around, "word", "left").join(roots, "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
