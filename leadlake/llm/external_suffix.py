"""Suffix order with common-prefix lengths by external induced sorting.

The string is reduced to the names of its LMS substrings, these are sorted by recursion, and two scans induce the
rest: suffixes leave a priority queue in order, and each brings its left neighbour in. The queue keeps a bounded
number of tuples (key, position, common prefix) in memory and the others as sorted runs on disk, so a shard may
be far larger than memory; the string itself and finished parts of the order are memory-mapped files then.
Tuples leave in batches that cannot depend on each other, so each step works on whole arrays.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from math import isqrt

import numpy as np

#: Largest batch that leaves the queue at once.
BATCH = 1 << 16
#: Tuples that the queue sorts into one run.
RUN = 1 << 16
#: Default number of tuples and array elements kept in memory before files are used.
MEMORY_ITEMS = 1 << 23


def place_type(text: np.ndarray) -> type:
    """Type of positions in a string."""
    return np.int32 if len(text) < 1 << 31 else np.int64


class Workspace:
    """Arrays in memory up to `memory_items` elements each, else in files that vanish with this object.

    The files belong to one task attempt on one machine, as Spark's own spills do; a repeated task makes new ones.
    """

    def __init__(self, memory_items: int = MEMORY_ITEMS):
        self.memory_items = memory_items
        self.folder = tempfile.TemporaryDirectory(prefix="suffixes-")
        self.files = 0

    def keep(self, array: np.ndarray) -> np.ndarray:
        if len(array) <= self.memory_items:
            return array
        self.files += 1
        path = f"{self.folder.name}/{self.files}"
        array.tofile(path)
        return np.memmap(path, dtype=array.dtype, mode="r", shape=array.shape)

    def close(self) -> None:
        self.folder.cleanup()


class Spool:
    """Arrays appended piece by piece, as one array at the end."""

    def __init__(self, work: Workspace, dtype):
        self.work, self.dtype, self.pieces, self.held, self.file = work, np.dtype(dtype), [], 0, None
        self.length = 0

    def add(self, piece: np.ndarray) -> None:
        self.pieces.append(np.asarray(piece, self.dtype))
        self.held += len(piece)
        self.length += len(piece)
        if self.held > self.work.memory_items:
            if self.file is None:
                self.work.files += 1
                self.file = open(f"{self.work.folder.name}/{self.work.files}", "wb")
            self._flush()

    def _flush(self) -> None:
        for p in self.pieces:
            p.tofile(self.file)
        self.pieces, self.held = [], 0

    def array(self) -> np.ndarray:
        if self.file is None:
            return np.concatenate(self.pieces) if self.pieces else np.empty(0, self.dtype)
        self._flush()
        self.file.close()
        return np.memmap(self.file.name, dtype=self.dtype, mode="r", shape=(self.length,))


class Queue:
    """Priority queue of (key, position, prefix): by key, equal keys in the order they came in."""

    def __init__(self, work: Workspace):
        self.work, self.runs, self.buffer, self.held = work, [], [], 0
        self.run = RUN if work.memory_items > RUN else max(1, work.memory_items // 2)

    def push(self, key: np.ndarray, position: np.ndarray, prefix: np.ndarray) -> None:
        self.buffer.append((key, position, prefix))
        self.held += len(key)
        if self.held <= self.run:
            return
        key, position, prefix = self._joined()
        order = np.argsort(key, kind="stable")
        self.runs.append([0, key[order], position[order], prefix[order]])
        self.buffer, self.held = [], 0
        if sum(len(r[1]) - r[0] for r in self.runs if not isinstance(r[1], np.memmap)) > self.work.memory_items:
            self._spill()

    def _spill(self) -> None:
        """The runs in memory, which are the newest, become one run on disk."""
        first = next(i for i, r in enumerate(self.runs) if not isinstance(r[1], np.memmap))
        columns = [np.concatenate([r[c][r[0] :] for r in self.runs[first:]]) for c in (1, 2, 3)]
        order = np.argsort(columns[0], kind="stable")
        self.work.files += 1
        run = []
        for column, array in enumerate(columns):
            path = f"{self.work.folder.name}/{self.work.files}-{column}"
            array[order].tofile(path)
            run.append(np.memmap(path, dtype=array.dtype, mode="r", shape=array.shape))
        self.runs[first:] = [[0, *run]]

    def _joined(self):
        if len(self.buffer) > 1:
            self.buffer = [tuple(np.concatenate(c) for c in zip(*self.buffer, strict=True))]
        return self.buffer[0]

    def take(self, below: int, most: int | None = None):
        """Items with a key under `below`, sorted; at most about `most`, if they all have one key."""
        found, n = [], 0
        for run in self.runs:
            at, keys, positions, prefixes = run
            end = at + int(np.searchsorted(keys[at:], keys.dtype.type(below)))
            if most is not None:
                end = min(end, at + most - n)
            if end > at:
                found.append(tuple(np.array(c[at:end]) for c in (keys, positions, prefixes)))
                run[0], n = end, n + end - at
            if most is not None and n >= most:
                break
        self.runs = [r for r in self.runs if r[0] < len(r[1])]
        if self.held and (most is None or n < most):
            joined = self._joined()
            here = joined[0] < below
            if here.any():
                found.append(tuple(c[here] for c in joined))
                np.logical_not(here, out=here)
                rest = here
                self.buffer = [tuple(c[rest] for c in joined)]
                self.held = len(self.buffer[0][0])
        if not found:
            return None
        key, position, prefix = (np.concatenate(c) for c in zip(*found, strict=True)) if len(found) > 1 else found[0]
        if most is None and len(found) >= 1:
            order = np.argsort(key, kind="stable")
            key, position, prefix = key[order], position[order], prefix[order]
        return key, position, prefix


class Prefixes:
    """Common-prefix lengths, up to `most`, carried from the suffixes that leave to those they bring in."""

    def __init__(self, text: np.ndarray, letters: int, most: int):
        self.text, self.most = text, most
        #: Four letters of two bytes from each place on as one number.
        self.fours = None
        if text.dtype == np.uint16 and len(text) > 3:
            self.fours = np.ndarray(len(text) - 3, np.uint64, text, strides=(2,))
        #: By letter: least common prefix since a suffix was last brought in under it; -1: none was.
        self.since = np.full(letters, -1, np.int16)

    def direct(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at a and b: four letters at a time, then the last ones letter by letter."""
        found = np.zeros(len(a), np.uint8)
        n, open_ = len(self.text), np.arange(len(a))
        if self.fours is not None:
            while len(open_):
                x, y = a[open_] + found[open_], b[open_] + found[open_]
                inside = (np.maximum(x, y) < n - 3) & (found[open_] + 4 <= self.most)
                same = open_[inside]
                open_ = same[self.fours[x[inside]] == self.fours[y[inside]]]
                found[open_] += 4
        open_ = np.arange(len(a))
        for _ in range(4 if self.fours is not None else self.most):
            x, y = a[open_] + found[open_], b[open_] + found[open_]
            inside = (np.maximum(x, y) < n) & (found[open_] < self.most)
            open_, x, y = open_[inside], x[inside], y[inside]
            open_ = open_[self.text[x] == self.text[y]]
            if not len(open_):
                break
            found[open_] += 1
        return found

    def induced(self, prefix: np.ndarray, source: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """`prefix`: of each suffix of the batch with the one before. `source`: places in the batch that bring a
        suffix in, `letter`: its first letter. Returns its common prefix with the one brought in before it."""
        order = np.argsort(letter.astype(np.uint16), kind="stable")
        at, of = source[order], letter[order]
        first = np.ones(len(at), bool)
        first[1:] = of[1:] != of[:-1]
        last = np.append(first[1:], True)
        table = [prefix]
        while 2 << len(table) <= 2 * len(prefix) and len(prefix) > (1 << (len(table) - 1)):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        low = np.empty(len(at), np.int16)
        begin = np.minimum.accumulate(prefix).astype(np.int16)
        low[first] = np.minimum(self.since[of[first]], begin[at[first]])
        inner = np.flatnonzero(~first)
        a, b = at[inner - 1] + 1, at[inner]
        level = np.log2(b - a + 1).astype(np.int8)
        for k in range(int(level.max(initial=-1)) + 1):
            here = level == k
            low[inner[here]] = np.minimum(table[k][a[here]], table[k][b[here] - (1 << k) + 1])
        # what the next batch has to know
        end = np.append(np.minimum.accumulate(prefix[::-1])[::-1], np.uint8(self.most)).astype(np.int16)
        self.since = np.minimum(self.since, end[0])
        self.since[of[last]] = end[at[last] + 1]
        out = np.empty(len(at), np.uint8)
        out[order] = np.minimum(low + 1, self.most)
        return out


def induce(
    text: np.ndarray,
    counts: np.ndarray,
    seeds: np.ndarray,
    seed_prefix: np.ndarray | None,
    down: bool,
    emit: Callable[[np.ndarray, np.ndarray, np.ndarray], None],
    work: Workspace,
    most: int = 0,
) -> None:
    """One scan. Upwards, `seeds` are LMS suffixes in order and the L-type ones are brought in; downwards, seeds
    are the L-type suffixes from the last to the first, and the S-type ones are brought in.

    `counts`: suffixes by first letter. `emit` gets positions, common prefixes and which are not seeds. A key is
    twice the letter (counted from the other end when going down), plus one for seeds: they come after the others.
    """
    letters = len(counts)
    flip = letters - 1
    key_type = np.uint16 if 2 * letters + 2 < 1 << 16 else np.int64  # short ones are sorted by radix
    wide = np.int32 if letters < 1 << 30 else np.int64
    letter_of = (lambda at: flip - text[at].astype(wide)) if down else (lambda at: text[at].astype(wide))
    by_letter = counts[::-1] if down else counts
    seed_counts = np.zeros(letters, np.int64)
    for at in range(0, len(seeds), BATCH):
        seed_counts += np.bincount(letter_of(seeds[at : at + BATCH]), minlength=letters)
    seeds_before = np.concatenate([[0], np.cumsum(seed_counts)])
    before = np.concatenate([[0], np.cumsum(by_letter)])
    prefixes = Prefixes(text, letters, most) if most else None
    queue = Queue(work)
    last_key, last_position = -1, -1
    #: Suffixes of a range of letters. One in as many of them brings in another of the same range, so most ranges
    #: leave in a batch or two.
    width = isqrt(len(text))

    def step(key, position, prefix, inside: int):
        """Let a batch leave; returns what it brings in with letters under `inside`, sorted."""
        nonlocal last_key, last_position
        if prefixes is not None:
            letter = key >> 1
            same = np.append(last_key >> 1 == letter[0], letter[1:] == letter[:-1])
            turn = np.flatnonzero(same & np.append(last_key != key[0], key[1:] != key[:-1]))
            prefix = prefix * same
            if len(turn):
                before = np.append(last_position, position[:-1])[turn]
                prefix[turn] = prefixes.direct(position[turn], before)
        emit(position, prefix, (key & 1) == 0)
        last_key, last_position = int(key[-1]), int(position[-1])
        source = np.flatnonzero(position > 0)
        left = letter_of(position[source] - 1)
        fits = 2 * left >= key[source]
        source, left = source[fits], left[fits]
        new_prefix = np.zeros(len(source), np.uint8)
        if prefixes is not None:
            if len(source):
                new_prefix = prefixes.induced(prefix, source, left)
            else:
                prefixes.since = np.minimum(prefixes.since, np.int16(prefix.min()))
        new_key, new_position = (2 * left).astype(key_type), position[source] - 1
        here = left < inside
        if not here.any():
            if len(left):
                queue.push(new_key, new_position, new_prefix)
            return None
        beyond = ~here
        if beyond.any():
            queue.push(new_key[beyond], new_position[beyond], new_prefix[beyond])
        new_key, new_position, new_prefix = new_key[here], new_position[here], new_prefix[here]
        order = np.argsort(new_key, kind="stable")
        return new_key[order], new_position[order], new_prefix[order]

    def seeds_from(a: int, b: int):
        position = np.array(seeds[a:b], dtype=place_type(text))
        prefix = np.zeros(b - a, np.uint8) if seed_prefix is None else np.array(seed_prefix[a:b])
        return (2 * letter_of(position) + 1).astype(key_type), position, prefix

    low = 0
    while low < letters:
        high = max(low + 1, int(np.searchsorted(before, before[low] + width, side="right")) - 1)
        first_seed, end_seed = int(seeds_before[low]), int(seeds_before[high])
        if high == low + 1:  # one letter: its items leave in the order they came, new ones go to the end
            while (items := queue.take(2 * high, BATCH)) is not None:
                for at in range(0, len(items[0]), BATCH):
                    new = step(*(c[at : at + BATCH] for c in items), high)
                    if new is not None:
                        queue.push(*new)
            for at in range(first_seed, end_seed, BATCH):
                step(*seeds_from(at, min(at + BATCH, end_seed)), low)
        else:
            items = queue.take(2 * high)
            own = seeds_from(first_seed, end_seed)
            if items is None:
                items = own
            else:
                items = tuple(np.concatenate(c) for c in zip(items, own, strict=True))
                order = np.argsort(items[0], kind="stable")
                items = tuple(c[order] for c in items)
            while len(items[0]):
                key, position, _ = items
                left = letter_of(np.maximum(position - 1, 0))
                new_key = np.where((position > 0) & (2 * left >= key), 2 * left, 2 * letters)
                reach = np.minimum.accumulate(new_key)
                late = key[1:] > reach[:-1]
                safe = int(np.argmax(late)) + 1 if late.any() else len(key)
                new = step(*(c[:safe] for c in items), high)
                rest = tuple(c[safe:] for c in items)
                if new is not None:
                    where = np.searchsorted(rest[0], new[0], side="right")
                    rest = tuple(np.insert(r, where, n) for r, n in zip(rest, new, strict=True))
                items = rest
        low = high


def direct_order(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix order, or order by the first `depth` letters at least, in memory by prefix doubling."""
    n = len(text)
    rank, width = np.asarray(text, np.int64), 1
    while True:
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key)
        key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank, width = new, 2 * width
        if rank[order[-1]] == n - 1 or width >= n or (depth is not None and width >= depth):
            return order


def s_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that follows; the last counts as one."""
    differs = np.flatnonzero(text[1:] != text[:-1])
    rises = text[differs + 1] > text[differs]
    lengths = np.diff(np.concatenate([[-1], differs]))
    return np.concatenate([np.repeat(rises, lengths), np.ones(len(text) - lengths.sum(), bool)])


def _both_scans(text, counts, seeds, seed_prefix, emit, work, most=0):
    """Up and down; `emit` gets the suffixes from the last to the first, which are of type S, and prefixes."""
    positions, prefixes = Spool(work, place_type(text)), Spool(work, np.uint8)

    def take(position, prefix, brought):
        positions.add(position[brought])
        prefixes.add(prefix[brought])

    induce(text, counts, seeds, seed_prefix, False, take, work, most)
    position, prefix = positions.array(), prefixes.array()
    if most:  # between L-type neighbours the prefix stands with the upper one; going down it belongs to the lower
        prefix = np.concatenate([prefix[1:], np.zeros(1, np.uint8)])
    induce(text, counts, position[::-1], prefix[::-1], True, emit, work, most)


def _substring_names(text: np.ndarray, lms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of LMS substrings given in order: equal ones share a name. `ends`: last place of each."""
    same = ends[1:] - lms[1:] == ends[:-1] - lms[:-1]
    open_ = np.flatnonzero(same)
    k = 0
    while len(open_):
        equal = text[lms[open_] + k] == text[lms[open_ + 1] + k]
        same[open_[~equal]] = False
        open_ = open_[equal]
        k += 1
        open_ = open_[lms[open_] + k <= ends[open_]]
    return np.concatenate([[0], np.cumsum(~same)])


def lms_order(text: np.ndarray, counts: np.ndarray, work: Workspace, depth: int | None = None) -> np.ndarray:
    """The LMS suffixes in order, by `depth` letters at least. The last letter of `text` is its only smallest one."""
    small = s_types(text)
    is_lms = np.zeros(len(text), bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = work.keep(np.flatnonzero(is_lms))
    if len(lms) <= 1:
        return lms
    found = Spool(work, place_type(text))
    seeds = lms[np.argsort(text[lms], kind="stable")]
    _both_scans(
        text, counts, seeds, None, lambda position, _, brought: found.add(position[brought & is_lms[position]]), work
    )
    order = work.keep(np.concatenate([[len(text) - 1], found.array()[::-1]]))  # nothing brings the last one in
    place = np.searchsorted(lms, order)
    ends = np.append(lms[1:], len(text) - 1)[place]
    named = _substring_names(text, order, ends)
    if named[-1] == len(lms) - 1:
        return order
    reduced = np.empty(len(lms), np.int64)
    reduced[place] = named
    # a name stands for two letters at least, and one more covers what the last of them began
    order = suffix_order(work.keep(reduced), int(named[-1]) + 1, work, None if depth is None else depth // 2 + 1)
    return work.keep(lms[order])


def suffix_order(text: np.ndarray, letters: int, work: Workspace, depth: int | None = None) -> np.ndarray:
    """Positions of all suffixes in order, by `depth` letters at least. The last letter of `text` is its only
    smallest one. The recursion ends with a string that fits in memory."""
    if 4 * len(text) <= work.memory_items:
        return direct_order(text, depth)
    found = Spool(work, np.int64)
    suffixes_with_prefixes(text, letters, lambda position, _: found.add(position), work, 0, depth)
    return work.keep(np.concatenate([[len(text) - 1], found.array()[::-1]]))


def suffixes_with_prefixes(
    text: np.ndarray,
    letters: int,
    emit: Callable[[np.ndarray, np.ndarray], None],
    work: Workspace,
    most: int,
    depth: int | None = None,
) -> None:
    """Give `emit` all suffixes but the last letter's from the greatest down, in batches: positions, and the
    common prefix (up to `most`, at most 254) of each with the suffix given before it. With `most`, suffixes that
    share that many letters stand together in any order.

    `text` has letters from 0 to `letters` - 1, the last one being its only 0. At most 65,536 letters if `most`.
    """
    counts = np.zeros(letters, np.int64)
    for at in range(0, len(text), BATCH):
        counts += np.bincount(text[at : at + BATCH], minlength=letters)
    seeds = lms_order(text, counts, work, most or depth)
    prefix = None
    if most:
        direct = Prefixes(text, letters, most).direct
        spool = Spool(work, np.uint8)
        spool.add(np.zeros(1, np.uint8))
        for at in range(1, len(seeds), BATCH):
            end = min(at + BATCH, len(seeds))
            spool.add(direct(seeds[at:end], seeds[at - 1 : end - 1]))
        prefix = spool.array()
    _both_scans(text, counts, seeds, prefix, lambda position, common, _: emit(position, common), work, most)
