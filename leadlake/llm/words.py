"""Words of UTF-8 texts that lie one after the other in one array, and their hashes, as whole-array work."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at once.
HASHED = 1 << 18
#: Odd numbers of the hashes.
FACTOR, MIXERS = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
UNFACTOR = pow(FACTOR, -1, 1 << 64)


def byte_table(separators: str) -> np.ndarray:
    """True for bytes of words: all but the listed ASCII characters."""
    table = np.ones(256, bool)
    table[[ord(c) for c in separators]] = False
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


#: Words of the shingle operators: anything between blanks, tabs and line ends.
BETWEEN_BLANKS = byte_table(" \t\n\v\f\r")
LOWERED = lower_table()


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of words; a word ends where its text does."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = table[data]
    turns = inside[1:] != inside[:-1]
    edges = offsets[1:-1]  # between two texts: where both sides are of a word, one ends and one begins
    edges = np.unique(edges[(edges > 0) & (edges < len(data))])
    joined = edges[inside[edges] & inside[edges + 1]]
    at = np.flatnonzero(turns)
    begins, ends = at[::2], at[1::2]
    if len(joined):
        begins, ends = np.sort(np.concatenate([begins, joined])), np.sort(np.concatenate([ends, joined]))
    return begins, ends


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIXERS[0])
    values = (values ^ (values >> np.uint64(27))) * np.uint64(MIXERS[1])
    return values ^ (values >> np.uint64(31))


def powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > 2 * HASHED:
        return powers(FACTOR, n), powers(UNFACTOR, n)
    if not _POWERS:
        _POWERS.update(up=powers(FACTOR, 2 * HASHED), down=powers(UNFACTOR, 2 * HASHED))
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    out = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        base = begins[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + HASHED, side="right")))
        n = int(ends[stop - 1] - base)
        up, down = _power_tables(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[base : base + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        a, b = begins[at:stop] - base, ends[at:stop] - base
        out[at:stop] = (sums[b] - sums[a]) * down[a]
        at = stop
    return mixed(out + (ends - begins).astype(np.uint64))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Different hashes of `size` words in a row, sorted; of a shorter text, one of all its words."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = words[: len(words) - size + 1].copy()
    for k in range(1, size):
        total = mixed(total * np.uint64(FACTOR) + words[k : len(words) - size + 1 + k])
    return np.unique(total)


def text_shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """`shingles` of each text, A-Z lower-cased."""
    data = LOWERED[data]
    begins, ends = word_spans(data, offsets, BETWEEN_BLANKS)
    words = word_hashes(data, begins, ends)
    cut = np.searchsorted(begins, offsets)
    return [shingles(words[a:b], size) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
