import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from leadlake.llm import spelling
from leadlake.llm.common import scratch
from tests.llm import frames

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def counts(rows, misprint=97):
    out = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if misprint and h % misprint == 0 else run] += 1
    return out


def is_near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, letters=5, occurrences=3, misprint=97, ratio=2):
    words = {w: n for w, n in counts(rows, misprint).items() if len(w) >= letters and n >= occurrences}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and is_near(w, v)] for w in words}
    forms = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return sorted(out, key=repr)


def corpus(seed, documents=40):
    """Words with many misspellings of misspellings, in falling numbers."""
    rng, rows = random.Random(seed), []
    stems = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(4, 9))) for _ in range(12)]
    for i in range(documents):
        made = []
        for _ in range(150):
            word = rng.choice(stems)
            while rng.random() < 0.35:
                at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
                word = word[:at] + (rng.choice("abcdefÀz") if kind else "") + word[at + (kind != 1) :]
            made.append(word.upper() if rng.random() < 0.1 and word.isascii() else word)
        rows.append((i, rng.choice(" .-1\n").join(made)))
    return rows


def grouped(spark, frame, **settings):
    with scratch(spark) as keep:
        return frames.rows(spelling.group_variants(frame, keep, spelling.Settings(**settings)), *COLUMNS)


@pytest.mark.parametrize(
    "engine",
    [
        {},
        {"shard_words": 40, "round_bytes": 300},  # several shards of a length, several rounds
        {"bits": 1},  # filters that let very much through
    ],
)
def test_groups_equal_brute_force(spark, engine):
    rows = corpus(1)
    assert grouped(spark, frames.docs(spark, rows), **engine) == brute(rows)


def test_other_limits_equal_brute_force(spark):
    rows = corpus(2, 25)
    for own in ({"letters": 3, "occurrences": 1, "misprint": 7, "ratio": 1.5}, {"letters": 6, "misprint": 0, "ratio": 3}):
        assert grouped(spark, frames.docs(spark, rows), **own) == brute(rows, **own)


def test_edge_rows_equal_brute_force(spark):
    rows = frames.edge_texts() + [(20, "aaaaaa aaaaa aaaaaaa " * 4), (21, "×÷×÷× ×÷×÷ é" * 3)]
    assert grouped(spark, frames.docs(spark, rows)) == brute(rows)
    assert grouped(spark, frames.empty_docs(spark)) == []
    assert grouped(spark, frames.docs(spark, [(1, None), (2, "abcde"), (3, "")])) == []


def test_long_chain_of_forms(spark):
    """aaaaaaab -> aaaaaabb -> ...: each twice as frequent as the one before."""
    chain = ["a" * (12 - k) + "b" * k for k in range(10)]
    rows = [(1, " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2**k)))]
    got = grouped(spark, frames.docs(spark, rows), misprint=0)
    assert got == brute(rows, misprint=0)
    assert {r[2] for r in got} == {chain[-1]}


def test_texts_are_cut_between_runs(monkeypatch):
    rows = [(5, "alpha beta " * 40 + "x" * 300 + " gamma"), (6, ""), (None, "delta-epsilon é" * 9), (7, "y" * 500)]
    whole = counts(rows)
    for piece in (16, 100, 1 << 20):
        monkeypatch.setattr(spelling, "PIECE", piece)
        found = Counter()
        ids, texts = (pa.array(c) for c in zip(*rows, strict=True))
        for words in spelling.batch_words(ids, texts, spelling.Settings()):
            found.update(words.to_pylist())
        assert found == {w: n for w, n in whole.items() if len(w) >= 5}


def test_filters_hold_all_and_little_else():
    keys = np.random.default_rng(1).integers(0, 2**64, 50_000, dtype=np.uint64)
    made = spelling.build_filter(keys[:25_000], 20)
    assert len(spelling.may_hold(made, keys[:25_000])) == 25_000
    assert len(spelling.may_hold(made, keys[25_000:])) < 100
    assert made.nbytes < 25_000 * 20 / 8 + 64


def test_each_edit_is_generated_once():
    shards = spelling.Shards({5: 1, 6: 1}, spelling.Settings())
    every = {(5, 0): np.full((1, 4), 2**64 - 1, np.uint64), (6, 0): np.full((1, 4), 2**64 - 1, np.uint64)}
    codes = np.array([[ord(c) for c in "aabbba"]], np.uint32)
    got = [text for _, text in spelling.edits(codes, np.array([97, 98, 99], np.uint32), shards, every)]
    deleted = {"abbba", "aabba", "aabbb"}
    replaced = {"aabbba"[:i] + c + "aabbba"[i + 1 :] for i in range(6) for c in "bc" if c > "aabbba"[i]}
    assert sorted(got) == sorted(deleted | replaced)
