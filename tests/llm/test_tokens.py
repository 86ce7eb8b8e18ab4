import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadlake.llm import bpe_count, ffd_packing
from leadlake.llm.common import scratch
from tests.llm import frames

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def odd_texts(n, seed=0):
    rng = random.Random(seed)
    parts = [
        " ", "  ", "\n", "\t", "\r\n", " ", " ", "\x1c", "\x85", "a", "the", "'s", "'LL", "don't", "12", "٣", "é", "é", "İ", "Σ", "ß", "東京",
        "🙂", "###", "<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "​", "﻿", "\x00", "zzzzzzzzzz", "ﬁ", "̸",
    ]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(n)]


def all_texts():
    return frames.edge_texts() + [(100 + i, t) for i, t in odd_texts(300)]


def test_counts_equal_the_library(spark, monkeypatch):
    library = Tokenizer.from_file(BYTES)
    got = bpe_count.count_tokens(frames.docs(spark, all_texts()), BYTES, limit=512)
    expected = []
    for i, t in all_texts():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 512))
    assert frames.rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)


def test_merging_by_heap_equals_merging_by_scan():
    ranks = {("a", "b"): 0, ("b", "a"): 1, ("ab", "ab"): 2, ("a", "a"): 3, ("abab", "a"): 4, ("aa", "b"): 5}
    rng = random.Random(1)
    for _ in range(300):
        symbols = [rng.choice("abc") for _ in range(rng.randint(0, 25))]
        plain = list(symbols)
        while True:
            pairs = [(ranks[p], i) for i, p in enumerate(zip(plain, plain[1:], strict=False)) if p in ranks]
            if not pairs:
                break
            _, i = min(pairs)
            plain[i : i + 2] = ["".join(plain[i : i + 2])]
        assert bpe_count.merged_count(list(symbols), ranks) == len(plain)


def test_memory_of_words_is_bounded_and_long_texts_are_walked(monkeypatch):
    monkeypatch.setattr(bpe_count, "REMEMBERED", 5)
    monkeypatch.setattr(bpe_count, "LISTED_CHARS", 50)
    counter = bpe_count.Counter(bpe_count.read_vocabulary(BYTES))
    library = Tokenizer.from_file(BYTES)
    text = frames.prose(5, 400)
    assert counter.tokens(text) == len(library.encode(text).ids) and len(counter) <= 5


def ids_of(texts):
    library = Tokenizer.from_file(WORDS)
    return [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in texts]


def test_words_with_marks_and_digits_are_cut_without_the_library(monkeypatch):
    """The runs of such a word are looked up one by one; apostrophes and special tokens still go to the library."""
    library = Tokenizer.from_file(WORDS)
    with open(WORDS, encoding="utf-8") as file:
        ids = ffd_packing.Ids(file.read())
    asked, whole = [], ids.whole
    ids.whole = lambda word: asked.append(word) or whole(word)
    rng = random.Random(3)
    parts = [*"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~<0123456789", "ab", "The", "É", "straße", "re", "ZZ"]
    mixed = ["".join(rng.choice(parts) for _ in range(rng.randint(2, 12))) for _ in range(3000)]
    others = ["don't", "'s", "x'LL!", "a<|endoftext|>b", "<|startoftext|>", "<|endoftext", "e\u0301.", "東京!!", "½.", "a\u0338="]
    for word in mixed + others:
        assert b"".join(ids.of(word)) == np.array(library.encode(word, add_special_tokens=False).ids, "<u4").tobytes(), word
    # single digits and runs of marks have no parts, and `<|` may begin a special token
    assert {w for w in asked if len(ffd_packing.RUNS(w)) > 1 and "<|" not in w} <= set(others) | {"x'LL!", "e\u0301"}


def test_words_are_not_cut_where_a_token_of_their_letters_was_added():
    library = Tokenizer.from_file(WORDS)
    library.add_special_tokens(["[MASK]"])
    ids = ffd_packing.Ids(library.to_str())
    assert b"".join(ids.of("so [MASK], x[MASK]!")) == np.array(library.encode("so [MASK], x[MASK]!").ids, "<u4").tobytes()


@pytest.mark.parametrize("settings", [{}, {"sequence": 64, "group_pieces": 40}])
def test_packing(spark, settings, monkeypatch):
    settings = ffd_packing.Settings(**settings)
    texts = [(k, t) for k, (_, t) in enumerate(all_texts())]
    with scratch(spark) as keep:
        packed = ffd_packing.pack(frames.docs(spark, texts), WORDS, keep, settings, with_ids=True)
        rows = packed.collect()
        full = {r.sequence_id: r for r in ffd_packing.sequences(packed).collect()}
    expected, room = dict(zip([k for k, _ in texts], ids_of(texts), strict=True)), Counter()
    for r in rows:
        part = expected[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(part) and r.doc_tokens == len(expected[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        room[r.sequence_id] += r.length
        assert bytes(full[r.sequence_id].ids)[4 * r.offset : 4 * (r.offset + r.length)] == part.tobytes()
    assert sum(r.length for r in rows) == sum(map(len, expected.values()))
    assert len({(r.doc_id, r.start) for r in rows}) == len(rows)
    assert max(room.values()) <= settings.sequence
    for sequence, n in room.items():
        assert len(full[sequence].ids) == 4 * n and sorted(full[sequence].offsets)[0] == 0


def test_repeated_rows_and_null_ids_are_packed_each(spark):
    with scratch(spark) as keep:
        rows = ffd_packing.pack(frames.docs(spark), WORDS, keep).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(i for i, _ in frames.edge_texts())


def test_first_fit_decreasing_equals_a_plain_scan():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 64, 65, 300):
        sizes = rng.integers(1, 101, n)
        sequence, offset = ffd_packing.first_fit_decreasing(sizes, 100)
        free: list[int] = []
        for i in np.argsort(-sizes, kind="stable"):
            at = next((k for k, f in enumerate(free) if f >= sizes[i]), len(free))
            free += [100] * (at == len(free))
            assert (sequence[i], offset[i]) == (at, 100 - free[at])
            free[at] -= sizes[i]


def test_little_padding(spark):
    texts = [(i, frames.prose(i, 20 + 37 * i % 400)) for i in range(600)]
    with scratch(spark) as keep:
        rows = ffd_packing.pack(frames.docs(spark, texts), WORDS, keep).collect()
    room = Counter()
    for r in rows:
        room[r.sequence_id] += r.length
    assert sum(room.values()) > 0.97 * 4096 * (len(room) - 1)


def test_empty_tables(spark):
    assert bpe_count.count_tokens(frames.empty_docs(spark), BYTES).collect() == []
    with scratch(spark) as keep:
        assert ffd_packing.pack(frames.empty_docs(spark), WORDS, keep).collect() == []
