import hashlib

import numpy as np
import pytest

from leadlake.llm import external_suffix as ext
from leadlake.llm import suffix_dedup
from leadlake.llm.common import scratch
from tests.llm import frames


def brute(texts, length=50):
    """(id, bytes, removed, spans, digest of the rest) by comparing every window with every earlier document."""
    last = float("inf")
    first = {}
    for i, t in texts:
        data = (t or "").encode()
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            first[window] = min(first.get(window, last), last if i is None else i)
    out = []
    for i, t in texts:
        data = (t or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] < (last if i is None else i):
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        rest = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def naive_order(text):
    letters = text.tolist()
    return sorted(range(len(letters)), key=lambda i: letters[i:])


@pytest.mark.parametrize("memory", [3, 24, 1 << 20])
@pytest.mark.parametrize("seed", range(12))
def test_suffix_order_and_prefixes(seed, memory, monkeypatch):
    """Tiny memory forces recursion, runs on disk and small batches; the order must not change."""
    monkeypatch.setattr(ext, "BATCH", [2, 7, 1 << 16][seed % 3])
    monkeypatch.setattr(ext, "RUN", [1, 5, 1 << 15][seed % 3])
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 250))
    body = rng.integers(1, int(rng.integers(2, 6)), n)
    if seed % 4 == 0:
        body = np.resize(body[:7], n)  # periodic
    text = np.append(body, 0).astype(np.uint16)
    expected, letters = naive_order(text), int(text.max()) + 1
    work = ext.Workspace(memory)
    assert ext.suffix_order(text, letters, work).tolist() == expected
    most, order, common = 9, [], []
    ext.suffixes_with_prefixes(text, letters, lambda p, c: (order.extend(p.tolist()), common.extend(c.tolist())), work, most)
    work.close()
    order, common, list_ = order[::-1], common[::-1], text.tolist()
    assert [list_[i : i + most] for i in order] == [list_[i : i + most] for i in expected[1:]]
    for a, b, c in zip(order, order[1:], common, strict=False):
        shared = 0
        while shared < most and max(a, b) + shared < len(list_) and list_[a + shared] == list_[b + shared]:
            shared += 1
        assert shared == c


def test_files_are_used_and_removed(tmp_path, monkeypatch):
    monkeypatch.setattr(ext.tempfile, "tempdir", str(tmp_path))
    text = np.append(np.random.default_rng(0).integers(1, 5, 5000), 0).astype(np.uint16)
    work = ext.Workspace(100)
    ext.suffixes_with_prefixes(text, 5, lambda p, c: None, work, 9)
    assert work.files > 10
    work.close()
    assert list(tmp_path.iterdir()) == []


def removed(spark, texts, **settings):
    with scratch(spark) as keep:
        got = suffix_dedup.remove_repeats(frames.docs(spark, texts), keep, suffix_dedup.Settings(**settings))
        return frames.rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_only_segments_that_share_an_anchor_are_put_in_order(monkeypatch):
    """A segment alone at its anchor keeps its own id; others get the smallest id of an equal window, found by order."""
    length = suffix_dedup.Settings.length
    rng, texts = np.random.default_rng(2), {}
    for i in range(400):
        own = bytes(rng.integers(97, 123, 200).astype(np.uint8))
        for owner, text in ((2 * i + 7, own), *([(i, own[:90] + own[:110][::-1])] if i % 5 == 0 else [])):
            data = np.frombuffer(text, np.uint8)
            start, windows, _ = suffix_dedup.segments_of(data, np.array([0, len(data)]), length)
            for a, b in zip(start.tolist(), (start + windows + length - 1).tolist(), strict=True):
                texts[text[a:b]] = min(owner, texts.get(text[a:b], owner))
    texts["ab".encode() * 60] = 3
    ids, texts = np.array(list(texts.values()), np.int64), list(texts)
    least = {}
    for t, i in zip(texts, ids.tolist(), strict=True):
        for k in range(len(t) - length + 1):
            least[t[k : k + length]] = min(i, least.get(t[k : k + length], i))
    expected = [least[t[k : k + length]] for t in texts for k in range(len(t) - length + 1)]
    sorted_texts, by_order = [], suffix_dedup.holders_in_order
    monkeypatch.setattr(suffix_dedup, "holders_in_order", lambda t, *rest: sorted_texts.extend(t) or by_order(t, *rest))
    monkeypatch.setattr(suffix_dedup, "HASHED", 1 << 10)
    assert suffix_dedup.first_holders(texts, ids, suffix_dedup.Settings()).tolist() == expected
    assert expected != np.repeat(ids, [len(t) - length + 1 for t in texts]).tolist()
    assert 0 < len(sorted_texts) < len(texts) / 4


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 300, "shard_bytes": 500, "memory_items": 64}])
def test_edge_rows_equal_brute_force(spark, settings):
    assert removed(spark, frames.edge_texts(), **settings) == brute(frames.edge_texts())


def test_planted_passages_of_exactly_the_length(spark):
    passage = frames.prose(77, 40)[:50]
    texts = [(i, f"{frames.prose(i, 30)} {passage if i % 2 else passage[:49] + '~'} {frames.prose(i + 50, 30)}") for i in range(1, 9)]
    texts += [(20, "aaaa" * 100), (21, "aaaa" * 30), (22, "ab" * 24), (23, "ab" * 25), (24, "ba" * 60)]
    got = removed(spark, texts, block_bytes=600, shard_bytes=400)
    assert got == brute(texts) and sum(r[2] > 0 for r in got) >= 5


def test_text_result_drops_cut_characters(spark):
    a = "é" * 40
    with scratch(spark) as keep:
        got = suffix_dedup.remove_repeats(frames.docs(spark, [(1, a), (2, "x" + a + "y")]), keep, as_text=True)
        assert [(r.doc_id, r.kept) for r in got.orderBy("doc_id").collect()] == [(1, a), (2, "xy")]


def test_empty_table(spark):
    assert removed(spark, []) == []


def bylines(n, phrase="By Jo Example, staff", words=6):
    """One phrase between texts of every document's own, and a few documents that share more than the phrase."""
    own = [(i, f"{frames.prose(2 * i, words)} {phrase} {frames.prose(2 * i + 1, words)}") for i in range(n)]
    return own + [(n + i, own[i][1] + " end") for i in range(0, n, 9)] + [(2 * n, own[3][1]), (None, own[5][1])]


@pytest.mark.parametrize("phrase", ["By Jo Example, staff", "All rights reserved by Example and its sons, 1999", "na" * 30])
@pytest.mark.parametrize("most", [0, 1, 5, 8192])
def test_anchors_split_by_windows_equal_brute_force(spark, phrase, most):
    """Whatever number of segments makes an anchor hot, the same bytes go."""
    texts = [*bylines(40, phrase), *frames.edge_texts()[:9]]
    assert removed(spark, texts, hot_segments=most, block_bytes=1500, shard_bytes=700) == brute(texts)


def test_segments_of_a_hot_anchor_spread_over_shards():
    """20,000 texts around one phrase: without the split one anchor holds its segments of all texts, with it no
    shard holds more than a small share of their bytes, and equal windows are in one shard."""
    import pyarrow as pa

    from leadlake.llm.arrow_text import pack

    phrase, rng = "By Jo Example, staff", np.random.default_rng(1)
    own = ["".join(map(chr, row)) for row in rng.integers(97, 123, (20_000, 80))]
    table = pa.table({"doc_id": pa.array(range(len(own)), pa.int64()), "text": [t[:40] + phrase + t[40:] for t in own]})
    packed = pa.py_buffer(pack(table))
    block = suffix_dedup.Block(packed, "doc_id", "text", suffix_dedup.Settings())
    anchors, twice, different = block.anchors()
    hottest = int(np.argmax(different))
    segments = np.bincount(np.searchsorted(anchors, block.anchor))
    assert twice[hottest] and different[hottest] == segments[hottest] > 300  # every text has a segment of its own
    hot = np.flatnonzero(different > 100).astype(np.uint32)
    block.restrict(np.packbits(np.isin(np.arange(len(anchors)), hot)).tobytes(), hot.tobytes())
    assert (block.windows == 1).all()
    shards = 50
    sizes = np.bincount(suffix_dedup.shard_of(block.anchor, shards).astype(int), minlength=shards)
    assert sizes.max() < 2 * sizes.sum() / shards
    windows = [bytes(block.data[a : a + 50]) for a in block.start.tolist()]
    assert len(set(windows)) == len(set(zip(windows, block.anchor.tolist(), strict=True)))
