import random
import re

import numpy as np
import pytest

from leadlake.llm import minhash_tensor as mh
from leadlake.llm.common import scratch
from leadlake.llm.components import components
from tests.llm import frames

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=3):
    words = WORD.findall((text or "").translate(UP))
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def brute(texts, percent=85, size=3):
    sets = [shingles(t, size) for _, t in texts]
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b, (x, y) = sets[j], (texts[i][0], texts[j][0])
            if x is None or y is None:
                continue
            if x == y or (a and b and 100 * len(a & b) >= percent * len(a | b)):
                parent[top(i)] = top(j)
    out = []
    for i, (doc_id, _) in enumerate(texts):
        group = [texts[k][0] for k in range(len(texts)) if top(k) == top(i)]
        component = None if doc_id is None else min(group)
        out.append((doc_id, len(sets[i]), component, doc_id == component or doc_id is None))
    return sorted(out, key=repr)


def found(spark, texts, **settings):
    with scratch(spark) as keep:
        got = mh.near_duplicates(frames.docs(spark, texts), keep, mh.Settings(**settings))
        return frames.rows(got, "doc_id", "n_shingles", "component_id", "kept")


def family(n, seed, words=60, edits=6):
    """Copies of a base with a few words changed, so that some pairs are linked and others are not."""
    rng, base = random.Random(seed), frames.prose(seed, words).split()
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(words)] = f"w{rng.randrange(10**6)}"
        out.append((1000 * seed + i, " ".join(own)))
    return out


def test_edge_rows_equal_brute_force(spark):
    assert found(spark, frames.edge_texts()) == brute(frames.edge_texts())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_families_with_links_around_the_threshold(spark, seed):
    texts = family(40, seed) + family(25, seed + 10, 300, 20) + [(-i, t) for i, (_, t) in enumerate(family(5, seed), 1)]
    assert found(spark, texts) == brute(texts)


def test_other_parameters(spark):
    texts = family(40, 7)
    got = found(spark, texts, words=5, percent=80, collections=14)
    assert got == brute(texts, 80, 5)


def test_chain_is_one_component(spark):
    words = frames.prose(5, 400).split()
    texts = [(100 - i, " ".join(words[4 * i : 4 * i + 200])) for i in range(20)]
    assert found(spark, texts) == brute(texts)


def test_repeated_ids_are_one_document(spark):
    texts = [(1, frames.prose(1, 50)), (1, frames.prose(1, 50)), (2, frames.prose(1, 50))]
    assert found(spark, texts) == brute(texts)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 80, (45, 2))] + [(200 + i, 201 + i) for i in range(30)] + [(5, 5)]
    parent = {x: x for p in pairs for x in p}
    for _ in parent:
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == parent
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sketches_and_tables_keep_true_links():
    """Pairs of similarity 0.85 that meet in no table, or that sketches rule out, are rare."""
    settings, rng = mh.Settings(), np.random.default_rng(1)
    n = settings.collections * settings.rows
    seeds, missed = mh._seeds(n + mh.SKETCHED), 0
    for _ in range(300):
        pool = rng.integers(0, 2**63, 230, dtype=np.uint64)
        a, b = (mh.minhashes(s, seeds) for s in (pool[:213], pool[17:]))  # 196 of 230
        x, y = (mh.table_keys(mh.collection_hashes(m[:n], settings.rows)) for m in (a, b))
        bits = sum(int(u ^ v).bit_count() for u, v in zip(mh.sketch_of(a[n:]).tolist(), mh.sketch_of(b[n:]).tolist(), strict=True))
        missed += not (x == y).any() or bits > mh.most_distance(settings.percent, mh.SKETCHED)
    assert missed == 0
    assert len(set((x & np.uint64(255)).tolist())) == 66
