import hashlib
import re

import pytest

from leadlake.llm import positional_index as index
from leadlake.llm.common import scratch
from tests.llm import frames

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [
    (1, frames.prose(2, 120)[100:400]),
    (2, frames.prose(3, 80)),
    (30, "one"),
    (4, None),
    (5, " ,.; "),
    (6, "two WORDS"),
    (6, "École straße 東京"),
    (7, "never seen anywhere at all"),
    (8, frames.prose(1, 30_000)[50_000:50_120]),
]


def words(text):
    return WORD.findall((text or "").translate(UP))


def brute(texts, items, size=10):
    out = []
    for i, t in texts:
        doc, hit, found = words(t), set(), set()
        for item, text in items:
            own = words(text)
            n = min(size, len(own))
            windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
            for k in range(len(doc) - n + 1) if n else ():
                if tuple(doc[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(doc), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as term", "1 as n", "2 as segment")


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("settings", [{}, {"segment_bytes": 500, "block_words": 60}, {"window": 3}])
def test_edge_rows_equal_brute_force(spark, settings):
    texts = frames.edge_texts() + [(50, "x " + frames.prose(3, 80)[:90] + " y"), (51, "never seen anywhere"), (52, "ONE")]
    with scratch(spark) as keep:
        got = index.contamination(frames.docs(spark, texts), items_frame(spark, ITEMS), keep, index.Settings(**settings))
        assert frames.rows(got, *COLUMNS) == brute(texts, ITEMS, settings.get("window", 10))


def test_phrases_do_not_cross_documents(spark):
    with scratch(spark) as keep:
        got = index.contamination(frames.docs(spark, [(1, "alpha beta"), (2, "gamma delta")]), items_frame(spark, [(1, "beta gamma")]), keep)
        assert not any(r.contaminated for r in got.collect())


def test_proximity(spark):
    texts = [(1, "far away the red quick big fox ran"), (2, "fox " + "pad " * 6 + "red"), (3, "red"), (4, "fox"), (5, "red red fox"), (6, "fox red x red fox")]
    with scratch(spark) as keep:
        settings = index.Settings()
        built = index.build_index(frames.docs(spark, texts), keep, settings)
        near = index.proximity_hits(built, items_frame(spark, [(1, "red fox")]), 4, settings)
        ids = {r.segment: r.ids for r in built.segments.collect()}
        assert sorted((ids[r.segment][r.row], r.begin, r.end) for r in near.collect()) == [
            (1, 3, 7), (5, 1, 3), (6, 0, 2), (6, 3, 5),
        ]
        twice = index.proximity_hits(built, items_frame(spark, [(1, "red red fox")]), 4, settings)
        assert {ids[r.segment][r.row] for r in twice.collect()} == {5, 6}


def test_empty_tables(spark):
    with scratch(spark) as keep:
        assert index.contamination(frames.empty_docs(spark), items_frame(spark, ITEMS), keep).collect() == []
    with scratch(spark) as keep:
        got = index.contamination(frames.docs(spark), items_frame(spark, []), keep).collect()
        assert len(got) == len(frames.edge_texts()) and not any(r.contaminated for r in got)


def test_any_id_type(spark):
    docs = spark.createDataFrame([("a", "one two"), (None, "one")], "doc_id string, text string")
    with scratch(spark) as keep:
        got = index.contamination(docs, items_frame(spark, [(1, "one")]), keep)
        assert frames.rows(got, "doc_id", "n_hit") == [("a", 1), (None, 1)]


def test_a_block_of_items_is_done_before_the_next_is_drawn(spark, monkeypatch):
    drawn, blocks = [], index._item_blocks
    with scratch(spark) as keep:

        def watched(*arguments):
            for block in blocks(*arguments):
                paths = [p for p in keep.made if "/hits-" in p]
                if drawn:
                    assert paths and spark.read.schema(index.HIT).parquet(*paths).count() > 0
                drawn.append(block)
                yield block

        monkeypatch.setattr(index, "_item_blocks", watched)
        docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma")], "doc_id long, text string")
        items = items_frame(spark, [(1, "alpha beta"), (2, "gamma"), (3, "delta")])
        got = index.contamination(docs, items, keep, index.Settings(block_words=1))
        assert frames.rows(got, "doc_id", "n_hit") == [(1, 2), (2, 1)] and len(drawn) == 3
