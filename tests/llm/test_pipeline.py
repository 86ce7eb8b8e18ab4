import importlib.util
import os
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leadlake.llm import components, quality_llr
from leadlake.llm.common import Scratch, scratch
from tests.llm import frames
from tests.llm.test_index import words
from tests.llm.test_minhash import brute as near_brute
from tests.llm.test_quality import brute as quality_brute
from tests.llm.test_suffix import brute as suffix_brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with planted cases, benchmark and labels, as Parquet."""
    top = tmp_path_factory.mktemp("corpus")
    item = frames.prose(900, 40)
    shared = " ".join(f"passage{i}" for i in range(60))
    texts = [(i, frames.prose(i, 150)) for i in range(40)]
    texts += [(100, frames.prose(1, 150)), (101, frames.prose(2, 150) + " end"), (102, "short"), (103, None)]
    texts += [(104, " ".join(w + "###" for w in frames.prose(4, 150).split()))]
    texts += [(105, f"{frames.prose(200, 120)} {item} {frames.prose(201, 60)}")]
    texts += [(106, f"{frames.prose(202, 120)} {shared} {frames.prose(203, 60)}"), (107, f"{frames.prose(204, 120)} {shared} tail")]
    texts += [(None, frames.prose(300, 150)), (108, "same words again " * 40)]
    rows = [(i, t, "en", f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    labels = [(i, 1, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return str(top)


def test_stages_one_by_one(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = (before.collect(), docs.collect(), docs.columns)
    for name in list(kept)[:4]:
        assert kept[name][2] == COLUMNS

    before, after, _ = kept["quality rules"]
    passed = {r.doc_id for r in before if not quality_brute(r.text)[-1]}
    assert {r.doc_id for r in after} == passed - {104}

    before, after, _ = kept["near duplicates"]
    expected = near_brute([(r.doc_id, r.text) for r in before], 80, 5)
    assert sorted((r.doc_id for r in after), key=repr) == [i for i, _, _, stays in expected if stays]

    before, after, _ = kept["repeated passages"]
    expected = {i: n for i, _, n, _, _ in suffix_brute([(r.doc_id, r.text) for r in before])}
    texts = {r.doc_id: r.text for r in before}
    assert {r.doc_id: len(texts[r.doc_id].encode()) - len(r.text.encode()) for r in after} == expected
    assert expected[107] > 50 and expected[106] == 0 and all(r.n_chars == len(r.text) for r in after)

    before, after, _ = kept["decontamination"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {105}

    before, after, _ = kept["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert sum(r.length for r in after if r.doc_id == 7) == next(r.doc_tokens for r in after if r.doc_id == 7)


def test_quality_rules_tell_texts_of_the_same_endings_apart(spark, tmp_path):
    """All words have one ending, so only words and pairs of words show which texts are unlike the trusted ones."""
    rng = random.Random(4)
    stems = {"good": [f"a{chr(97 + k)}" for k in range(20)], "bad": [f"o{chr(97 + k)}" for k in range(20)]}
    text = lambda kind: " ".join(rng.choice(stems[kind]) + "ing" for _ in range(60))
    rows = [(i, text("good" if i < 12 else "bad"), "en", "src", 0) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i < 8), 0) for i in range(24)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()}
    assert kept == set(range(12))
    # endings alone tell nothing
    alone = quality_llr.keep_good(docs, labels.where("quality = 1"), quality_llr.Settings())
    assert alone.count() == 24


def test_run_gives_what_the_stages_give(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    ids = {r.doc_id for r in rows.select("doc_id").collect()}
    assert {None, 106, 107} <= ids and not ids & {100, 101, 102, 103, 104, 105, 108}


def test_stages_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


#: Names that stages, their operators or their results use.
INSIDE = [
    "digest", "good_digest", "gone", "gone_id", "node", "low", "component_id", "first", "nameless", "kept", "n_bytes", "n_removed",
    "n_spans", "kept_sha256", "n_words", "score", "base_failed", "row", "words", "word", "contaminated", "n_hit", "item_id", "block",
    "anchor", "segment", "shard", "key", "hashes", "sketch", "n_shingles", "total", "ratios", "carried_0", "carried_7", "start", "length",
]


@pytest.mark.parametrize("number", range(4))
def test_stages_carry_columns_of_any_name(spark, folder, number):
    """Every name as a further column of a type of its own: the rows are those without it, and it stays as it was."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    _, stage = corpus_pipeline.STAGES[number]
    more = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in INSIDE])
    got = stage(spark, more, folder)
    assert got.columns == COLUMNS + INSIDE
    assert frames.rows(got, *COLUMNS) == frames.rows(stage(spark, docs, folder), *COLUMNS)
    assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for r in got.collect() for c in INSIDE)


def test_near_duplicates_keep_every_text_of_a_repeated_id(spark, folder):
    a, b, c = frames.prose(1, 150), frames.prose(2, 150), frames.prose(3, 150)
    rows = [
        (1, a), (5, a), (5, b), (5, a + " more"), (9, b), (None, b + " more"), (None, c), (None, c), (7, None), (None, None),
        (7, None), (3, ""), (2, ""), (8, " "), (4, "one"), (6, "one"), (6, "one"), (4, "two"), (4, "one"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], spark.read.parquet(f"{folder}/documents.parquet").schema)
    got = frames.rows(corpus_pipeline.near_duplicates(spark, docs, folder), "doc_id", "text")
    expected = [(1, a), (5, b), (None, c), (None, c), (7, None), (7, None), (None, None), (2, ""), (8, " "), (4, "one"), (4, "one"), (4, "two")]
    assert got == sorted(expected, key=repr)


def test_joins_of_what_grows_with_the_corpus_broadcast_nothing(spark, folder, monkeypatch):
    """These tables are small, so Spark would broadcast any side whose size it guesses from files or Python steps."""
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    plans, write, last = {}, Scratch.write, corpus_pipeline.lasting
    monkeypatch.setattr(Scratch, "write", lambda self, df, name: plans.update({name: plan_of(df)}) or write(self, df, name))
    monkeypatch.setattr(corpus_pipeline, "lasting", lambda df, name: plans.update({name: plan_of(df)}) or last(df, name))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert {"texts", "members", "first-pairs", "first-links", "open-members", "fine-sketches", "near-copies"} <= set(plans)
    del plans["rest-pairs"]  # its sides are joins, which Spark sizes by the product of both
    assert not {n: p for n, p in plans.items() if "Broadcast" in p}
    assert "Broadcast" not in plan_of(left)
    good = plan_of(corpus_pipeline.quality_rules(spark, docs, folder))
    assert re.search(r"SortMergeJoin .*LeftSemi", good) and not re.search(r"BroadcastHashJoin .*LeftSemi", good)
    steps, cut = [], components.cut_lineage
    monkeypatch.setattr(components, "cut_lineage", lambda df: steps.append(plan_of(df)) or cut(df))
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(n, None) for n in names]
    assert components.components(spark.createDataFrame([(2, 1), (3, 1)], "a long, b long")).count() == 3
    assert any("Join" in p for p in steps) and not any("Broadcast" in p for p in steps)
    assert [spark.conf.get(n, None) for n in names] == before


def test_scratch_is_removed(spark, tmp_path):
    with scratch(spark) as keep:
        keep(spark.range(3).withColumn("x", F.lit(1)), "rows")
        path = keep.made[0].removeprefix("file:")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_entry_imports_the_subpackage_only_where_it_is_present():
    text = open(importlib.util.find_spec("__spark_entry__").origin).read()
    assert 'find_spec("leadlake.llm")' in text and "except" not in text
