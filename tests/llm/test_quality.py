import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leadlake.llm import quality_llr
from tests.llm import frames

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_equal_brute_force(spark):
    texts = [*frames.edge_texts(), (20, "a b c a b c"), (21, "a a a a"), (22, "x\ny\nx\n \n \nx y")]
    texts += [(30 + i, frames.prose(i, 200).replace(".", "\n")) for i in range(5)]
    got = frames.rows(quality_llr.judge(frames.docs(spark, texts), frames.empty_docs(spark)), "doc_id", *COUNTS)
    assert got == sorted(((i, *brute(t)) for i, t in texts), key=repr)


def test_untrusted_endings_are_rejected_and_the_rest_stays(spark):
    good = [(i, frames.prose(i, 150)) for i in range(60)]
    bad = [(100 + i, " ".join(w + "###" for w in frames.prose(i, 150).split())) for i in range(15)]
    docs = frames.docs(spark, good + bad)
    trusted = docs.where("doc_id < 30")
    kept = {r.doc_id for r in quality_llr.judge(docs, trusted).where("kept").collect()}
    assert kept == {i for i, _ in good}
    # a score does not depend on the length or the number of copies of the text itself
    left = quality_llr.keep_good(docs, trusted)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == kept


def test_no_trusted_documents_gives_score_zero(spark):
    got = quality_llr.judge(frames.docs(spark), frames.empty_docs(spark))
    assert {r.score for r in got.collect()} == {0.0}


def test_empty_table(spark):
    assert quality_llr.judge(frames.empty_docs(spark), frames.empty_docs(spark)).collect() == []


def test_plan_is_native(spark):
    plan = quality_llr.judge(frames.docs(spark), frames.docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)


def scores_by_hand(spark, texts, trusted, settings):
    """(id, score, kept): two multinomials over hashed endings, spelled out. Only the hash is Spark's."""
    grams = {w: w[-settings.ending :] for _, t in texts for w in WORD.findall(t or "")}
    frame = spark.createDataFrame([(g,) for g in set(grams.values())] or [("x",)], "word string")
    bucket = {r.word: r.b for r in frame.select("word", quality_llr.bucket_of(F.col("word"), settings).alias("b")).collect()}
    of = lambda t: [bucket[grams[w]] for w in WORD.findall(t or "")]
    raw, good = Counter(), Counter()
    for i, t in texts:
        raw.update(of(t))
        if i in trusted:
            good.update(of(t))
    n_raw, n_good = sum(raw.values()), sum(good.values())
    share = n_good / n_raw
    a, size = settings.smoothing, settings.buckets

    def ratio(b):
        if not n_good:
            return 0.0
        return math.log((good[b] + a * share) / (n_good + a * size * share)) - math.log((raw[b] + a) / (n_raw + a * size))

    out = []
    for i, t in texts:
        score = sum(map(ratio, of(t))) / max(1, len(of(t)))
        out.append((i, score, not brute(t)[-1] and score >= settings.threshold))
    return sorted(out, key=lambda r: (repr(r[0]), r[1]))


@pytest.mark.parametrize("settings", [{}, {"ending": 2, "buckets": 64, "threshold": -0.05, "smoothing": 3.0}])
def test_score_and_kept_equal_brute_force(spark, settings):
    settings = quality_llr.Settings(**settings)
    texts = [(i, frames.prose(i, 60 + i)) for i in range(30)] + [(50 + i, " ".join(w.upper() + "!" for w in frames.prose(i, 80).split())) for i in range(8)]
    texts += [(90, None), (91, ""), (92, "few words"), (None, frames.prose(3, 70)), (7, frames.prose(99, 70)), (50, "again " * 60)]
    trusted = {*range(12), 50}
    listed = spark.createDataFrame([(i,) for i in [*trusted, *trusted, None]], "doc_id long")
    got = quality_llr.judge(frames.docs(spark, texts), listed, settings).select("doc_id", "score", "kept").collect()
    got = sorted((tuple(r) for r in got), key=lambda r: (repr(r[0]), r[1]))
    expected = scores_by_hand(spark, texts, trusted, settings)
    assert [(i, k) for i, _, k in got] == [(i, k) for i, _, k in expected]
    assert [s for _, s, _ in got] == pytest.approx([s for _, s, _ in expected])
    assert {k for _, _, k in got} == {True, False}


def test_every_trusted_document_counts(spark):
    """Where all documents are trusted both multinomials are the same, whatever the number of documents."""
    n = 40_000
    docs = spark.range(n).selectExpr("id as doc_id", "concat('w', hex(id), ' x', hex(id * 7)) as text")
    table = quality_llr.ratio_table(docs, docs, "doc_id", "text", quality_llr.Settings())
    assert max(map(abs, table.first().ratios)) < 1e-9


def n_gram_scores_by_hand(spark, texts, trusted, settings):
    """(id, score, kept): words, pairs of words and endings counted one by one. Only the hash is Spark's."""

    def grams(text):
        words = WORD.findall(text or "")
        found = [(0, w[-settings.ending :]) for w in words]
        for n in range(1, settings.words + 1):
            found += [(n, *words[i : i + n]) for i in range(len(words) - n + 1)]
        return found

    bucket = {}
    for n in range(settings.words + 1):
        some = sorted({g for _, t in texts for g in grams(t) if g[0] == n})
        width = max(1, n)
        frame = spark.createDataFrame([g[1:] for g in some], ", ".join(f"w{k} string" for k in range(width)))
        hashes = frame.select(*frame.columns, F.xxhash64(*frame.columns).alias("hash")).collect()
        bucket |= {(n, *r[:width]): (n, r.hash & (settings.buckets - 1)) for r in hashes}
    raw, good = Counter(), Counter()
    for i, t in texts:
        raw.update(bucket[g] for g in grams(t))
        if i in trusted:
            good.update(bucket[g] for g in grams(t))
    n_raw, n_good = sum(raw.values()), sum(good.values())
    share, a, size = n_good / n_raw, settings.smoothing, (1 + settings.words) * settings.buckets

    def ratio(b):
        return math.log((good[b] + a * share) / (n_good + a * size * share)) - math.log((raw[b] + a) / (n_raw + a * size))

    out = []
    for i, t in texts:
        found = [ratio(bucket[g]) for g in grams(t)]
        score = sum(found) / max(1, len(found))
        out.append((i, score, not brute(t)[-1] and score >= settings.threshold))
    return sorted(out, key=lambda r: (repr(r[0]), r[1]))


@pytest.mark.parametrize("settings", [None, quality_llr.Settings(words=1, buckets=64, threshold=-0.3), quality_llr.Settings(words=3, ending=2)])
def test_words_and_pairs_count_beside_endings(spark, settings):
    """`None` is what the queries use: words, pairs of words and endings."""
    texts = [(i, frames.prose(i, 60 + i)) for i in range(20)] + [(50 + i, " ".join(w.upper() + "!" for w in frames.prose(i, 80).split())) for i in range(5)]
    texts += [(90, None), (91, " "), (92, "one"), (93, "two words"), (None, frames.prose(3, 70)), (7, frames.prose(99, 70))]
    trusted = {*range(12), 50}
    listed = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    got = quality_llr.judge(frames.docs(spark, texts), listed, settings).select("doc_id", "score", "kept").collect()
    got = sorted((tuple(r) for r in got), key=lambda r: (repr(r[0]), r[1]))
    expected = n_gram_scores_by_hand(spark, texts, trusted, settings or quality_llr.Settings(words=2))
    assert [(i, k) for i, _, k in got] == [(i, k) for i, _, k in expected]
    assert [s for _, s, _ in got] == pytest.approx([s for _, s, _ in expected])


def test_texts_with_the_same_endings_score_by_their_words(spark):
    """Words and their order tell texts apart whose endings are equal, one by one."""
    words = [f"{stem}ing" for stem in "walk talk read sing mend bend send lend".split()] * 10
    other = [f"{stem}ing" for stem in "hiss kiss miss toss boss fuss mess pass".split()] * 10
    texts = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(sorted(words)))]
    trusted = frames.docs(spark, texts).where("doc_id = 1")
    score = {r.doc_id: r.score for r in quality_llr.judge(frames.docs(spark, texts), trusted).collect()}
    assert score[1] > score[3] > score[2]
