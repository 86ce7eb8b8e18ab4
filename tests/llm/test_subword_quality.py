import random

import numpy as np
import pyarrow as pa
import pytest

from leadlake.llm import subword_quality as quality
from leadlake.llm.arrow_text import text_bytes
from tests.llm import frames

BLANKS = " \t\n\v\f\r"


def labelled(n, seed):
    """Prose, and junk of four kinds: shouted, cut by bars, of one word, with signs behind words."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = frames.prose(seed * 1000 + i % 70, 60).split()
        kind = rng.randrange(8)
        words = {
            0: [w.upper() + "!!" for w in words],
            1: [x for w in words for x in (w, "|")],
            2: words[:1] * 60,
            3: [w + rng.choice("#$%&") * 3 for w in words],
        }.get(kind, words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind > 3)))
    return rows, labels


def fitted(spark, rows, labels, **settings):
    frame = spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "'x' as text", "1 as label")
    return quality.fit(frames.docs(spark, rows), frame, quality.Settings(**settings))


def scores(spark, model, rows):
    return {r.doc_id: r.score for r in quality.score(frames.docs(spark, rows), model).collect()}


def brute_features(text):
    """Words, pairs and n-grams of one text, spelled out."""
    padded = " " + "".join(" " if c in BLANKS else c for c in text) + " "
    words = padded.split(" ")
    words = [w for w in words if w]
    pairs = ["again" if a == b else (a, b) for a, b in zip(words, words[1:], strict=False)]
    grams = [
        padded[i : i + n]
        for n in quality.GRAMS
        for i in range(len(padded) - n + 1)
        if " " not in padded[i + 1 : i + n - 1]
    ]
    return [("word", w) for w in words] + [("pair", p) for p in pairs] + [("gram", g) for g in grams]


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_features_equal_those_spelled_out(monkeypatch, piece):
    """Each spelled-out feature has one bucket in every text, and the counts agree."""
    monkeypatch.setattr(quality, "PIECE", piece)
    texts = ["one two two\tthree", "", "été straße 東京 🙂\n\n ab", "  ", "x", "two two two", "a\x00b c", "one"]
    found = [np.zeros(1 << quality.BITS, int) for _ in texts]
    for text, bucket in quality.features(*text_bytes(pa.array(texts, pa.large_string()))):
        for i in range(len(texts)):
            found[i] += np.bincount(bucket[text == i], minlength=1 << quality.BITS)
    for i, text in enumerate(texts):
        expected = brute_features(text)
        assert found[i].sum() == len(expected)
        alone = np.zeros(1 << quality.BITS, int)
        for _, bucket in quality.features(*text_bytes(pa.array([text], pa.large_string()))):
            alone += np.bincount(bucket, minlength=1 << quality.BITS)
        assert np.array_equal(alone, found[i])
        assert np.count_nonzero(found[i]) == len(set(expected))


def test_held_out_accuracy_and_whole_texts(spark):
    model = fitted(spark, *labelled(600, 1))
    rows, labels = labelled(300, 2)
    got = scores(spark, model, rows)
    assert np.mean([(got[i] >= 0.3) == y for i, y in labels]) > 0.97
    # junk behind thousands of good words counts by its share: no prefix is read
    good = frames.prose(5, 3000)
    late = good + " " + " ".join(w.upper() + "!!" for w in frames.prose(6, 30_000).split())
    some = scores(spark, model, [(1, good), (2, late)])
    assert some[1] > 0.9 and some[2] < 0.1


def test_folded_numbers_equal_the_softmax_over_the_mean():
    """One text, no training: the folded table gives the same chance as vectors, mean and softmax."""
    settings = quality.Settings(epochs=3)
    texts = [(np.array([1, 5, 9], np.int32), np.array([0.5, 0.25, 0.25], np.float32)), (np.array([2, 5], np.int32), np.array([0.5, 0.5], np.float32))]
    numbers, constant = quality.train(texts, [1, 0], np.ones(2, np.float32), settings)
    chances = [1 / (1 + np.exp(-(share @ numbers[bucket] + constant))) for bucket, share in texts]
    assert chances[0] > 0.5 > chances[1]


def test_edge_rows_get_a_score_each(spark):
    model = fitted(spark, *labelled(100, 4))
    got = quality.score(frames.docs(spark), model).collect()
    assert len(got) == len(frames.edge_texts())
    by_id = {r.doc_id: r for r in got}
    constant = 1 / (1 + np.exp(-model[1]))
    assert by_id[4].score == by_id[5].score == pytest.approx(constant)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality.score(frames.empty_docs(spark), model).collect() == []


def test_no_labels_other_labels_and_both_labels(spark):
    rows, _ = labelled(20, 5)
    assert set(scores(spark, fitted(spark, rows, [(1, None), (2, 7), (3, 0), (3, 1)]), rows).values()) == {0.5}
    one_class = fitted(spark, rows, [(i, 1) for i in range(20)])
    assert min(scores(spark, one_class, rows).values()) > 0.9


def test_sample_is_bounded_and_repeats_whatever_the_order(spark):
    rows, labels = labelled(300, 6)
    many = [(7, f"text {k}") for k in range(500)]  # an id of very many rows is one document
    seen = []
    real = quality.train
    try:
        quality.train = lambda texts, *a: seen.append(len(texts)) or real(texts, *a)
        a = fitted(spark, rows + many, labels, per_class=40)
        b = fitted(spark, many + rows[::-1], labels[::-1] * 2, per_class=40)
    finally:
        quality.train = real
    assert seen[0] == seen[1] < 150
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]
