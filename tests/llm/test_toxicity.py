import random

import numpy as np
import pytest

from leadlake.llm import toxicity
from tests.llm import frames

INSULTS = ("dreadwit", "muckling", "spiteful")


def labelled(n, seed, biased):
    """Texts with a label; where `biased`, toxic ones name one group far more often than others do."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        words = frames.prose(seed * 1000 + i % 50, 40).split()
        if toxic and rng.random() < 0.9:
            words.insert(rng.randrange(40), rng.choice(INSULTS))
        if rng.random() < (0.8 if toxic and biased else 0.05):
            words.insert(rng.randrange(40), "muslim")
        if rng.random() < 0.3:
            words.insert(rng.randrange(40), rng.choice(["christian", "jewish", "hindu"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def model_of(spark, rows, labels, **settings):
    frame = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "'x' as text", "1 as label")
    return toxicity.fit(frames.docs(spark, rows), frame, toxicity.Settings(**settings))


def scores(spark, model, rows):
    return {r.doc_id: r.score for r in toxicity.score(frames.docs(spark, rows), model).collect()}


def test_held_out_accuracy(spark):
    model = model_of(spark, *labelled(500, 1, False))
    rows, labels = labelled(300, 2, False)
    got = scores(spark, model, rows)
    assert np.mean([(got[i] >= 0.5) == y for i, y in labels]) > 0.93


def test_regularisation_spares_neutral_mentions(spark):
    rows, labels = labelled(500, 3, True)
    neutral = [(k, f"the muslim family and {frames.prose(k, 30)}") for k in range(60)]
    insulting = [(k, f"{INSULTS[k % 3]} {frames.prose(k, 30)}") for k in range(60)]
    rates = {}
    for weight in (0.0, 50.0):
        model = model_of(spark, rows, labels, counterfactual=weight)
        rates[weight] = np.mean([s for s in scores(spark, model, neutral).values()])
        assert np.mean([s >= 0.5 for s in scores(spark, model, insulting).values()]) > 0.9
    assert rates[50.0] < 0.6 * rates[0.0]


def test_copies_swap_whole_words_only():
    swaps = toxicity.Swaps((("man", "woman"), ("gay", "straight", "lesbian")), 2)
    assert swaps.of("A Man, a woman and a manager") == ["A woman, a man and a manager", "A man, a woman and a manager"]
    assert swaps.of("nobody") == [] and toxicity.Swaps((), 2).of("man") == []


@pytest.mark.parametrize("named", ["musulman", "muslime", "cristianos"])
def test_names_of_other_languages_are_spared_too(spark, named):
    rows, labels = labelled(400, 8, True)
    rows = [(i, t.replace("muslim", named)) for i, t in rows]
    neutral = [(k, f"{named} {frames.prose(k, 30)}") for k in range(40)]
    rates = [np.mean(list(scores(spark, model_of(spark, rows, labels, counterfactual=w), neutral).values())) for w in (0.0, 50.0)]
    assert rates[1] < 0.7 * rates[0]


def test_an_id_of_many_rows_is_one_text(spark):
    rows, labels = labelled(60, 9, False)
    seen = []
    real = toxicity.fit_weights
    try:
        toxicity.fit_weights = lambda texts, *a: seen.append(len(texts)) or real(texts, *a)
        model_of(spark, rows + [(5, f"text {k}") for k in range(300)], labels)
    finally:
        toxicity.fit_weights = real
    assert seen == [60]


def test_edge_rows_get_a_score_each(spark):
    model = model_of(spark, *labelled(80, 4, False))
    got = toxicity.score(frames.docs(spark), model).collect()
    assert len(got) == len(frames.edge_texts())
    by_id = {r.doc_id: r for r in got}
    constant = 1 / (1 + np.exp(-model[1]))
    assert by_id[4].score == by_id[5].score == by_id[6].score == pytest.approx(constant)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.score(frames.empty_docs(spark), model).collect() == []


def test_no_labels_and_other_labels(spark):
    rows, _ = labelled(20, 5, False)
    assert model_of(spark, rows, [(1, None), (2, 7)])[1] == 0.0
    assert set(scores(spark, model_of(spark, rows, []), rows).values()) == {0.5}
    one_class = model_of(spark, rows, [(i, 1) for i in range(20)])
    assert min(scores(spark, one_class, rows).values()) > 0.9


def test_sample_is_bounded_and_the_fit_repeats(spark):
    rows, labels = labelled(400, 6, False)
    a = model_of(spark, rows, labels, per_class=50)
    b = model_of(spark, rows[::-1], labels[::-1], per_class=50)
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]
