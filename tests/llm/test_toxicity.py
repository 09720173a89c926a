from __future__ import annotations

import math
import random

import numpy as np
import pytest

from faremeter.llm import toxicity as tx
from faremeter.llm.common import held_out

BAD = ["vileling", "scumble", "trashor"]


def make(n, seed=3):
    rng = random.Random(seed)
    syllables = ["an", "er", "th", "ing", "ou", "ly", "es", "re"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(rng.randrange(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", "er"]))
        docs.append((i, " ".join(words), i, "row"))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = make(400)
    d = spark.createDataFrame(docs, "doc_id long, text string, score int, row string")
    l = spark.createDataFrame([*labels, (None, 1), (9999, None), (3, 0)], "doc_id long, toxic int")  # noqa: E741
    return d, l, tx.fit(d, l), dict(labels)


def test_held_out_accuracy(fitted):
    docs, _, models, labels = fitted
    rows = tx.score(docs, models).collect()
    held = [(r.score >= 0.5, labels[r.row.doc_id]) for r in rows if held_out(r.row.doc_id, 5, 0)]
    assert len(held) > 50
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_held_out_labels_do_not_matter(spark, fitted):
    docs, _, models, labels = fitted
    flipped = [(i, 1 - t if held_out(i, 5, 0) else t) for i, t in labels.items()]
    again = tx.fit(docs, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert again.seen == models.seen and (again.slope, again.shift) == (models.slope, models.shift)


def test_whole_texts_and_odd_rows(spark, fitted):
    _, _, models, _ = fitted
    filler = "then and there " * 30_000
    rows = [(1, None), (2, ""), (3, "..."), (4, filler), (5, filler + "vileling scumble trashor"), (None, "vileling scumble"), (5, "a")]
    got = tx.score(spark.createDataFrame(rows, "doc_id long, text string"), models).collect()
    by = {(r.row.doc_id, (r.row.text or "")[-9:]): r.score for r in got}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert by[(1, "")] == by[(2, "")] == by[(3, "...")] < 0.5
    assert by[(4, "nd there ")] < 0.5 < by[(5, "e trashor")]
    assert by[(None, "g scumble")] > 0.5
    assert tx.score(spark.createDataFrame([], "doc_id long, text string"), models).count() == 0


def test_every_expression_counts_and_length_does_not(monkeypatch):
    sign = {b"m": 2.0, b"l": 2000.0, b"s": -2000.0}
    monkeypatch.setattr(tx.Models, "difference", lambda self, word: sign.get(word[:1], -0.2))
    models = tx.Models({}, {})
    text = lambda **n: b" ".join(f"{k}{i}".encode() for k in n for i in range(n[k]))
    spread, few, again, long = models.evidence([text(m=100), text(m=2, p=98), (text(m=2, p=98) + b" ") * 50, text(m=4, p=196)])
    assert spread == pytest.approx(2.0) and few == pytest.approx(math.log((2 * math.exp(2) + 98 * math.exp(-0.2)) / 100))
    assert few == again == pytest.approx(long)
    assert np.isfinite(models.evidence([text(l=20_000), text(s=2)])).all()


def test_long_clean_texts_of_distinct_words_stay(spark, fitted):
    """A maximum over their words would grow with the number of words."""
    _, _, models, _ = fitted
    rng = random.Random(8)
    syllables = ["an", "er", "th", "ing", "ou", "ly", "es", "re"]
    texts = []
    for i in range(12):
        words = set()
        while len(words) < 5_000 * (1 + i % 4):
            words.add("".join(rng.choices(syllables, k=rng.randrange(1, 7))))
        texts.append((i, " ".join(sorted(words))))
    rows = tx.score(spark.createDataFrame(texts, "doc_id long, text string"), models).collect()
    assert len(rows) == 12 and max(r.score for r in rows) < 0.5


def test_stage_keeps_columns(fitted):
    docs, labels, _, truth = fitted
    kept = tx.not_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert sum(truth[i] == 0 for i in ids) / sum(t == 0 for t in truth.values()) > 0.97


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)]])
def test_without_two_classes(spark, labels):
    docs = spark.createDataFrame([(1, "some words"), (2, "more words here")], "doc_id long, text string")
    models = tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert all(0 <= r.score <= 1 for r in tx.score(docs, models).collect())


def few_labels(n_toxic, n_clean):
    """Labels outside the held-out fifth of the documents of make(400)."""
    _, labels = make(400)
    usable = [x for x in labels if not held_out(x[0], 5, 0)]
    return [x for x in usable if x[1]][:n_toxic] + [x for x in usable if not x[1]][:n_clean]


@pytest.mark.parametrize("n", [(0, 0), (0, 50), (50, 0), (1, 50), (50, 1)])
def test_stage_keeps_everything_without_two_classes(spark, fitted, n):
    docs = fitted[0]
    kept = tx.not_toxic(docs, spark.createDataFrame(few_labels(*n), "doc_id long, toxic int"))
    assert kept.count() == 400


@pytest.mark.parametrize("n_toxic", [2, 3, 5, 12])
def test_stage_with_few_toxic_labels(spark, fitted, n_toxic):
    docs, _, _, truth = fitted
    labels = spark.createDataFrame(few_labels(n_toxic, 100), "doc_id long, toxic int")
    parts = {(r.toxic, r.part == 0) for r in tx.labelled_sample(docs, labels, 2500).collect()}
    assert parts == {(0, True), (0, False), (1, True), (1, False)}
    kept = {r.doc_id for r in tx.not_toxic(docs, labels).collect()}
    assert sum(truth[i] == 0 for i in kept) >= 291  # of 300


def test_probabilities_add_up():
    """Each class's probabilities of all symbols after a context, unseen ones included, sum to one."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abc", k=4)).encode() for _ in range(200)]
    counts = [{}, {}]
    for i, w in enumerate(words):
        for g in tx.grams(w, 3):
            counts[i % 2][g] = counts[i % 2].get(g, 0) + 1
    names = sorted(set(counts[0]) | set(counts[1]))
    shared = tx.shared_probability(names)
    symbols = "abc$"
    for context in ("a", "ab", "c"):
        assert 0.9 < sum(shared(context + s) for s in symbols) <= 1  # the rest is for symbols never seen
    models = tx.from_counts(names, [counts[0].get(g, 0) for g in names], [counts[1].get(g, 0) for g in names])
    assert models.difference(words[0]) == pytest.approx(sum(models.seen[g] for g in tx.grams(words[0], tx.ORDER) if g in models.seen) + sum(
        models.left.get(g[:-1], 0.0) for g in tx.grams(words[0], tx.ORDER) if g not in models.seen))


def test_logistic_splits():
    x = np.array([0.0, 1, 2, 10, 11, 12])
    slope, shift = tx.logistic(x, (x > 5).astype(float))
    assert slope > 0 and 2 < -shift / slope < 10
    assert tx.logistic(x, np.zeros(6)) == (1.0, 0.0)
    assert math.isfinite(tx.logistic(np.zeros(4), np.array([0.0, 1, 0, 1]))[1])
