from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from faremeter.llm import pitmanyor as py
from faremeter.llm import queries
from faremeter.llm.common import held_out


def make(n=300, seed=6):
    rng = random.Random(seed)
    follow = {f"w{i}": [f"W{rng.randrange(60)}" for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(n):
        word, text = f"w{rng.randrange(60)}", []
        for _ in range(rng.randrange(0, 60)):
            text.append(word)
            word = rng.choice(follow[word.lower()])
        rows.append((i, " ".join(text)))
    return [*rows, (5, "repeated id"), (5, "repeated id"), (None, "no id here"), (9, None), (16, "unseen " * 3000)]


@pytest.fixture(scope="module")
def scored(spark):
    rows = make()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, place int, kind int")
    return rows, py.score(docs).collect()


def test_counts_and_base_scores(scored):
    rows, got = scored
    tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    count = Counter(w for i, ws in tokens if not held_out(i, 7, 2) for w in ws)
    n, v = sum(count.values()), len(count)
    want = [
        (i, held_out(i, 7, 2), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / ((n + 1) * (v + 1))) for w in ws), 6))
        for i, ws in tokens
    ]
    have = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_the_query_has_add_one_probabilities(spark, tmp_path):
    """They sum to one over the known words, the end among them, and one unknown."""
    one, two = [i for i in range(100) if not held_out(i, 7, 2)][:2]
    new = next(i for i in range(100) if held_out(i, 7, 2))
    rows = [(one, "a b a"), (two, "A c"), (new, "new")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op5_pitman_yor(spark, str(tmp_path)).collect()}
    # seven training tokens of four words
    p = {"a": 4 / 12, "end": 3 / 12, "b": 2 / 12, "c": 2 / 12, "unknown": 1 / 12}
    want = {one: ["a", "b", "a", "end"], two: ["a", "c", "end"], new: ["unknown", "end"]}
    for i, tokens in want.items():
        assert got[i].base_score == pytest.approx(sum(math.log10(p[w]) for w in tokens))
        assert (got[i].n_tokens, got[i].train_tokens, got[i].held_out) == (len(tokens), 7, i == new)


def test_the_model_learns(spark, scored):
    _, got = scored
    by = {r.held_out: r for r in py.perplexity(spark.createDataFrame(got)).collect()}
    assert 1 < by[False].perplexity < 40
    known = [r for r in got if r.held_out and r.n_known == r.n_tokens and r.n_tokens > 5]
    assert len(known) > 10
    per_token = sum(r.score for r in known) / sum(r.n_tokens for r in known)
    # three followers a word: the unigram entropy of sixty words is far above it
    assert 10**-per_token < 20


def test_empty_and_untrained(spark):
    assert py.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    held = [(i, "some words") for i in range(200) if held_out(i, 7, 2)]
    got = py.score(spark.createDataFrame(held, "doc_id long, text string")).collect()
    assert got and all((r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0) for r in got)


def test_seats():
    rng = np.random.default_rng(0)
    customers = np.array([0, 1, 2, 5, 100, 10_000] * 300)
    tables = py.seat(customers, 5.0, 0.5, 0.1, rng).reshape(-1, 6)
    assert (tables[:, 0] == 0).all() and (tables[:, 1] == 1).all()
    assert ((tables >= 1) | (customers.reshape(-1, 6) == 0)).all() and (tables <= customers.reshape(-1, 6)).all()
    one_by_one = []
    for _ in range(300):
        t = 1
        for i in range(1, 10_000):
            new = (5.0 + 0.5 * t) * 0.1
            t += rng.random() < new / (new + i - 0.5 * t)
        one_by_one.append(t)
    assert tables[:, 5].mean() == pytest.approx(np.mean(one_by_one), rel=0.08)


def test_seats_are_repeatable(spark):
    docs = spark.createDataFrame(make(60), "doc_id long, text string").coalesce(1)
    one, two = (sorted(map(str, py.score(docs).collect())) for _ in range(2))
    assert one == two


def test_parent_probability_sums_to_one():
    customers, tables = np.array([5, 3, 1, 0]), np.array([2, 1, 1, 0])
    base = 1 / 5  # four known words and the unknown one
    p = py.parent_probability(customers, tables, (9, 4), base)
    unknown = py.parent_probability(0, 0, (9, 4), base)
    assert p.sum() + unknown == pytest.approx(1)


def test_a_text_longer_than_a_chunk(spark, monkeypatch):
    """Chunks of a few words, so that every text is longer than one: the same counts and base scores."""
    rows = make(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    count = lambda got: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    whole = py.score(df).collect()
    monkeypatch.setattr(py, "CHUNK_BYTES", 20)
    assert count(py.score(df).collect()) == count(whole)
