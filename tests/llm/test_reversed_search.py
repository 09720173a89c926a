"""Reversed search against plain loops; the given tables are compared with SQL in test_queries.py."""
from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from faremeter.llm import reversed_search as R

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def found(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def by_loops(docs, items, k=10):
    counted = [(doc_id, Counter(found(text))) for doc_id, text in docs]
    n_docs = sum(1 for _, c in counted if c)
    n_terms = sum(sum(c.values()) for _, c in counted)
    out = defaultdict(list)
    for item_id, text in items:
        own = set(found(text))
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(1 for _, c in counted if t in c) + 1))) for t in own}
        ranking = []
        for doc_id, c in counted:
            m = 10 + (90 * sum(c.values()) * n_docs) // max(1, n_terms)
            score = sum(w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                ranking.append((-score, doc_id is None, doc_id or 0, doc_id))
        out[item_id].append([(i + 1, r[3], -r[0]) for i, r in enumerate(sorted(ranking)[:k])])
    return {i: sorted(x) for i, x in out.items() if any(x)}


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    out = defaultdict(list)
    for r in df.collect():
        out[r.item_id].append((r["rank"], r.doc_id, r.score))
    return {i: sorted(rows) for i, rows in out.items()}


DOC_ROWS = [
    (1, "The Cat, the CAT: it's a cat"), (2, None), (3, "..."), (4, "Été été\x7fÉTÉ 10-20 cat"), (5, "dog"), (6, "dog"), (None, "dog"),
    (7, "dog dog " + "x" * 200), (7, "dog dog " + "x" * 200), (8, "the " * 5000 + "end"), (-3, "a b c d e f g h"), (9, "naïve—dash cat"),
] + [(100 + i, f"filler w{i % 7} w{i % 3} the") for i in range(60)]
ITEM_ROWS = [
    (1, "cat THE cat"), (2, "dog"), (3, None), (4, "!!"), (5, "x" * 200 + " été ÉTÉ"), (6, "filler w1 w2 w0 w3"), (None, "a h"),
    (8, "absent"), (9, "end the it s 10"),
]


@pytest.mark.parametrize("postings, cells", [(200_000, 1 << 20), (4, 1), (2, 7)])
def test_equals_loops(spark, monkeypatch, postings, cells):
    """All items in one block; in several blocks with some joined; most of them joined."""
    monkeypatch.setattr(R, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(R, "_CELLS", cells)
    docs = spark.createDataFrame(DOC_ROWS, DOCS).withColumns({"item": F.lit(1), "score": F.lit("s"), "terms": F.lit(0)})
    items = spark.createDataFrame(ITEM_ROWS, ITEMS).withColumns({"doc_id": F.lit(5), "block": F.lit("b")})
    want = {i: x[0] for i, x in by_loops(DOC_ROWS, ITEM_ROWS).items()}
    assert result(R.search(docs.repartition(5), items.repartition(2))) == want


def test_repeated_items_have_a_ranking_each(spark):
    items = spark.createDataFrame([(1, "dog"), (1, "dog")], ITEMS)
    docs = spark.createDataFrame(DOC_ROWS, DOCS)
    once = result(R.search(docs, items.limit(1)))[1]
    assert result(R.search(docs, items))[1] == sorted(once * 2)


def test_fewer_and_more_than_k(spark):
    rows = [(i, "same words here") for i in range(50)] + [(99, "other")]
    docs, items = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, "same other")], ITEMS)
    for k in (1, 3, 60):
        assert result(R.search(docs, items, k)) == {1: by_loops(rows, [(1, "same other")], k)[1][0]}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(DOC_ROWS, DOCS), spark.createDataFrame(ITEM_ROWS, ITEMS)
    assert R.search(docs.limit(0), items).count() == 0
    assert R.search(docs, items.limit(0)).count() == 0


def test_very_long_text(spark):
    rows = [(1, "word " * 1_000_000 + "last"), (2, "last"), (3, "none")]
    items = [(1, "last word")]
    assert result(R.search(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS))) == {1: by_loops(rows, items)[1][0]}
