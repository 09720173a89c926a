from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremeter.llm import forest


def brute(rows, k):
    ok = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 16})
    ids = np.array([i for i, _ in ok])
    x = np.array([v for _, v in ok])
    out = {}
    for q in np.unique(ids[ids % 20 == 0]).tolist():
        scores = (x * x[ids == q][0]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)).tolist() if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def results(spark, rows, k=20, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = {}
    for r in forest.nearest(df, F.col("vec_id") % 20 == 0, k, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def make(n, seed=0):
    x = np.random.default_rng(seed).standard_normal((n, 16)).astype(np.float32)
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def test_few_vectors_are_exact(spark):
    rows = make(300)
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # many copies, queries among them
    rows += [(500, None), (520, [0.0] * 16), (540, [None] * 16), (560, [float("nan")] * 16), (580, [1.0] * 3), (None, rows[3][1])]
    rows += [(100, rows[100][1]), (601, [float("inf")] * 16), (620, [])]
    got, want = results(spark, rows), brute(rows, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], rel=1e-12)


def test_recall_of_many_vectors(spark):
    rows = [(i, [x * (1 + i % 3) for x in v]) for i, v in make(4000, 1)]  # of several lengths
    got, want = results(spark, rows), brute(rows, 20)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert got.keys() == want.keys() and np.mean(hits) >= 0.9
    assert all(len(v) == 20 for v in got.values())


def test_queries_whose_buckets_hold_too_little_are_exact(spark):
    """With skewed norms nearly all stored vectors fall into one bucket of a tree, and some queries into others."""
    x = np.random.default_rng(5).standard_normal((3000, 16))
    x = (x * np.where(np.arange(3000) % 100 == 1, 60, 1)[:, None]).astype(np.float32)
    norms = (x.astype(float) ** 2).sum(axis=1)
    held = np.zeros(3000)
    for tree in range(forest.TREES):
        stored, asked = (forest.hash_strings(x, e, tree, 17) >> np.uint64(13) for e in (np.sqrt(norms.max() - norms), np.zeros(3000)))
        held += np.bincount(stored.astype(int), minlength=16)[asked.astype(int)]
    poor = [q for q in range(0, 3000, 20) if held[q] < forest.SHARE * 3000]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    got, want = results(spark, rows), brute(rows, 20)
    assert got.keys() == want.keys() and poor
    for q in poor:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_starved_queries_are_compared_with_everything(spark):
    rows = make(1500, 2)
    got = results(spark, rows, trees=1, share=0.0001)
    assert all(len(v) == 20 for v in got.values())


@pytest.mark.parametrize("n", [0, 1, 2, 21])
def test_fewer_than_asked(spark, n):
    got = results(spark, make(n))
    assert all(len(v) == min(20, n - 1) for v in got.values())
    assert set(got) == ({0, 20} if n == 21 else {0} if n == 2 else set())


def test_hash_strings_of_equal_vectors_and_ranges():
    x = np.random.default_rng(3).standard_normal((50, 8))
    codes = np.sort(forest.hash_strings(x, np.zeros(50), 4, 9).astype(np.int64))
    assert (forest.hash_strings(x, np.zeros(50), 4, 9) == forest.hash_strings(x * 3, np.zeros(50), 4, 9)).all()
    for depth in range(10):
        first, last = forest._ranges(codes, codes, depth, 9)
        for c, a, b in zip(codes.tolist(), first.tolist(), last.tolist(), strict=True):
            assert [i for i, o in enumerate(codes.tolist()) if o >> (9 - depth) == c >> (9 - depth)] == list(range(a, b))


def test_extra_columns_do_not_matter(spark):
    rows = make(120)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    wide = df.withColumns({c: F.lit(1) for c in ("query_id", "rank", "score", "code", "tree", "block", "bucket", "vector", "held", "shared")})
    both = [sorted(map(tuple, forest.nearest(d, F.col("vec_id") % 20 == 0, 20).collect())) for d in (df, wide)]
    assert both[0] == both[1] and len(both[0]) == 6 * 20
