from __future__ import annotations

from collections import defaultdict
from hashlib import md5

import pytest

from faremeter.llm import mixing

SCHEMA = "doc_id long, text string, source string, row string, size string"


def words(n):
    return " ".join(["w"] * n)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "row", "size") for i, t, s in rows], SCHEMA)


def targets_by_rounds(sizes):
    """Water filling the plain way: share, stop what is above, share again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(3 * sizes[s] for s in stopped)
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if shares[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in stopped else shares[s] for s in order}
        stopped |= above


@pytest.fixture(scope="module")
def rows():
    out = [(i, words(i % 17 + 1), f"s{i % 5}") for i in range(200)]
    out += [(1000 + i, words(40), "s0") for i in range(100)]  # a hot source
    out += [(2000, None, "s1"), (2001, "", "s2"), (2002, " \t\n", None), (2003, words(7), None), (None, words(5), "s3")]
    out += [(7, words(3), "s4"), (7, words(3), "s4"), (3000, words(3000), "tiny"), (3001, "x", "é")]
    return out


def test_targets_and_taken(spark, rows):
    got = mixing.mix(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.row.source] += r.size
        taken[r.row.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
        assert (r.position is None) == (r.taken == 0)
        assert r.position is None or 0 <= r.position <= 1
    want = targets_by_rounds(dict(sizes))
    for r in got:
        assert r.source_size == sizes[r.row.source]
        assert r.target == pytest.approx(want[r.row.source], rel=1e-12)
    for source, words_taken in taken.items():
        assert abs(words_taken - want[source]) <= 0.5


def test_reruns_agree(spark, rows):
    one = sorted(map(str, mixing.mix(docs_of(spark, rows)).collect()))
    two = sorted(map(str, mixing.mix(docs_of(spark, rows).repartition(5)).collect()))
    assert one == two


def test_positions_follow_the_schedule(spark):
    rows = [(i, words(10), "a" if i % 2 else "b") for i in range(2000)]
    got = mixing.mix(docs_of(spark, rows)).collect()
    early = {s: sum(r.taken for r in got if r.row.source == s and r.position is not None and r.position < 0.5) for s in "ab"}
    whole = {s: sum(r.taken for r in got if r.row.source == s) for s in "ab"}
    # rate 1 + 0.5 * (1 - 2t): five eighths of the demand lie in the first half; the second source is constant
    assert early["a"] / whole["a"] > 0.5
    once = [r for r in got if r.row.source == "b"]
    assert sorted((r.words_before, r.position) for r in once if r.position is not None) == sorted(
        (r.words_before, r.words_before / r.source_words) for r in once if r.position is not None
    )


def test_the_mix_comes_in_training_order(spark, rows):
    got = [r.position for r in mixing.mix(docs_of(spark, rows)).collect()]
    taken = [p for p in got if p is not None]
    assert len(set(taken)) > 100 and taken == sorted(taken)
    assert got == taken + [None] * (len(got) - len(taken))


def test_order_in_a_source(spark):
    rows = [(i, words(i % 4 + 1), "a") for i in range(50)] + [(100, words(500), "b")]
    got = {r.row.doc_id: r for r in mixing.mix(docs_of(spark, rows)).collect() if r.row.source == "a"}
    before = 0
    for i in sorted(got, key=lambda i: md5(str(i).encode()).hexdigest()):
        assert got[i].words_before == before
        before += got[i].size


def test_curriculum(spark, rows):
    docs = docs_of(spark, rows)
    decided = mixing.mix(docs).collect()
    want = defaultdict(int)
    for r in decided:
        if r.size:
            want[(r.row.doc_id, r.row.text, r.row.source)] += (2 * r.taken + r.size) // (2 * r.size)
    got = defaultdict(int)
    out = mixing.curriculum(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        got[(r.doc_id, r.text, r.source)] += 1
    assert dict(got) == {k: n for k, n in want.items() if n}


def test_empty(spark):
    none = docs_of(spark, [])
    assert mixing.mix(none).count() == 0
    assert mixing.curriculum(none).count() == 0
    blank = docs_of(spark, [(1, "", "a"), (2, None, None)])
    assert [(r.size, r.taken, r.target) for r in mixing.mix(blank).collect()] == [(0, 0, 0.0)] * 2
    assert mixing.curriculum(blank).count() == 0
