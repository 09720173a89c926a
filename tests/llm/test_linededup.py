from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from faremeter.llm import linededup as ld

SCHEMA = "doc_id long, text string, kept string, chunk long, row int"
LONG = "this line is long enough"
ROWS = [
    (5, f"{LONG}\nown line of five\nshort"),
    (3, f"  {LONG.upper()} \t\nshort\nfirst of three"),
    (9, f"x\n{LONG}\n{LONG}\nlast line of nine\r"),
    (9, f"{LONG}\nother row of nine"),
    (4, None),
    (6, ""),
    (7, "\n\n"),
    (8, "ÄÖÜÄÖÜÄÖ\nÄÖÜÄÖÜÄÖÜÄ"),
    (10, "ÄÖÜÄÖÜÄÖ\nÄÖÜÄÖÜÄÖÜÄ\nsame twice in ten\nsame twice in ten"),
    (None, f"{LONG}\nonly without an id"),
    (11, "z" * 200_000 + "\n" + LONG),
    (12, "z" * 200_000),
]


def key(line):
    k = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    return k if len(k) >= 10 else None


def brute(rows):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if key(line):
                holders.setdefault(key(line), set()).add(float("inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = float("inf") if doc is None else doc
        kept = [x for x in lines if not key(x) or len(holders[key(x)]) < 2 or min(holders[key(x)]) == own]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "kept", 1, 2) for i, t in ROWS], SCHEMA)


def test_against_brute_force(docs):
    got = [(r.row.doc_id, bytes(r.kept).decode(), r.n_lines, r.n_dropped) for r in ld.dedup_lines(docs).collect()]
    assert sorted(got, key=str) == sorted(brute(ROWS), key=str)
    for r in ld.dedup_lines(docs).collect():
        assert r.kept_sha256 == hashlib.sha256(bytes(r.kept)).hexdigest()


def test_columns_and_nulls_stay(docs):
    out = ld.without_repeated_lines(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = sorted(((d, None if t is None else k) for (d, t), (_, k, _, _) in zip(ROWS, brute(ROWS), strict=True)), key=str)
    assert got == want


def test_a_line_in_most_documents(spark):
    rows = [(i, f"header of every page\nbody number {i} here") for i in range(500)]
    got = ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.row.doc_id for r in got if not r.n_dropped} == {0}


def test_empty(spark):
    assert ld.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(-(2**63), 2**63 - 1, (2, n))
    a[: n // 2] = 7  # the same first half, told apart by the second
    phash = ld.PerfectHash.from_bytes(ld.PerfectHash.build(a, b).to_bytes())
    assert sorted(phash.places(a, b)) == list(range(n))


def test_a_text_goes_to_its_chunk_once(spark):
    """Beside the row that holds it no copy of a text is shuffled, and what is read once is not stored: `lines` alone is."""
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in ROWS], SCHEMA)
    done = ld.dedup_lines(docs)
    sent = re.search(r"run\(([^)]*)\)", done._jdf.queryExecution().executedPlan().toString())[1]
    assert "row#" in sent and "text#" not in sent
    assert {f.split("/")[-2].rpartition("-")[0] for f in done.inputFiles()} == {"lines"}
