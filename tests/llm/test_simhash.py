from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from faremeter.llm import components, simhash


def plain_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(prints, most):
    """Smallest place reachable for each print, by comparing all."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(60):
        words = [f"W{rng.randrange(3000)}" for _ in range(rng.choice((2, 5, 60, 400)))]
        out.append((i * 3, " ".join(words)))
        for j in range(rng.randrange(3)):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "changed"
            out.append((i * 3 + j + 500, "  ".join(copy)))
    out += [(700, None), (701, ""), (702, " \n"), (703, "one"), (704, "ONE"), (705, out[0][1]), (705, out[0][1]), (None, out[1][1])]
    return out


def test_against_brute_force(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, mark int, print int, root int")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = reach(prints, 4)
    ids = {}
    for (doc, _), root in zip(rows, roots, strict=True):
        if doc is not None:
            ids[root] = min(doc, ids.get(root, doc))
    want = sorted(((d, f"{p:016x}", ids.get(r)) for (d, _), p, r in zip(rows, prints, roots, strict=True)), key=str)
    assert got == want
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(ids.values()))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.without_near_duplicates(docs).count() == 0


@pytest.mark.parametrize("most", [1, 2, 3, 4, 6])
def test_links_connect_what_is_near(spark, most):
    rng = np.random.default_rng(most)
    centres = rng.integers(0, 2**63 - 1, 40, dtype=np.int64).astype(np.uint64)
    prints = []
    for c in centres:
        prints.append(int(c))
        for _ in range(6):
            flipped = int(c)
            for bit in rng.choice(64, rng.integers(1, most + 3), replace=False):
                flipped ^= 1 << int(bit)
            prints.append(flipped)
    # one large group within a few bits of each other
    for _ in range(400):
        flipped = int(centres[0])
        for bit in rng.choice(16, 3, replace=False):
            flipped ^= 1 << int(bit)
        prints.append(flipped)
    prints = sorted(set(prints))
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    links = simhash.print_links(spark.createDataFrame([(p,) for p in signed], "print long"), most).collect()
    for a, b in links:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= most
    place = {p: i for i, p in enumerate(signed)}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(prints))] == reach(prints, most)


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 200)]
    loop = [(500, 501), (501, 502), (502, 500), (600, 600)]
    got = {(r.node, r.root) for r in components.components(spark.createDataFrame(path + star + loop, "a long, b long")).collect()}
    want = {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(200)} | {(500 + i, 500) for i in range(3)}
    assert got == want
