"""Cross-tokenizer alignment against plain loops with both libraries."""
from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faremeter.llm import alignment
from faremeter.llm.queries import op12_alignment

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def given():
    return alignment.definitions(P.path("byte_bpe_50k.json"), P.PATTERN, P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    symbol = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a_bytes = {i: bytes(symbol[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return a, a_bytes, b, b_bytes


def tokens(text, libraries):
    a, a_bytes, b, b_bytes = libraries
    if not text:
        return [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = b" " + text.encode()
    if b"".join(a_bytes[i] for i in ids_a) != whole or b"".join(b_bytes(i) for i in ids_b) != whole:
        return [], []
    return [(i, len(a_bytes[i])) for i in ids_a], [(i, len(b_bytes(i))) for i in ids_b]


def grouped(ids_a, ids_b):
    groups, left, right, at_a, at_b, rest = [], [], [], 0, 0, list(ids_b)
    for i, size in ids_a:
        left.append(i)
        at_a += size
        while rest and at_b < at_a:
            j, size_b = rest.pop(0)
            right.append(j)
            at_b += size_b
        if at_a == at_b:
            groups.append((left, right))
            left, right = [], []
    return groups


def by_loops(rows, libraries):
    docs, counts = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b = tokens(text, libraries)
        groups = grouped(ids_a, ids_b)
        links = Counter((i, j) for left, right in groups for i in left for j in right)
        counts.update(links.keys())
        docs.append((doc_id, len(ids_a), len(ids_b), groups, links))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = Counter()
    for doc_id, n_a, n_b, groups, links in docs:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[
            doc_id, n_a, n_b, len(groups), sum(links.values()),
            sum(n for k, n in links.items() if counts[k] == most[k[0]]), sum(n * counts[k] for k, n in links.items()),
            hashlib.sha256(written.encode()).hexdigest() if n_a else "",
        ] += 1
    return out, counts


def result(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r) for r in df.collect())


ROWS = [
    (1, "The cat  sat on the mat.\n\n\tÉtudes größer 你好 \U0001f600‍!"), (2, None), (3, ""), (4, " "), (5, "a ▁ b"),
    (6, "<|endoftext|> and </s> <s> <0x41>"), (7, "the the the cat"), (7, "the the the cat"), (None, "cat"), (None, None),
    (8, "ﬁne ① ｆｕｌｌ"), (9, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 3), (10, "\r\n x y"), (11, "-" * 500),
]


@pytest.mark.parametrize("chunk, fan, wide", [(1 << 22, 64, 4096), (40, 2, 4096), (40, 3, 0)])
def test_equals_loops(spark, given, libraries, monkeypatch, chunk, fan, wide):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(alignment, "FAN_IN", fan)
    monkeypatch.setattr(alignment, "_WIDE", wide)
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"n_a": F.lit("x"), "part": F.lit(1), "node": F.lit(2)})
    want, counts = by_loops(ROWS, libraries)
    done = alignment.Alignment(docs.repartition(3), given)
    assert result(done.documents()) == want
    assert {(r.a_id, r.b_id): r.n_docs for r in done.pairs().collect()} == dict(counts)


def test_given_tables(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op12_alignment(spark, folder)) == by_loops(rows, libraries)[0]


def test_no_rows(spark, given):
    done = alignment.Alignment(spark.createDataFrame([], SCHEMA), given)
    assert done.documents().count() == 0 and done.pairs().count() == 0


def test_very_long_texts(spark, given):
    """A text of no common boundary for long: tokens of both sides in the hundred thousands, in one group or many."""
    rows = [(1, "word " * 400_000), (2, "=" * 1_000_001 + "x" * 300_001)]
    done = {r.doc_id: r for r in alignment.Alignment(spark.createDataFrame(rows, SCHEMA), given).documents().collect()}
    assert done[1].n_a >= 400_000 and done[1].n_groups >= 400_000
    assert done[2].n_links >= done[2].n_a > 0


def test_merge_of_many_frames(monkeypatch):
    monkeypatch.setattr(alignment, "FRAME", 7)
    make = np.random.default_rng(1)
    runs, want = [], Counter()
    for _ in range(20):
        pairs = np.unique(make.integers(0, 500, make.integers(1, 300))).astype("<u8")
        counts = make.integers(1, 9, len(pairs)).astype("<u8")
        want.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
        runs.append(tuple(alignment._framed(pairs, counts)))
    batches = list(alignment.merged(runs))
    pairs = np.concatenate([p for p, _ in batches])
    assert (np.diff(pairs.astype(np.int64)) > 0).all()
    assert dict(zip(pairs.tolist(), np.concatenate([c for _, c in batches]).tolist(), strict=True)) == dict(want)
