"""Token ids and pieces against their libraries."""
from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faremeter.llm import files, pieces, tokenids

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "abcdeFSI  \n\t▁éÉüßñÑ.,'\"0123<|endoftext|>/日本́\U0001f600　\x00\rªµ×\x1c\x85\xa0İſΣσ"
TEXTS = [
    (5, "The quick brown fox; it's 42 degrees.\n\nÉté à Genève, größer!"),
    (3, None),
    (4, ""),
    (2, "   leading and   many   spaces   "),
    (9, "word " * 40_000),
    (8, "x" * 30_000),
    (7, "<|endoftext|> <s> </s> <0x0A> ▁▁"),
    (7, "same id, other text"),
    (7, "same id, other text"),
    (None, "no id"),
]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = TEXTS + [(100 + i, t) for i, t in enumerate(random_texts(200))]
    schema = "doc_id long, text string, ids string, piece_ids int, decoded int, start int"
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], schema)


# ---- pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(PIECES)


def test_pieces_of_random_texts(vocabulary):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in random_texts(3000, 2):
        ids = sp.encode(text, add_bos=True, add_eos=True)
        assert vocabulary.encode(text) == ids
        assert vocabulary.decode(ids) == sp.decode(ids)


def test_decoding_of_any_ids(vocabulary):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(3)
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(rng.randrange(12))]
        assert vocabulary.decode(ids) == sp.decode(ids)


def test_pieces_of_a_table(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.encoded(docs, PIECES).select("text", "piece_ids", "decoded", pieces.n_ids().alias("n")).collect()
    assert len(got) == docs.count()
    for r in got:
        ids = sp.encode(r.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.piece_ids, "<u4").tolist() == ids and r.n == len(ids)
        assert r.decoded == sp.decode(ids)
    sums = pieces.differences_from_library(docs, PIECES).agg(F.sum("texts"), F.sum("different_ids"), F.sum("different_texts"))
    assert tuple(sums.first()) == (docs.count(), 0, 0)
    assert pieces.encoded(docs.limit(0), PIECES).count() == 0


# ---- token ids


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORDS)  # as it is: strings of added tokens become those tokens
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_words_of_random_texts(library):
    with open(WORDS, encoding="utf-8") as f:
        encoder = tokenids.WordEncoder(f.read())
    assert encoder.simple
    for text in random_texts(5000, 4):
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == library(text)


def test_strings_of_added_tokens(library):
    with open(WORDS, encoding="utf-8") as f:
        encoder = tokenids.WordEncoder(f.read())
    assert library("a <|endoftext|> b") == [320, 49407, 321]
    for text in (
        "a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|>y <|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|EndOfText|>",
        "größer<|endoftext|>Été", "<|endof text|>", "<|endoftext|", " <|endoftext|>\n\n<|endoftext|>  z " + "word " * 3000,
    ):
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == library(text), text


def test_what_is_remembered_changes_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "_REMEMBERED", 3)
    fresh = pieces.Vocabulary(*vocabulary.plain())
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in ["a b c a b c a b c d e f a b", "a b c " * 300, *random_texts(300, 11)]:
        assert fresh.encode(text) == sp.encode(text, add_bos=True, add_eos=True)
    assert len(fresh.remembered) <= 3 and len(fresh.older) <= 3


def test_short_and_long_chunks_merge_alike(vocabulary, monkeypatch):
    """Chunks of a few characters are merged without an agenda, to the same pieces."""
    chunks = {c for t in random_texts(400, 12) for c in t.replace(" ", " ▁").split(" ") if c} | {"▁", "▁" * 9, "aaaaaaa", "▁ababab"}
    for chunk in chunks:
        assert vocabulary._merged_short(chunk) == vocabulary._merged_long(chunk) == vocabulary.merged(chunk)
    monkeypatch.setattr(vocabulary, "_merged_long", None)
    assert "".join(vocabulary.merged("▁internationally")) == "▁internationally"


def test_chunks_of_any_length_keep_an_agenda(vocabulary, monkeypatch):
    taken, pop = [], pieces.heapq.heappop
    monkeypatch.setattr(pieces.heapq, "heappop", lambda agenda: taken.append(1) or pop(agenda))
    for chunk in ("to", "▁internationally", "▁" + "ab" * 40):
        taken.clear()
        found = vocabulary.merged(chunk)
        assert "".join(found) == chunk and len(taken) >= len(chunk) - len(found) > 0


def test_both_ways_at_once_equal_decoding(vocabulary):
    for text in random_texts(3000, 9) + ["", " ", "  ", "\n", " \n a", "▁", "▁ x", "\u0000\U0001f600", "é" * 500]:
        ids, decoded = vocabulary.round_trip(text)
        assert decoded == vocabulary.decode_bytes(ids)


def test_texts_are_decoded_from_their_ids(vocabulary, monkeypatch):
    asked = []
    monkeypatch.setattr(pieces.Vocabulary, "decode_bytes", lambda self, ids: asked.append(ids) or b"decoded")
    ids, decoded = vocabulary.round_trip("one two  three")
    assert asked == [ids] and decoded == b"decoded"


def test_round_trip_of_files(spark, docs, library):
    folder = tokenids.write_token_files(docs, WORDS, end_id=1)
    got = tokenids.read_token_files(spark, folder).collect()
    want = sorted(((r.doc_id is not None, r.doc_id or 0, [*library(r.text or ""), 1]) for r in docs.collect()))
    back = sorted(got, key=lambda r: r.start)
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in back]
    assert keys == sorted(keys)
    at = 0
    for r in back:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens


def test_single_documents(spark, docs):
    folder = tokenids.write_token_files(docs, WORDS, end_id=1)
    manifest = spark.read.parquet(f"{folder}/manifest")
    wanted = manifest.select("file", (F.col("documents") - 1).alias("number"))
    last = {r.file: bytes(r.ids) for r in tokenids.read_documents(spark, folder, wanted).collect()}
    with files.open_input(f"{folder}/dictionary") as f:
        dictionary = f.read()
    assert len(last) == manifest.count() > 1
    for name, ids in last.items():
        file = tokenids.TokenFile(f"{folder}/{name}", dictionary)
        assert b"".join(x for _, block in file.blocks() for x in block).endswith(ids)
        with pytest.raises(ValueError, match="another dictionary"):
            tokenids.TokenFile(f"{folder}/{name}", dictionary + b"x")


def test_files_left_by_lost_attempts_are_not_read(spark, docs):
    folder = tokenids.write_token_files(docs, WORDS, end_id=1)
    with files.create(f"{folder}/lost.tokids") as f:
        f.write(b"half a file")
    assert tokenids.read_token_files(spark, folder).count() == docs.count()


def test_no_documents(spark, docs):
    folder = tokenids.write_token_files(docs.limit(0), WORDS, end_id=1)
    assert tokenids.read_token_files(spark, folder).count() == 0


def test_dictionary_of_few_samples():
    assert tokenids.trained_dictionary([]) == b""
    assert tokenids.trained_dictionary([b"abc", b"def"]) == b"abcdef"
