"""The pipeline's stages against brute force, each on what the stage before it keeps."""
from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import test_linededup
import test_simhash
import test_toxicity

from pyspark.sql import functions as F

import corpus_pipeline as cp
from faremeter.llm import mixing, toxicity
from faremeter.sources.scratch import stored

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels = test_toxicity.make(300)
    line = "a line that many documents share"
    rows = [(i, f"{line}\n{t}" if i % 3 == 0 else t, "en", f"s{i % 4}", len(t)) for i, t, _, _ in docs]
    rows += [(1000 + i, rows[1][1] + (" tail" if i else ""), "en", "s1", 1) for i in range(4)]  # near copies of a clean one
    rows += [(2000, None, None, None, None), (2001, "", "en", "s9", 0), (2002, "x " * 50_000, "en", "s0", 1)]
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)

    kept = stored(cp.drop_toxic(spark, docs, folder), "t")
    models = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert kept.columns == columns
    assert rows(kept) == [r for r in rows(docs) if models.scores([(r[1] or "").encode()])[0] < 0.5]

    lined = stored(cp.drop_repeated_lines(spark, kept, folder), "l")
    want = {d: t for d, t, _, _ in test_linededup.brute([(r.doc_id, r.text) for r in kept.collect()])}
    assert lined.columns == columns and lined.count() == kept.count()
    for r in lined.collect():
        assert (r.text or "") == want[r.doc_id]
        assert r.n_chars in (len(r.text or ""), 1, None) or r.text == {x.doc_id: x.text for x in kept.collect()}[r.doc_id]

    single = stored(cp.drop_near_duplicates(spark, lined, folder), "s")
    given = sorted(lined.collect(), key=lambda r: r.doc_id)
    roots = test_simhash.reach([test_simhash.plain_fingerprint(r.text) for r in given], 4)
    assert single.columns == columns
    assert rows(single) == sorted((tuple(given[i]) for i in sorted(set(roots))), key=str)

    mixed = stored(cp.mix_sources(spark, single, folder), "m")
    taken = {r.row.doc_id: (2 * r.taken + r.size) // (2 * r.size) if r.size else 0 for r in mixing.mix(single).collect()}
    assert mixed.columns == columns
    counts = {}
    for r in mixed.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {d: n for d, n in taken.items() if n}

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    done = cp.encode(spark, mixed, folder).collect()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert len(done) == mixed.count()
    for r in done:
        ids = sp.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert np.frombuffer(r.piece_ids, "<u4").tolist() == ids and r.n_tokens == len(ids) and r.decoded == texts[r.doc_id]


def test_run(spark, folder):
    assert cp.run(spark, folder).count() > 100
    assert cp.ORACLE_SQL is None


def test_stages_on_nothing_on_repeated_rows_and_on_clashing_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = {c: F.lit(i) for i, c in enumerate(("row", "score", "kept", "print", "position", "size", "chunk", "piece_ids", "n_tokens", "root"))}
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name
        some = docs.filter("doc_id < 30")
        twice = stage(spark, some.unionByName(some), folder)
        wide = stage(spark, some.withColumns(extra), folder)
        plain = stage(spark, some, folder)
        ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)
        assert ids(wide) == ids(plain), name
        if name in ("toxicity", "line_dedup", "sentencepiece"):
            assert ids(twice) == sorted(ids(plain) * 2, key=str), name
        elif name == "simhash_near_dedup":
            assert ids(twice) == ids(plain), name
        else:
            assert set(ids(twice)) <= set(ids(some)) and len(ids(twice)) >= len(ids(plain)), name
        if name != "sentencepiece":
            assert set(wide.columns) == set(docs.columns) | set(extra), name
