"""The registered queries of this folder: each applies one operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeter.llm import (
    alignment, bm25, chat, forest, linededup, mixing, pieces, pitmanyor, reversed_search, simhash, tokenids, toxicity, warc,
)
from faremeter.llm.common import held_out_column, text_of

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = tokenids.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    back = tokenids.read_token_files(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id", pieces.n_ids().alias("n_tokens"), F.sha2("piece_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return forest.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op4_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.search(_table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("doc_id") % 20 == 0, k=10)


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pitmanyor.score(docs, base_total=pitmanyor.add_one_total)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(text_of()).alias("size"))
    mixed = mixing.mix(sized, size=F.col("size"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken", "position")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_dropped", "kept_sha256")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archives(_table(spark, sf_dir, "pages"), least_revisit=0)
    back = warc.read_archives(spark, folder, with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, most=4)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select(
        "row.doc_id", held_out_column("row.doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    given = alignment.definitions(path("byte_bpe_50k.json"), public_tokenizers.PATTERN, path("piece_bpe_32k.model"))
    return alignment.Alignment(_table(spark, sf_dir, "documents"), given).documents()


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"</s>[INST] ok [/INST]"
    turns = [F.struct(F.lit(role).alias("role"), F.lit(said).alias("content")) for role in ("user", "assistant")]
    probe = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.to_json(F.struct(F.array(*turns).alias("messages"))).alias("payload")
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    records = chat.as_records(rows, "conv_id").unionByName(probe)
    return chat.digests(chat.format_chats(chat.canonical_turns(records)))


QUERIES: dict[str, Query] = {
    "op1_token_ids": op1_token_ids,
    "op2_pieces": op2_pieces,
    "op3_forest": op3_forest,
    "op4_bm25": op4_bm25,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_reversed_search": op11_reversed_search,
    "op12_alignment": op12_alignment,
    "op13_chat": op13_chat,
}
ORACLES: dict[str, str] = {
    "op4_bm25": bm25.SQL, "op6_mixing": mixing.SQL, "op7_warc": warc.SQL, "op9_line_dedup": linededup.SQL,
    "op11_reversed_search": reversed_search.SQL, "op13_chat": chat.SQL,
}
