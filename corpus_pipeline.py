"""A corpus made ready for training: toxic documents go, repeated lines and near duplicates go, sources are mixed to
target weights, and what is left is encoded."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeter.llm import linededup, mixing, pieces, simhash, toxicity
from faremeter.sources.scratch import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half; the models learn from the labels of the folder.

    Null and empty texts stay unless the models take an empty text for toxic. Rows come out as they are, repeated ones and
    any extra columns too; without rows there are none.
    """
    return toxicity.not_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in several documents stay in the first one only; every document stays.

    Rows with equal doc_id are one document and lose the same lines; a null doc_id counts as the largest. Null texts stay
    null. Extra columns are kept as they are; without rows there are none.
    """
    return linededup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints over 4-word shingles are linked at 4 or fewer bits.

    The one with the smallest doc_id stays, a null doc_id only where there is no other; of repeated rows one stays. Null and
    empty texts have the same fingerprint and are one group. Extra columns are kept; without rows there are none.
    """
    return simhash.without_near_duplicates(docs, words=4, most=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: documents by position, as often as the mix takes them.

    A null source is a source of its own, after all others. Documents without words have size 0 and are not taken. Repeated
    rows are documents of their own. Extra columns are kept; without rows there are none.
    """
    return mixing.curriculum(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, as little-endian unsigned 32-bit integers, their number, and the text they decode to.

    Null and empty texts are the begin and end ids; texts of any length are encoded whole. Columns are doc_id, lang, source
    and these, whatever else the rows have.
    """
    done = pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return done.select("doc_id", "lang", "source", pieces.n_ids().alias("n_tokens"), F.col("piece_ids"), "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL can express neither the toxicity models nor the fingerprints; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents; each works on the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
