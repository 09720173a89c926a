"""Line deduplication over sharded minimal perfect hashes."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremeter.llm.common import as_row, partitions, text_of, utf8
from faremeter.sources.scratch import stored

LEAST_CODE_POINTS = 10
_WHITE = b" \t\n\x0b\x0c\r"
#: Slots per key of a level of the minimal perfect hash.
_SLACK = 2
_NO_ID = (1 << 63) - 1


def line_key(line: bytes, least: int) -> bytes | None:
    """A line stripped of white space at both ends, A-Z lower-cased; None if it has too few code points."""
    key = line.strip(_WHITE).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return key


def line_hash(key: bytes) -> tuple[int, int]:
    """128 bits of a line as two signed 64-bit numbers: the first places it, the second is its fingerprint."""
    h = xxhash.xxh3_128_digest(key)
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit mix of both halves of the hashes, another one for each level."""
    x = a.astype(np.uint64) ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + b.astype(np.uint64)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash: every key of the set gets its own number below the size of the set.

    Each level is a bit array of twice the keys still without a place. A key whose slot no other key wants takes it; the
    rest go on to the next level. A key's number is the count of taken slots before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        counts = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.ranks = [np.cumsum(x, dtype=np.int64) - 1 + start for x, start in zip(levels, counts, strict=False)]
        self.size = int(counts[-1])

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        levels = []
        while len(a):
            slots = _mixed(a, b, len(levels)) % np.uint64(_SLACK * len(a))
            wanted = np.bincount(slots.astype(np.int64), minlength=_SLACK * len(a))
            levels.append(wanted == 1)
            rest = wanted[slots.astype(np.int64)] > 1
            a, b = a[rest], b[rest]
        return cls(levels)

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each key; of a key outside the set any number, or -1."""
        out, open_ = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (taken, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            slots = (_mixed(a[open_], b[open_], level) % np.uint64(len(taken))).astype(np.int64)
            found = taken[slots]
            out[open_[found]] = rank[slots[found]]
            open_ = open_[~found]
        return out

    def to_bytes(self) -> bytes:
        return b"".join(len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        levels, at = [], 0
        while at < len(data):
            n = int.from_bytes(data[at : at + 8], "little")
            size = (n + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, size, at + 8), count=n).astype(bool))
            at += 8 + size
        return cls(levels)


def _hash_lines(least: int):
    schema = pa.schema([("chunk", pa.int64()), ("place", pa.int64()), ("print", pa.int64()), ("doc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[int]] = [[], [], [], []]
            for chunk, doc, text in zip(batch["chunk"].to_pylist(), batch["doc"].to_pylist(), utf8(batch["text"]), strict=True):
                keys = {k for k in (line_key(x, least) for x in text.split(b"\n")) if k is not None}
                for key in keys:
                    place, mark = line_hash(key)
                    columns[0].append(chunk)
                    columns[1].append(place)
                    columns[2].append(mark)
                    columns[3].append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return run


def _build(table: pa.Table) -> pa.Table:
    """One row of arrays for the lines of a shard."""
    a, b = table["place"].to_numpy(), table["print"].to_numpy()
    phash = PerfectHash.build(a, b)
    at = phash.places(a, b)

    def ordered(name: str) -> bytes:
        out = np.empty(phash.size, np.int64)
        out[at] = table[name].to_numpy()
        return out.tobytes()

    return pa.table(
        {
            "shard": pa.array([table["shard"][0].as_py()], pa.int64()), "phash": [phash.to_bytes()],
            "prints": [ordered("print")], "counts": [ordered("n_docs")], "keepers": [ordered("keeper")],
        }
    )


def _probe(wanted: pa.Table, arrays: pa.Table) -> pa.Table:
    """The lines of chunks that a shard holds, each with the document that keeps it."""
    a, b, chunk = (wanted[c].to_numpy() for c in ("place", "print", "chunk"))
    keep = np.zeros(len(a), bool)
    keeper = np.zeros(len(a), np.int64)
    if len(a) and arrays.num_rows:
        phash = PerfectHash.from_bytes(arrays["phash"][0].as_py())
        prints, counts, keepers = (np.frombuffer(arrays[c][0].as_py(), np.int64) for c in ("prints", "counts", "keepers"))
        at = phash.places(a, b)
        keep = (at >= 0) & (prints[at] == b) & (counts[at] >= 2)
        keeper = keepers[at]
    return pa.table({"chunk": chunk[keep], "place": a[keep], "print": b[keep], "keeper": keeper[keep]})


def _apply(least: int, place: int):
    """Rewrites the texts of a chunk, which are the field at this place of `row`."""

    def run(docs: pa.Table, verdicts: pa.Table) -> pa.Table:
        keeper = dict(
            zip(zip(verdicts["place"].to_pylist(), verdicts["print"].to_pylist(), strict=True), verdicts["keeper"].to_pylist(), strict=True)
        )
        texts, n_lines, n_dropped, digests = [], [], [], []
        for doc, text in zip(docs["doc"].to_pylist(), utf8(pc.struct_field(docs["row"], [place])), strict=True):
            lines = text.split(b"\n")
            kept = lines
            if keeper:
                kept = []
                for line in lines:
                    key = line_key(line, least)
                    if key is None or keeper.get(line_hash(key), doc) == doc:
                        kept.append(line)
            joined = text if len(kept) == len(lines) else b"\n".join(kept)
            texts.append(joined)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
            digests.append(hashlib.sha256(joined).hexdigest())
        return pa.table(
            [docs["row"], pa.array(texts, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digests, pa.string())],
            names=["row", "kept", "n_lines", "n_dropped", "kept_sha256"],
        )

    return run


def line_arrays(lines: DataFrame, n_shards: int) -> DataFrame:
    """Shards of a minimal perfect hash over the lines found in at least two documents, with their arrays.

    `lines` has (chunk, place, print, first, last, n_docs), a row per line and chunk. A line's fingerprint, number of
    documents and keeping document (the smallest id) lie at the line's number in its shard.
    """
    repeated = (
        lines.groupBy("place", "print")
        .agg(F.min("first").alias("keeper"), F.max("last").alias("last"), F.sum("n_docs").alias("n_docs"))
        .filter(F.col("keeper") < F.col("last"))
        .withColumn("shard", F.pmod("place", F.lit(n_shards)))
    )
    schema = "shard long, phash binary, prints binary, counts binary, keepers binary"
    return repeated.groupBy("shard").applyInArrow(_build, schema)


def dedup_lines(docs: DataFrame, least: int = LEAST_CODE_POINTS) -> DataFrame:
    """Drop lines that occur in several documents, except in the document with the smallest id.

    Lines are hashed once per document and gathered per chunk of documents, so that a line in a third of all documents is
    one row per chunk. The shard of each line's hash holds the arrays of repeated lines (`line_arrays`); the lines of a
    chunk are looked up there, and what is found goes back to the chunk, which rewrites its texts.

    Returns `row` (a struct of all columns of docs), kept (the text as UTF-8), n_lines, n_dropped, kept_sha256.
    Null or empty text is one empty line, which stays. Lines under `least` code points stay. Rows with the same doc_id
    count as one document, so they keep the same lines. A null doc_id counts as a document with the largest id. Texts and
    lines of any length are taken whole; other columns are kept in `row`, so their names cannot clash. No rows give no rows.
    """
    n = partitions(docs.sparkSession)
    given = docs.select(
        as_row(docs), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"),
        text_of().cast("binary").alias("text"),
    )
    given = given.withColumn("chunk", F.pmod(F.xxhash64("doc", F.length("text")), F.lit(n)))
    hashed = given.select("chunk", "doc", "text").mapInArrow(_hash_lines(least), "chunk long, place long, print long, doc long")
    lines = stored(
        hashed.groupBy("chunk", "place", "print").agg(
            F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n_docs")
        ),
        "lines",
    )
    arrays = line_arrays(lines, n)
    wanted = lines.select("chunk", "place", "print", F.pmod("place", F.lit(n)).alias("shard"))
    verdicts = wanted.groupBy("shard").cogroup(arrays.groupBy("shard")).applyInArrow(
        _probe, "chunk long, place long, print long, keeper long"
    )
    out = T.StructType([given.schema["row"], T.StructField("kept", T.BinaryType())])
    out = out.add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string")
    place = [c.lower() for c in docs.columns].index("text")  # the text goes to its chunk once, inside the row
    return given.drop("text").groupBy("chunk").cogroup(verdicts.groupBy("chunk")).applyInArrow(_apply(least, place), out)


def without_repeated_lines(docs: DataFrame, least: int = LEAST_CODE_POINTS) -> DataFrame:
    """The same documents and columns with repeated lines dropped; n_chars, if there, follows the text."""
    done = dedup_lines(docs, least)
    text = F.when(F.col("row.text").isNull(), F.lit(None)).otherwise(F.col("kept").cast("string"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        same = F.col("n_dropped") == 0
        new["n_chars"] = F.when(same, F.col("row.n_chars")).otherwise(F.char_length(text)).cast(docs.schema["n_chars"].dataType)
    return done.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


SQL = """
with split as (
  select row_number() over () as r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents),
keyed as (
  select r, doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from split),
repeated as (
  select k, min(doc_id) as keeper from keyed where length(k) >= 10 group by k having count(distinct doc_id) >= 2),
judged as (
  select r, doc_id, i, line, keeper is not null and keeper <> doc_id as dropped from keyed left join repeated using (k))
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not dropped), '')) as kept_sha256
from judged group by r, doc_id
"""
