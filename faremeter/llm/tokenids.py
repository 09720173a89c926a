"""Token ids in binary files: documents compressed one by one with a shared zstandard dictionary.

A file holds documents in ascending order of their ids:

    magic (8 bytes), SHA-256 of the dictionary (32 bytes)
    a zstandard frame per document, its ids as little-endian unsigned 32-bit integers
    the index: per document has_id (1 byte each), then doc_id (8), offset (8), n_tokens (4), column by column
    number of documents (8), place of the index (8), magic (8)

A document is read with the index and one short read. Which files count, and their order, is in the table `manifest`.
"""
from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremeter.llm import files
from faremeter.llm.common import partitions, text_of, utf8

MAGIC = b"TOKIDS01"
_HEAD = len(MAGIC) + 32
#: The dictionary is trained on so many documents, with the smallest hashes of their ids, and so many characters of each.
SAMPLE_DOCS = 256
SAMPLE_CHARS = 8192
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Words whose ids a task remembers.
_REMEMBERED = 500_000
_READ_BYTES = 4 << 20
_MANIFEST = "part int, file string, documents long, tokens long, bytes long, dictionary string"


def _byte_symbols() -> list[str]:
    """The symbol that byte-level vocabularies use for each byte: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class WordEncoder:
    """Encodes texts with a vocabulary of the tokenizers library that drops white space and lower-cases.

    White space separates tokens and no rule looks across it, so words are encoded by themselves and remembered. Words of
    ASCII and common Latin letters go to the vocabulary's merges after the library's own split; the library's whole
    chain of rules does the rest. A text with the string of an added token, such as `<|endoftext|>`, goes through the
    library as a whole, since the token may touch or part words.
    """

    #: Letters that composing and lower-casing treat one by one.
    _SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    #: The split of the vocabulary's own file for such words, lower-cased.
    _SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
    _LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.symbols = _byte_symbols()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        probe = "It's l'Été: größer, 3½ ñandú don't!! <|end x_y"
        want = self.tokenizer.encode(probe, add_special_tokens=False).ids
        self.simple = np.frombuffer(self.encode(probe.encode()), "<u4").tolist() == want

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            printable = part.isascii() and part.isprintable()
            text = part if printable else "".join([self.symbols[b] for b in part.encode()])
            numbers = [t.id for t in self.tokenizer.model.tokenize(text)]
            ids = struct.pack(f"<{len(numbers)}I", *numbers)
            if len(self.parts) >= _REMEMBERED:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    simple = True

    def word(self, word: bytes) -> bytes:
        """Ids of a word without white space."""
        text = word.decode("utf-8", "replace")
        letters = text.rstrip(".,")
        if not self.simple:
            out = self._whole(text)
        elif (letters.isascii() and letters.isalpha()) or self._LETTERS.fullmatch(letters):
            out = self._part(letters.lower())
            if len(letters) < len(text):
                out += self._part(text[len(letters) :])
        elif self._SIMPLE.fullmatch(text):
            out = b"".join([self._part(part) for part in self._SPLIT.findall(text.lower())])
        else:
            out = self._whole(text)
        if len(word) < 200:
            if len(self.words) >= _REMEMBERED:
                self.words.clear()
            self.words[word] = out
        return out

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: bytes) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        folded = text.lower()
        if any(a in folded for a in self.added):
            return self._whole(text.decode("utf-8", "replace"))
        get, word = self.words.get, self.word
        return b"".join([x if (x := get(w)) is not None else word(w) for w in text.split()])


def trained_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary trained on serialized id arrays; with too little to train on the samples themselves serve as one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _zstd_dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if data else None


def _sample(docs: DataFrame, definition) -> list[bytes]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(definition.value)
        for batch in batches:
            ids = [encoder.encode(t) for t in utf8(batch["text"])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    short = docs.select("doc_id", F.left(text_of(), F.lit(SAMPLE_CHARS)).alias("text"))
    chosen = short.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(SAMPLE_DOCS).select("text")
    return [bytes(r.ids) for r in chosen.mapInArrow(run, "ids binary").collect() if r.ids]


def _write(folder: str, definition, dictionary, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, end = WordEncoder(definition.value), np.array([end_id], "<u4").tobytes()
        known = _zstd_dictionary(dictionary.value)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known) if known else zstandard.ZstdCompressor(level=LEVEL)
        digest = hashlib.sha256(dictionary.value).digest()
        has_id, doc_ids, offsets, sizes, at, out, name = [], [], [], [], _HEAD, None, ""
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), utf8(batch["text"]), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.tokids"  # another attempt of this task writes another file
                    out = files.create(f"{folder}/{name}")
                    out.write(MAGIC + digest)
                ids = encoder.encode(text) + end
                frame = compressor.compress(ids)
                out.write(frame)
                has_id.append(doc_id is not None)
                doc_ids.append(doc_id or 0)
                offsets.append(at)
                sizes.append(len(ids) // 4)
                at += len(frame)
        if out is None:
            return
        for values, kind in ((has_id, "u1"), (doc_ids, "<i8"), (offsets, "<i8"), (sizes, "<u4")):
            out.write(np.array(values, kind).tobytes())
        out.write(np.array([len(sizes), at], "<i8").tobytes() + MAGIC)
        out.close()
        row = [[TaskContext.get().partitionId()], [name], [len(sizes)], [sum(sizes)], [at], [digest.hex()]]
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
            names=["part", "file", "documents", "tokens", "bytes", "dictionary"],
        )

    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> str:
    """Encode whole texts, append end_id to each, write them in ascending order of doc_id; returns the folder.

    Documents are sorted by range, equal ids by a hash of the text; each task writes one file and reports it in a row.
    The table of those rows is committed by Spark, so a file that a lost or repeated attempt has left is never read.
    Null text: the end alone. Very long texts are encoded whole, a document of any length being one frame. Null doc_id:
    first, and null again when read. Repeated rows are documents of their own, in any order. Other columns of docs are not
    read, whatever their names. No rows: an empty manifest.
    """
    spark = docs.sparkSession
    folder = folder or files.new_folder(spark, "tokens")
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    dictionary = trained_dictionary(_sample(docs, definition))
    with files.create(f"{folder}/dictionary") as out:
        out.write(dictionary)
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"),
        F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("salt"),
    )
    order = ["doc_id", "mark", "salt"]
    ranged = given.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    write = _write(folder, definition, spark.sparkContext.broadcast(dictionary), end_id)
    ranged.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


class TokenFile:
    """One file, open for reading: its index in memory, documents by number."""

    def __init__(self, address: str, dictionary: bytes):
        import zstandard

        self.source = files.open_input(address)
        size = self.source.size()
        self.source.seek(size - 24)
        tail = self.source.read(24)
        n, index = np.frombuffer(tail[:16], "<i8").tolist()
        self.source.seek(0)
        head = self.source.read(_HEAD)
        if tail[16:] != MAGIC or head[:8] != MAGIC:
            raise ValueError(f"{address} is not a file of token ids")
        if head[8:] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{address} was written with another dictionary")
        self.source.seek(index)
        data, at = self.source.read(n * 21), 0
        columns = []
        for kind, width in (("u1", 1), ("<i8", 8), ("<i8", 8), ("<u4", 4)):
            columns.append(np.frombuffer(data, kind, n, at))
            at += n * width
        self.has_id, self.doc_id, self.offset, self.n_tokens = columns
        self.end = np.append(self.offset[1:], index)
        known = _zstd_dictionary(dictionary)
        self.decompressor = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()

    def _decoded(self, frame: bytes, number: int) -> bytes:
        return self.decompressor.decompress(frame, max_output_size=int(self.n_tokens[number]) * 4)

    def ids(self, number: int) -> np.ndarray:
        """The ids of one document: one read of its frame."""
        self.source.seek(int(self.offset[number]))
        frame = self.source.read(int(self.end[number] - self.offset[number]))
        return np.frombuffer(self._decoded(frame, number), "<u4")

    def blocks(self) -> Iterator[tuple[int, list[bytes]]]:
        """(number of the first, ids of each) of consecutive documents, a few megabytes at a time."""
        at, n = 0, len(self.offset)
        while at < n:
            stop = max(at + 1, int(np.searchsorted(self.offset, self.offset[at] + _READ_BYTES)))
            first = int(self.offset[at])
            self.source.seek(first)
            data = memoryview(self.source.read(int(self.end[stop - 1]) - first))
            spans = zip(self.offset[at:stop].tolist(), self.end[at:stop].tolist(), strict=True)
            yield at, [self._decoded(bytes(data[i - first : j - first]), at + k) for k, (i, j) in enumerate(spans)]
            at = stop


def _dictionary(folder: str) -> bytes:
    with files.open_input(f"{folder}/dictionary") as f:
        return f.read()


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document: start counts the ids of all documents before it.

    The window runs over one row per file.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    names = ["doc_id", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), strict=True):
                file = TokenFile(f"{folder}/{name}", _dictionary(folder))
                for first, ids in file.blocks():
                    part = slice(first, first + len(ids))
                    sizes = file.n_tokens[part].astype(np.int64)
                    starts = start + np.cumsum(sizes) - sizes
                    start += int(sizes.sum())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_id[part], mask=file.has_id[part] == 0), pa.array(starts),
                            pa.array(sizes), pa.array(ids, pa.binary()),
                        ],
                        names=names,
                    )

    one_each = placed.select("file", "start").repartition(partitions(spark), "file")
    return one_each.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read_documents(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(file, number, ids) of single documents: `wanted` has the file of the manifest and the number in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, TokenFile] = {}
        for batch in batches:
            ids = []
            for name, number in zip(batch["file"].to_pylist(), batch["number"].to_pylist(), strict=True):
                if name not in open_:
                    open_ = {name: TokenFile(f"{folder}/{name}", _dictionary(folder))}
                ids.append(open_[name].ids(number).tobytes())
            yield pa.RecordBatch.from_arrays([batch["file"], batch["number"], pa.array(ids, pa.binary())], names=["file", "number", "ids"])

    ordered = wanted.select("file", F.col("number").cast("long").alias("number")).repartition("file").sortWithinPartitions("file", "number")
    return ordered.mapInArrow(run, "file string, number long, ids binary")
