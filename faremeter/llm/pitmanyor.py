"""Scores of texts by a hierarchical Pitman-Yor bigram model.

The model: a restaurant per context (the token before) whose customers are the tokens that follow it and whose dishes are
words; all of them share one parent restaurant, whose customers are their tables; its parent is uniform over the known
words and one unknown. Seating is sampled by blocked Gibbs sweeps: all customers of a dish in a restaurant get up and take
seats again one after another, given everything else. Predictive probabilities are averaged over the last sweeps.

The work is cut into chunks of documents, each stored once as numbers. A chunk knows its own words and bigrams only; what
concerns several chunks is added up in shards of the words' or bigrams' hashes (`_exchange`): a chunk sends a shard its
distinct keys in ascending order with numbers, and gets the sums back in the same order. A frequent word or bigram is
thus one number per chunk, whatever its count. Every bigram of the corpus belongs to the first chunk that has it, which
seats its customers. The chunks and their bigrams are stored in buckets by chunk, so the jobs that bring sums to a chunk
move the sums alone.
"""
from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremeter.llm.alignment import _from_planes as unpacked
from faremeter.llm.alignment import _planes as packed
from faremeter.llm.common import drop_stored, partitions, settle, text_of, utf8
from faremeter.sources.scratch import scratch_root, stored

#: Discount and concentration of the context restaurants and of their parent.
DISCOUNT, STRENGTH = 0.8, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.7, 10.0
#: Gibbs sweeps, and how many of the last ones are averaged.
SWEEPS, SAMPLES = 3, 2
#: Text of a chunk, unless one document is longer.
CHUNK_BYTES = 7 << 20
MODULUS, REMAINDER = 7, 2
_END, _BEGIN = b"", b"\n"
#: Customers seated one at a time; further ones in blocks of a sixteenth of those seated.
_ONE_BY_ONE = 64
_SEED = 5

_MESSAGE = pa.schema(
    [("place", pa.int64()), ("kind", pa.int32()), ("origin", pa.int64())]
    + [(c, pa.binary()) for c in "abcdefgh"]
    + [("x", pa.int64()), ("y", pa.int64())]
)
_DDL = "place long, kind int, origin long, " + ", ".join(f"{c} binary" for c in "abcdefgh") + ", x long, y long"
_CHUNK, _WORDS, _PAIRS, _CELLS, _SEATS, _TABLES, _SAMPLE = range(7)


def packed_ascending(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers, as compressed differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u8"), dtype="<u8")


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _MESSAGE)


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def seat(customers: np.ndarray, strength: np.ndarray | float, discount: float, parent: np.ndarray | float, rng) -> np.ndarray:
    """Tables of each dish after its customers have taken seats one after another.

    strength: the restaurant's concentration plus its discount times the tables of the other dishes. With t tables and
    i customers seated the next one takes a new table by weight (strength + discount * t) * parent against i - discount *
    t. From _ONE_BY_ONE customers on they come in blocks, each with the weights at its middle.
    """
    strength, parent = np.broadcast_to(strength, customers.shape), np.broadcast_to(parent, customers.shape)
    tables = np.minimum(customers, 1).astype(np.int64)
    open_, seated = np.flatnonzero(customers > 1), 1
    while len(open_):
        block = max(1, seated // 16) if seated >= _ONE_BY_ONE else 1
        coming = np.minimum(customers[open_] - seated, block)
        t = tables[open_]
        new = (strength[open_] + discount * t) * parent[open_]
        p = new / (new + seated + (coming - 1) / 2 - discount * t)
        tables[open_] = t + (rng.random(len(open_)) < p if block == 1 else rng.binomial(coming, p))
        seated += block
        open_ = open_[customers[open_] > seated]
    return tables


def _cuts(keys: np.ndarray, n: int) -> np.ndarray:
    """Where ascending 64-bit keys fall into n shards of equal ranges."""
    bounds = np.array([(s << 64) // n for s in range(1, n)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, bounds), [len(keys)]))


def _to_shards(chunk: int, kind: int, n: int, keys: np.ndarray, *numbers: np.ndarray) -> Iterator[dict]:
    cuts = _cuts(keys, n)
    for s in range(n):
        part = slice(cuts[s], cuts[s + 1])
        if cuts[s] < cuts[s + 1]:
            values = {"bcd"[i]: packed(v[part].astype("<u4")) for i, v in enumerate(numbers)}
            yield {"place": s, "kind": kind, "origin": chunk, "a": packed_ascending(keys[part]), **values}


def _exchange(messages: DataFrame, mode: str, **known) -> DataFrame:
    """Add up what chunks send for the same keys, and answer each chunk in the order of its keys; stored.

    mode "words" answers with the sums, totals in a row of place -1 (x: sum, y: keys above 0). "pairs" also says which
    chunk owns a key: the first that sent a number above 0. "tables" takes the tables of words as dishes (b) and as
    contexts (c), seats the former as the parent's customers and answers with contexts' tables, customers and tables.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["place", "origin", "a", "b", "c"]).to_pylist(), key=lambda r: r["origin"])
        keys = [unpacked_ascending(r["a"]) for r in rows]
        ends = np.cumsum([len(k) for k in keys])
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        size = int(inverse.max()) + 1
        first = np.concatenate([unpacked(r["b"], "<u4") for r in rows]).astype(np.int64)
        sums = np.bincount(inverse, first, size).astype(np.int64)
        answers, totals = {"b": sums}, (int(sums.sum()), int((sums > 0).sum()))
        own = None
        if mode == "pairs":
            at = np.flatnonzero(first > 0)[::-1]
            owner = np.full(size, -1)
            owner[inverse[at]] = at
            own = owner[inverse] == np.arange(len(inverse))
        elif mode == "tables":
            contexts = np.bincount(inverse, np.concatenate([unpacked(r["c"], "<u4") for r in rows]), size).astype(np.int64)
            rng = np.random.default_rng([_SEED, known["sweep"], rows[0]["place"]])
            strength = PARENT_STRENGTH + PARENT_DISCOUNT * known["tables"]
            tables = seat(sums, strength, PARENT_DISCOUNT, known["base"], rng)
            answers, totals = {"b": contexts, "c": sums, "d": tables}, (totals[0], int(tables.sum()))
        out = [{"place": -1, "kind": -1, "origin": rows[0]["place"], "x": totals[0], "y": totals[1]}]
        for r, end, k in zip(rows, ends.tolist(), keys, strict=True):
            part = slice(end - len(k), end)
            row = {c: packed(v[inverse[part]].astype("<u4")) for c, v in answers.items()}
            if own is not None:
                row["c"] = packed(own[part])
            out.append({"place": r["origin"], "kind": known["kind"], "origin": r["place"], **row})
        return _table(out)

    return stored(messages.groupBy("place").applyInArrow(run, _DDL), f"sums-{mode}")


def _read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks as rows. a: doc_ids, b: flags (1: id given, 2: held out), c: tokens per document, d: hashes of the words
    in ascending order, e: per token the number of its word; x: tokens."""
    part, serial = TaskContext.get().partitionId(), 0

    def chunk(ids, flags, sizes, words, tokens) -> pa.RecordBatch:
        hashes, number = np.unique(np.array([_hash(w) for w in words], np.uint64), return_inverse=True)
        row = {
            "place": (part << 24) + serial, "kind": _CHUNK, "a": packed(np.array(ids, "<i8")), "b": packed(np.array(flags, "u1")),
            "c": packed(np.array(sizes, "<i8")), "d": packed_ascending(hashes),
            "e": packed(number[np.concatenate(tokens)].astype("<u4")), "x": sum(sizes),
        }
        return pa.RecordBatch.from_pylist([row], _MESSAGE)

    def fresh():
        return [], [], [], {_END: 0, _BEGIN: 1}, []

    now, size = fresh(), 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), utf8(batch["text"]), strict=True):
            if size and size + len(text) > CHUNK_BYTES:
                yield chunk(*now)
                now, size, serial = fresh(), 0, serial + 1
            ids, flags, sizes, words, tokens = now
            numbers = [words.setdefault(w, len(words)) for w in text.lower().split()]
            numbers.append(0)
            held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % MODULUS == REMAINDER
            ids.append(doc_id or 0)
            flags.append((doc_id is not None) + 2 * held)
            sizes.append(len(numbers))
            tokens.append(np.array(numbers, np.uint32))
            size += len(text) + 1
    if now[0]:
        yield chunk(*now)


class _Chunk:
    """A chunk's numbers, opened."""

    def __init__(self, row: dict):
        self.place = row["place"]
        self.flags, self.sizes = unpacked(row["b"], "u1"), unpacked(row["c"], "<i8")
        self.words, self.tokens = unpacked_ascending(row["d"]), unpacked(row["e"], "<u4")
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.context = np.empty_like(self.tokens)
        self.context[1:] = self.tokens[:-1]
        self.context[self.starts] = np.searchsorted(self.words, np.uint64(_hash(_BEGIN)))
        self.trained = np.repeat(self.flags & 2 == 0, self.sizes)

    def pairs(self) -> np.ndarray:
        """A 64-bit hash of each token's bigram."""
        x = self.words[self.context] * np.uint64(0x9E3779B97F4A7C15) + self.words[self.tokens]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _send_words(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                counts = np.bincount(chunk.tokens[chunk.trained], minlength=len(chunk.words))
                yield from _table(list(_to_shards(chunk.place, _WORDS, n, chunk.words, counts))).to_batches()

    return run


def _send_pairs(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                keys, inverse = np.unique(chunk.pairs(), return_inverse=True)
                counts = np.bincount(inverse[chunk.trained], minlength=len(keys))
                yield from _table(list(_to_shards(chunk.place, _PAIRS, n, keys, counts))).to_batches()

    return run


def _joined(rows: list[dict], kind: int, column: str, dtype: str) -> np.ndarray:
    """The shards' answers of a kind, in the order of the chunk's keys."""
    parts = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["origin"])
    return np.concatenate([unpacked(r[column], dtype) for r in parts]) if parts else np.zeros(0, dtype)


def _make_cells(table: pa.Table) -> pa.Table:
    """What a chunk seats. a: the bigrams counted twice or more, b: whether the chunk owns each; c, d, e: contexts, words
    and counts of those it owns; f, g: its bigrams counted once, which have one table, by word and by context; h: the
    chunk's words."""
    rows = table.to_pylist()
    chunk = _Chunk(next(r for r in rows if r["kind"] == _CHUNK))
    counts, own = _joined(rows, _PAIRS, "b", "<u4"), _joined(rows, _PAIRS, "c", "?")
    keys, at = np.unique(chunk.pairs(), return_index=True)
    context, word = chunk.context[at], chunk.tokens[at]
    more, once = counts > 1, own & (counts == 1)
    mine = more & own
    size = len(chunk.words)
    row = {
        "place": chunk.place, "kind": _CELLS, "a": packed_ascending(keys[more]), "b": packed(own[more]),
        "c": packed(context[mine]), "d": packed(word[mine]), "e": packed(counts[mine].astype("<u4")),
        "f": packed(np.bincount(word[once], minlength=size).astype("<u4")),
        "g": packed(np.bincount(context[once], minlength=size).astype("<u4")), "h": packed_ascending(chunk.words),
    }
    return _table([row])


def _sweep(sweep: int, n: int, base: float, totals: tuple[int, int]):
    """Seat the customers of a chunk's bigrams and send the words' tables. a of the seats: tables of each bigram."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        cells = next(r for r in rows if r["kind"] == _CELLS)
        words = unpacked_ascending(cells["h"])
        context, word, counts = (unpacked(cells[c], "<u4").astype(np.int64) for c in "cde")
        if sweep == 0:
            tables = np.ones(len(counts), np.int64)
        else:
            before = unpacked(next(r for r in rows if r["kind"] == _SEATS)["a"], "<u4").astype(np.int64)
            all_tables, customers, parents = (_joined(rows, _TABLES, c, "<u4").astype(np.int64) for c in "bcd")
            parent = parent_probability(customers[word], parents[word], totals, base)
            strength = STRENGTH + DISCOUNT * np.maximum(all_tables[context] - before, 0)
            tables = seat(counts, strength, DISCOUNT, parent, np.random.default_rng([_SEED, sweep, cells["place"]]))
        size = len(words)
        dishes = np.bincount(word, tables, size) + unpacked(cells["f"], "<u4")
        contexts = np.bincount(context, tables, size) + unpacked(cells["g"], "<u4")
        out = [{"place": cells["place"], "kind": _SEATS, "a": packed(tables.astype("<u4"))}]
        return _table(out + list(_to_shards(cells["place"], _TABLES, n, words, dishes, contexts)))

    return run


def parent_probability(customers, tables, totals: tuple[int, int], base: float):
    """Of words in the parent restaurant; totals: its customers and tables."""
    new = (PARENT_STRENGTH + PARENT_DISCOUNT * totals[1]) * base
    return (customers - PARENT_DISCOUNT * tables + new) / (PARENT_STRENGTH + totals[0])


def _send_seats(n: int):
    """The tables of the bigrams counted more than once, summed over the averaged sweeps, from their owners; every chunk
    that has such a bigram asks."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        cells = next(r for r in rows if r["kind"] == _CELLS)
        keys, own = unpacked_ascending(cells["a"]), unpacked(cells["b"], "?")
        tables = np.zeros(len(keys), np.int64)
        tables[own] = sum(unpacked(r["a"], "<u4").astype(np.int64) for r in rows if r["kind"] == _SEATS)
        return _table(list(_to_shards(cells["place"], _SEATS, n, keys, tables)))

    return run


_SCORES = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    + [("base_score", pa.float64()), ("score", pa.float64())]
)


def _score(n_words: int, n_docs: int, samples: list[tuple[int, int]], total: float):
    base = 1 / (n_words + 1)

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        row = next(r for r in rows if r["kind"] == _CHUNK)
        chunk = _Chunk(row)
        known = _joined(rows, _WORDS, "b", "<u4").astype(np.int64)
        begins = np.searchsorted(chunk.words, np.uint64(_hash(_BEGIN)))
        counts = _joined(rows, _PAIRS, "b", "<u4").astype(float)
        tables = np.where(counts > 0, float(len(samples)), 0.0)
        tables[counts > 1] = _joined(rows, _SEATS, "b", "<u4")
        # customers of a context: its tokens, but of the beginning the documents
        customers = known.astype(float)
        customers[begins] = n_docs
        _, inverse = np.unique(chunk.pairs(), return_inverse=True)
        own = (counts - DISCOUNT * tables / max(len(samples), 1))[inverse]
        shared = np.zeros(len(chunk.tokens))
        for s, totals in enumerate(samples):
            all_tables, dishes, parents = (_joined(rows, _SAMPLE + s, c, "<u4").astype(float) for c in "bcd")
            parent = parent_probability(dishes, parents, totals, base)
            shared += (STRENGTH + DISCOUNT * all_tables)[chunk.context] * parent[chunk.tokens]
        p = (own + shared / max(len(samples), 1)) / (STRENGTH + customers[chunk.context])
        plain = np.log10((known + 1.0) / total)
        add = lambda x: np.add.reduceat(x, chunk.starts)
        ids = pa.array(unpacked(row["a"], "<i8"), mask=chunk.flags & 1 == 0)
        columns = [
            ids, pa.array(chunk.flags & 2 > 0), pa.array(chunk.sizes), pa.array(add((known > 0)[chunk.tokens].astype(np.int64))),
            pa.array(add(plain[chunk.tokens])), pa.array(add(np.log10(p))),
        ]
        return pa.Table.from_arrays(columns, schema=_SCORES)

    return run


def _in_buckets(df: DataFrame, label: str, n: int) -> DataFrame:
    """Stored in n buckets by place, so that grouping by place moves no row."""
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(n, "place").option("path", f"{scratch_root(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def _with(kept: DataFrame, sent: DataFrame, run: Callable[[pa.Table], pa.Table], schema: str = _DDL) -> DataFrame:
    """`run` over the rows of each place, of a table in buckets and of what is sent to it."""

    def both(own: pa.Table, came: pa.Table) -> pa.Table:
        return run(pa.concat_tables([own.cast(_MESSAGE), came.cast(_MESSAGE)]))

    return kept.groupBy("place").cogroup(sent.groupBy("place")).applyInArrow(both, schema)


def product_total(n_train: int, n_words: int) -> float:
    return (n_train + 1.0) * (n_words + 1.0)


def add_one_total(n_train: int, n_words: int) -> float:
    """What makes add-one unigrams over the known words and one unknown sum to one."""
    return n_train + 1.0 * (n_words + 1)


def score(
    docs: DataFrame, sweeps: int = SWEEPS, samples: int = SAMPLES, base_total: Callable[[int, int], float] = product_total
) -> DataFrame:
    """log10 probability of each whole text under a model of the texts that are not held out.

    Held out are texts whose crc32 of the id, as text, leaves REMAINDER by MODULUS. Tokens are words, A-Z lower-cased,
    then one end. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score. A token with count c has
    the base (c + 1) / base_total(training tokens, their distinct words).

    Null or empty text: the end alone. A text longer than a chunk is a chunk by itself. Other columns of docs are not read,
    whatever their names. A null doc_id is never held out. Repeated rows are documents of their own and are
    counted as often. Without training texts every token has probability 1, the uniform base over one unknown word. No
    rows give no rows.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    chunks = _in_buckets(given.mapInArrow(_read_chunks, _DDL), "chunks", n)
    words = _exchange(chunks.mapInArrow(_send_words(n), _DDL), "words", kind=_WORDS)
    n_train, n_words = (x or 0 for x in words.filter("place = -1").agg(F.sum("x"), F.sum("y")).first())
    base = 1 / (n_words + 1)
    pairs = _exchange(chunks.mapInArrow(_send_pairs(n), _DDL), "pairs", kind=_PAIRS)
    answers = pairs.filter("place >= 0")
    cells = _in_buckets(_with(chunks, answers, _make_cells), "cells", n)
    seats, tables, totals, kept, passed = None, None, (0, n_words), [], []
    for sweep in range(sweeps + 1):
        settle(spark)
        seating = _sweep(sweep, n, base, totals)
        if sweep == 0:
            done = cells.groupBy("place").applyInArrow(seating, _DDL)
        else:
            done = _with(cells, seats.union(tables), seating)
        done = stored(done, "sweep")
        seats = done.filter(F.col("kind") == _SEATS)
        sums = _exchange(done.filter(F.col("kind") == _TABLES), "tables", kind=_TABLES, sweep=sweep, tables=totals[1], base=base)
        totals = tuple(x or 0 for x in sums.filter("place = -1").agg(F.sum("x"), F.sum("y")).first())
        tables = sums.filter("place >= 0")
        for old in passed:
            drop_stored(old)
        passed = []
        if sweep > sweeps - samples:
            kept.append((seats, tables, totals))
        else:
            passed = [done, sums]  # the next sweep reads them
    settle(spark)
    averaged = reduce(DataFrame.union, [one for one, _, _ in kept])
    seated = _exchange(_with(cells, averaged, _send_seats(n)), "seats", kind=_SEATS)
    training_docs = _training_documents(given)
    settle(spark)
    sums = words.filter("place >= 0").union(answers).union(seated.filter("place >= 0"))
    for i, (_, one, _) in enumerate(kept):
        sums = sums.union(one.withColumn("kind", F.lit(_SAMPLE + i)))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = _with(chunks, sums, _score(n_words, training_docs, [t for _, _, t in kept], base_total(n_train, n_words)), schema)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _training_documents(given: DataFrame) -> int:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % MODULUS == REMAINDER
    return given.filter(~F.coalesce(held, F.lit(False))).count()


def perplexity(scores: DataFrame) -> DataFrame:
    """(held_out, perplexity, base_perplexity) per token of scored texts."""
    return scores.groupBy("held_out").agg(
        F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / F.sum("n_tokens")).alias("base_perplexity"),
    )
