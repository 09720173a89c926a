"""Ranked lexical search turned round: the items' terms are the index, and the documents stream through it.

The inverted index over the items' terms (term to items) is small and broadcast; each document's term counts pass once,
raise the scores of the items that share terms with it, and update a heap of bounded size per item. Tasks' heaps are
merged. Items beyond the size of one broadcast are taken in blocks; an item too large for any block is joined instead.

The score of a document for an item is the sum over the item's terms of ``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` with
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 10 + (90 * n * N) div L``, in whole numbers.
"""
from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremeter.llm.common import drop_stored, text_of, utf8
from faremeter.operators.ranking import top_k_per
from faremeter.sources.scratch import stored

#: A block of items ends with the item that brings it to so many postings (pairs of item and term). An item with more of
#: its own is joined. So a broadcast index has less than twice as many postings, each with a term of at most `_LONG` bytes.
BLOCK_POSTINGS = 200_000
#: Terms longer than this are known by a 128-bit hash; equal hashes count as equal terms.
_LONG = 32
#: Score cells and score updates that a task holds at a time.
_CELLS = 1 << 20
_NO_ID = 1 << 63

# A term is a run of what is neither an ASCII control, space, punctuation nor DEL; bytes from 0x80 on are parts of characters.
_CLEAN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text with repeats, A-Z lower-cased."""
    return text.lower().translate(_CLEAN).split()


def _key(term: bytes) -> bytes:
    return term if len(term) <= _LONG else b"\0" + xxhash.xxh3_128_digest(term)


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted({_key(t) for t in terms(text)}) for text in utf8(batch["text"])]
        columns = [batch["item_id"], pa.array([len(f) for f in found], pa.int64()), pa.array(found, pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "n_terms", "terms"])


def _with_blocks(items: DataFrame) -> DataFrame:
    """Stored items with a row number, their terms and the block that answers them (null: by the join)."""
    given = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    listed = given.mapInArrow(_item_rows, "item_id long, n_terms long, terms array<binary>").filter("n_terms > 0")
    listed = stored(listed.withColumn("item", F.monotonically_increasing_id()), "search-items")
    small = listed.filter(F.col("n_terms") <= BLOCK_POSTINGS)
    total = small.agg(F.coalesce(F.sum("n_terms"), F.lit(0)).alias("n")).first()["n"]
    # postings are added up inside slices of a few blocks each, so the rows of one window are bounded, too
    slices = 1 + int(total) // (8 * BLOCK_POSTINGS)
    before = Window.partitionBy("slice").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    numbered = small.select("item", "n_terms", F.pmod(F.xxhash64("item"), F.lit(slices)).alias("slice")).withColumn(
        "block", F.floor(F.coalesce(F.sum("n_terms").over(before), F.lit(0)) / BLOCK_POSTINGS).cast("long")
    )
    return stored(listed.join(numbered.select("item", "slice", "block"), "item", "left"), "search-blocks")


# --------------------------------------------------------------------------- one block of items


def _count_terms(shipped):
    """Per document: n, and the numbers and counts of its terms that the block's items have."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(shipped.value)}
        for batch in batches:
            sizes, ids, tfs, offsets = [], [], [], [0]
            for text in utf8(batch["text"]):
                found = terms(text)
                sizes.append(len(found))
                for term, tf in Counter(found).items():
                    i = number.get(term if len(term) <= _LONG else _key(term))
                    if i is not None:
                        ids.append(i)
                        tfs.append(tf)
                offsets.append(len(ids))
            at = pa.array(offsets, pa.int32())
            columns = [
                batch["doc_id"], pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


class Heaps:
    """The k best documents of each item: (score, minus doc_id), so the least entry is the one to go first."""

    def __init__(self, n_items: int, k: int):
        self.k, self.held = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def offer(self, scores: np.ndarray, doc_ids: list[int]) -> None:
        """Scores of some documents (rows) for all items; those that reach an item's least one are looked at."""
        for row, item in zip(*(x.tolist() for x in np.nonzero(scores >= self.least)), strict=True):
            heap, entry = self.held[item], (int(scores[row, item]), -doc_ids[row])
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[item] = heap[0][0]


def _score(shipped, n_docs: int, n_terms: int, k: int):
    """Stream documents' term counts through the index and give the task's heaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, starts, posted, weights = shipped.value
        degrees, heaps = np.diff(starts), Heaps(len(items), k)
        for batch in batches:
            offsets = batch["terms"].offsets.to_numpy().astype(np.int64)
            own = slice(offsets[0], offsets[-1])
            term = batch["terms"].values.to_numpy()[own].astype(np.int64)
            tf = batch["tfs"].values.to_numpy()[own]
            offsets = offsets - offsets[0]
            doc = np.repeat(np.arange(len(batch)), np.diff(offsets))
            m = 10 + 90 * batch["n"].to_numpy() * n_docs // max(1, n_terms)
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
            ids = [_NO_ID if i is None else i for i in batch["doc_id"].to_pylist()]
            updates = np.concatenate([[0], np.cumsum(degrees[term])])[offsets]
            at = 0
            while at < len(batch):
                # as many documents as keep both the cells and the updates within bounds, at least one
                end = int(np.searchsorted(updates, updates[at] + _CELLS, "right")) - 1
                end = min(len(batch), max(at + 1, min(end, at + _CELLS // max(1, len(items)))))
                some = slice(offsets[at], offsets[end])
                counts = degrees[term[some]]
                place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
                item = posted[np.repeat(starts[term[some]], counts) + place]
                cell = np.repeat(doc[some] - at, counts) * len(items) + item
                # doubles hold these sums of whole numbers exactly: terms of a block times the greatest impact is below 2^53
                sums = np.bincount(cell, np.repeat(impact[some], counts), minlength=(end - at) * len(items))
                heaps.offer(sums.astype(np.int64).reshape(end - at, len(items)), ids[at:end])
                at = end
        best = [(items[i], None if d == -_NO_ID else -d, s) for i, heap in enumerate(heaps.held) for s, d in heap]
        columns = [list(c) for c in zip(*best, strict=True)] or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return run


def _weight(df: Column, n_docs: Column | int) -> Column:
    return F.floor(F.lit(1000) * F.log((2 * F.lit(n_docs) + 2) / (2 * df + 1))).cast("long")


def _sizes(counted: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""
    row = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    return int(row["docs"]), int(row["terms"])


def _by_index(docs: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """(item, doc_id, score): at least the k best documents of each item of a block."""
    spark = docs.sparkSession
    rows = block.select("item", "terms").orderBy("item").collect()  # less than twice BLOCK_POSTINGS terms
    vocabulary = sorted({bytes(t) for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(vocabulary)}
    counted = stored(docs.mapInArrow(_count_terms(spark.sparkContext.broadcast(vocabulary)),
                                     "doc_id long, n long, terms array<int>, tfs array<long>"), "search-counts")
    n_docs, n_terms = _sizes(counted)
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for r in frequency.select("term", _weight(F.col("df"), n_docs).alias("w")).collect():
        weights[r["term"]] = r["w"]
    term = np.array([number[bytes(t)] for r in rows for t in r["terms"]], np.int64)
    item = np.repeat(np.arange(len(rows)), [len(r["terms"]) for r in rows])
    order = np.lexsort((item, term))
    starts = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
    index = spark.sparkContext.broadcast(([r["item"] for r in rows], starts, item[order], weights))
    return counted.filter(F.size("terms") > 0).mapInArrow(
        _score(index, n_docs, n_terms, k), "item long, doc_id long, score long"
    )


# --------------------------------------------------------------------------- items of any size


def _all_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, doc_id, text in zip(batch["doc"].to_pylist(), batch["doc_id"].to_pylist(), utf8(batch["text"]), strict=True):
            found = Counter(terms(text))
            n = sum(found.values())
            keys = [_key(t) for t in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([at] * len(keys), pa.int64()), pa.array([doc_id] * len(keys), pa.int64()),
                    pa.array([n] * len(keys), pa.int64()), pa.array(keys, pa.binary()), pa.array(list(found.values()), pa.int64()),
                ],
                names=["doc", "doc_id", "n", "term", "tf"],
            )


def _by_join(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The same scores for items whose terms no broadcast holds: their terms joined to the documents' counts."""
    # a number per row, fixed before anything joins on it
    numbered = stored(docs.withColumn("doc", F.monotonically_increasing_id()), "search-docs")
    counts = stored(numbered.mapInArrow(_all_counts, "doc long, doc_id long, n long, term binary, tf long"), "search-terms")
    per_doc = counts.groupBy("doc").agg(F.first("n").alias("n"))
    n_docs, n_terms = _sizes(per_doc)
    asked = items.select("item", F.explode("terms").alias("term"))
    matched = counts.join(asked.select("term").distinct(), "term", "left_semi")
    weights = matched.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = asked.join(weights, "term").select("item", "term", _weight(F.col("df"), n_docs).alias("w"))
    m = F.lit(10) + F.expr(f"(90 * n * {n_docs}L) div {max(1, n_terms)}L")
    impact = F.expr("w * ((1000000000 * tf) div (1000 * tf + 8 * m))")
    scored = matched.withColumn("m", m).join(weights, "term").groupBy("item", "doc", "doc_id").agg(F.sum(impact).alias("score"))
    return scored.filter("score > 0").select("item", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each item, of those with a score above 0.

    `docs` has doc_id and text, `items` item_id and text; other columns are not read. Null and empty texts have no terms:
    such a document is not counted and such an item has no rows. Texts are taken whole, whatever their length. Equal
    scores go by ascending doc_id, a null doc_id last. Repeated rows of docs are documents of their own, repeated rows of
    items have a ranking each. Without documents or items there are no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    blocked = _with_blocks(items)
    found = [
        _by_index(texts, blocked.filter((F.col("slice") == r["slice"]) & (F.col("block") == r["block"])), k)
        for r in blocked.filter("block is not null").select("slice", "block").distinct().orderBy("slice", "block").collect()
    ]
    large = blocked.filter("block is null")
    if not large.isEmpty():
        found.append(_by_join(texts, large))
    if not found:
        found.append(blocked.select("item", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    best = top_k_per(reduce(DataFrame.unionByName, found), ["item"], order, k, "rank")
    return best.join(blocked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


SQL = r"""
with doc_terms as (
  select row, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as row, doc_id, text from documents) d),
item_terms as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
sizes as (select row, doc_id, count(*) as n from doc_terms group by row, doc_id),
corpus as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes),
counts as (
  select row, term, count(*) as tf from doc_terms where term in (select term from item_terms) group by row, term),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / (2 * count(*) + 1))) as bigint) as w
  from counts cross join corpus group by term, n_docs),
scores as (
  select i.item_id, s.doc_id,
    cast(sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (10 + (90 * s.n * g.n_docs) // g.n_terms)))) as bigint) as score
  from item_terms i join weights w on w.term = i.term join counts c on c.term = i.term join sizes s on s.row = c.row cross join corpus g
  group by i.item_id, s.row, s.doc_id),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 10
"""
