"""Nearest neighbours by inner product with a forest of sorted arrays of hash strings."""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremeter.llm.common import partitions, utf8
from faremeter.sources.scratch import stored

#: Trees, and bits of a hash string; bits go up to the dimension, so short vectors have shorter strings.
TREES = 32
BITS = 60
#: A query ascends until the prefixes of all trees together hold so many candidates, as a share of the distinct vectors
#: and with repeats between trees.
SHARE = 0.7
#: Up to so many distinct vectors everything is a candidate.
ALL_BELOW = 1000
#: Rows that a block of an even bucket is cut into.
BLOCK_ROWS = 4096
_SEED = 20240229


def planes(tree: int, dimension: int, bits: int) -> np.ndarray:
    """A tree's hyperplanes: orthogonal directions, turned at random. The last coordinate is the one that evens norms."""
    g = np.random.default_rng(_SEED + tree).standard_normal((dimension + 1, dimension + 1))
    return np.linalg.qr(g)[0][:bits]


def hash_strings(vectors: np.ndarray, extra: np.ndarray, tree: int, bits: int) -> np.ndarray:
    """A hash string per vector as a number, its first bit the highest."""
    signs = np.column_stack([vectors, extra]) @ planes(tree, vectors.shape[1], bits).T > 0
    return signs.astype(np.uint64) @ (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64))


def _arrays(data: list[bytes], dimension: int, kind: str) -> np.ndarray:
    """Stored vectors as doubles. A table of singles is stored as singles, which loses nothing."""
    return np.frombuffer(b"".join(data), kind).reshape(-1, dimension).astype(np.float64)


def _clean(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors as bytes; those null, zero, or with null or non-finite components are left out."""
        for batch in batches:
            ids, vectors, sizes, norms = [], [], [], []
            for vec_id, values in zip(batch["vec_id"].to_pylist(), batch["embedding"].to_pylist(), strict=True):
                if vec_id is None or not values or None in values:
                    continue
                v = np.array(values, "<f8")
                if np.isfinite(v).all() and v.any():
                    ids.append(vec_id)
                    vectors.append(v.astype(kind).tobytes())
                    sizes.append(len(v))
                    norms.append(float(v @ v))
            columns = [pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(sizes, pa.int32()), pa.array(norms, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vec", "size", "norm2"])

    return run


def _entries(dimension: int, kind: str, bits: int, depth: int, trees: int, largest: float, of_query: bool):
    """A row per vector and tree: the bucket (the first `depth` bits) and the hash string.

    Inner products become angles: a stored vector gets a further coordinate that brings it to the largest norm, a query
    gets zero there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = utf8(batch["vec"])
            for i in range(0, len(data), 2048):
                part = slice(i, i + 2048)
                v = _arrays(data[part], dimension, kind)
                extra = np.zeros(len(v)) if of_query else np.sqrt(np.maximum(largest - (v * v).sum(axis=1), 0))
                rest = batch.slice(i, len(v))
                for tree in range(trees):
                    code = hash_strings(v, extra, tree, bits)
                    columns = [
                        pa.array(np.full(len(v), tree, np.int32)), pa.array((code >> np.uint64(bits - depth)).astype(np.int64)),
                        pa.array(code.astype(np.int64)), *(rest[c] for c in batch.schema.names),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["tree", "bucket", "code", *batch.schema.names])

    return run


def _packed(names: list[str]):
    """Group to one row: the group's entries in the order of their hash strings, column by column as bytes."""

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table["cid"].to_numpy(), table["code"].to_numpy()))
        out = {"tree": table["tree"][:1], "bucket": table["bucket"][:1]}
        for name in names:
            if name == "vec":
                data = utf8(table["vec"])
                out[name] = pa.array([b"".join([data[i] for i in order.tolist()])], pa.binary())
            else:
                out[name] = pa.array([table[name].to_numpy()[order].astype("<i8").tobytes()], pa.binary())
        return pa.table(out)

    return run


def _pack(entries: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    schema = "tree int, bucket long, " + ", ".join(f"{n} binary" for n in names)
    return entries.groupBy(*keys).applyInArrow(_packed(names), schema)


def _ranges(codes: np.ndarray, wanted: np.ndarray, depth: np.ndarray | int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the entries lie that share the first `depth` bits with each wanted hash string."""
    shift = (bits - np.asarray(depth)).astype(np.int64)
    low = (wanted >> shift) << shift
    return np.searchsorted(codes, low), np.searchsorted(codes, low + (np.int64(1) << shift))


def _count(bits: int, depth: int):
    """(qid, depth, n): how many entries of a block share exactly so many first bits with a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, wanted, qids = (np.frombuffer(batch[c][i].as_py(), "<i8") for c in ("code", "q_code", "q_cid"))
                counts = np.zeros((bits - depth + 2, len(wanted)), np.int64)
                for x in range(depth, bits + 1):
                    first, last = _ranges(codes, wanted, x, bits)
                    counts[x - depth] = last - first
                    if not counts[x - depth].any():
                        break
                exactly = counts[:-1] - counts[1:]
                x, q = np.nonzero(exactly)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[q]), pa.array((x + depth).astype(np.int32)), pa.array(exactly[x, q])],
                    names=["qid", "depth", "n"],
                )

    return run


def _best(bits: int, dimension: int, kind: str, k: int):
    """(qid, cid, score): of each query's prefix in a block the k vectors with the largest inner products."""

    def of_range(vectors: np.ndarray, cids: np.ndarray, queries: np.ndarray, qids: np.ndarray):
        scores = queries @ vectors.T
        keep = min(k, len(cids))
        # ties at the cut go by id: everything not below the k-th score is kept here and cut exactly later
        floor = np.partition(scores, len(cids) - keep, axis=1)[:, len(cids) - keep]
        q, c = np.nonzero(scores >= floor[:, None] - 1e-12)
        exact = (queries[q] * vectors[c]).sum(axis=1)
        order = np.lexsort((cids[c], -exact, q))
        q, c, exact = q[order], c[order], exact[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        q, c, exact = q[place < keep], c[place < keep], exact[place < keep]
        return qids[q], cids[c], exact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, cids, wanted, qids, depths = (
                    np.frombuffer(batch[c][i].as_py(), "<i8") for c in ("code", "cid", "q_code", "q_cid", "q_depth")
                )
                vectors, queries = (_arrays([batch[c][i].as_py()], dimension, kind) for c in ("vec", "q_vec"))
                first, last = _ranges(codes, wanted, depths, bits)
                for at, end in np.unique(np.stack([first, last], axis=1), axis=0).tolist():
                    if end <= at:
                        continue
                    who = np.flatnonzero((first == at) & (last == end))
                    for j in range(0, len(who), 256):
                        part = who[j : j + 256]
                        found = of_range(vectors[at:end], cids[at:end], queries[part], qids[part])
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["qid", "cid", "score"])

    return run


def _meet(blocks: DataFrame, queries: DataFrame, pieces: int) -> DataFrame:
    """Blocks beside the packed queries of the same bucket, a few blocks to a task."""
    renamed = queries.select("tree", "bucket", *[F.col(c).alias(f"q_{c}") for c in queries.columns if c not in ("tree", "bucket")])
    return blocks.repartition(pieces, "tree", "bucket").join(renamed, ["tree", "bucket"])


def nearest(
    vectors: DataFrame, is_query: Column, k: int, trees: int = TREES, bits: int = BITS, share: float = SHARE
) -> DataFrame:
    """The k nearest found of each query row among all other rows: query_id, rank, vec_id, score.

    `vectors` has (vec_id, embedding); is_query chooses query rows by vec_id. Nearest is the largest inner product in
    double precision, ties go to the smaller vec_id.

    Equal vectors are one entry with the smallest k + 1 of their ids, which is all that a result can use. Each tree is a
    sorted array of hash strings, stored in blocks by bucket (first bits). A query descends in each tree to the entries
    that share its longest prefix, which lie together in the array; counts by shared length, added up over the trees, say
    how far all trees ascend together until they hold `share` of the vectors; what shares that prefix is scored exactly.
    A query whose buckets together hold less than that, so that it would have to ascend past them, and one with fewer than k
    results are compared with everything, block by block.

    Vectors null, zero, with null or non-finite components, of another length than most, or without an id take no part.
    Other columns are not read, whatever their names. Repeated rows count once. Fewer than k others: all of them. No rows give no rows. A bucket that many vectors fall
    into has more blocks, so a block is bounded; queries of a bucket are packed by blocks too.
    """
    spark = vectors.sparkSession
    singles = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "<f4" if singles else "<f8"
    clean = stored(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .mapInArrow(_clean(kind), "vec_id long, vec binary, size int, norm2 double"),
        "vectors",
    )
    usual = clean.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension = usual["size"]
    clean = clean.filter(F.col("size") == dimension)
    asked = clean.withColumn("asked", F.coalesce(is_query, F.lit(False)))
    entries = stored(
        asked.groupBy("vec").agg(F.min("vec_id").alias("cid"), F.max("asked").alias("asked"), F.max("norm2").alias("norm2")),
        "entries",
    )
    n, largest = entries.agg(F.count(F.lit(1)), F.max("norm2")).first()
    bits = min(bits, dimension + 1)
    wanted = share * n if n > ALL_BELOW else trees * n
    depth = max(0, min(bits, int(math.log2(max(trees * n / wanted, 1))) - 1))
    n_blocks = max(1, math.ceil(n / 2**depth / BLOCK_ROWS))
    pieces = max(partitions(spark), trees * 2**depth * n_blocks // 4)
    kinds = "tree int, bucket long, code long"
    data = entries.select("cid", "vec").mapInArrow(
        _entries(dimension, kind, bits, depth, trees, largest, False), f"{kinds}, cid long, vec binary"
    ).withColumn("block", F.pmod(F.xxhash64("cid"), F.lit(n_blocks)))
    blocks = stored(_pack(data, ["tree", "bucket", "block"], ["code", "cid", "vec"]), "forest")
    queries = entries.filter("asked").select("cid", "vec")
    found = _search(blocks, queries, (dimension, kind), bits, depth, trees, largest, wanted, n_blocks, pieces, k + 1)
    classes = found.groupBy("qid", "cid").agg(F.max("score").alias("score"))
    best = _first(classes, "qid", "cid", k + 1)
    best = stored(best, "nearest")
    short = queries.withColumnRenamed("cid", "qid").join(
        best.groupBy("qid").count().filter(F.col("count") >= min(k + 1, n)).select("qid"), "qid", "left_anti"
    )
    if short.limit(1).count():
        rest = _everything(blocks, stored(short, "short"), (dimension, kind), bits, depth, pieces, k + 1)
        best = _first(best.select("qid", "cid", "score").union(rest).groupBy("qid", "cid").agg(F.max("score").alias("score")), "qid", "cid", k + 1)
    return _named(clean, asked, best, k)


def _first(df: DataFrame, key: str, tie: str, n: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), tie)
    return df.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n).drop("place")


def _search(blocks, queries, shape, bits, depth, trees, largest, wanted, n_blocks, pieces, k) -> DataFrame:
    """What the queries find whose buckets in all trees hold as many as wanted; the others find nothing here."""
    kinds = "tree int, bucket long, code long"
    block = F.pmod(F.xxhash64("cid"), F.lit(n_blocks))
    hashed = _entries(*shape, bits, depth, trees, largest, True)
    strings = queries.mapInArrow(hashed, f"{kinds}, cid long, vec binary").drop("vec").withColumn("block", block)
    asked = _pack(strings, ["tree", "bucket", "block"], ["code", "cid"])
    counted = _meet(blocks.select("tree", "bucket", "code"), asked, pieces)
    counts = counted.mapInArrow(_count(bits, depth), "qid long, depth int, n long").groupBy("qid", "depth").agg(F.sum("n").alias("n"))
    deeper = Window.partitionBy("qid").orderBy(F.desc("depth"))
    held = counts.withColumn("held", F.sum("n").over(deeper)).filter(F.col("held") >= wanted)
    ascended = held.groupBy("qid").agg(F.max("depth").cast("long").alias("depth"))
    deep = queries.join(ascended, queries["cid"] == ascended["qid"]).select("cid", "vec", "depth")
    placed = deep.mapInArrow(hashed, f"{kinds}, cid long, vec binary, depth long").withColumn("block", block)
    packed = _pack(placed, ["tree", "bucket", "block"], ["code", "cid", "depth", "vec"])
    return _meet(blocks, packed, pieces).mapInArrow(_best(bits, *shape, k), "qid long, cid long, score double")


def _everything(blocks, queries, shape, bits, depth, pieces, k) -> DataFrame:
    """The given queries against all blocks of one tree."""
    spread = queries.select(
        F.lit(0).alias("tree"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit((1 << depth) - 1).cast("long"))).alias("bucket"),
        F.lit(0).cast("long").alias("code"), F.col("qid").alias("cid"), "vec", F.lit(0).cast("long").alias("depth"),
        F.pmod(F.xxhash64("qid"), F.lit(64)).alias("block"),
    )
    packed = _pack(spread, ["tree", "bucket", "block"], ["code", "cid", "depth", "vec"])
    return _meet(blocks, packed, pieces).mapInArrow(_best(bits, *shape, k), "qid long, cid long, score double")


def _named(clean: DataFrame, asked: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Entries back to rows: ids of equal vectors, and every query row that has the query's vector."""
    order = Window.partitionBy("vec").orderBy("vec_id")
    members = clean.select("vec", "vec_id").distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    listed = members.groupBy("vec").agg(F.min("vec_id").alias("cid"), F.collect_list("vec_id").alias("ids"))
    ids = best.join(listed.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
    results = _first(ids, "qid", "vec_id", k + 1).groupBy("qid").agg(F.collect_list(F.struct("vec_id", "score")).alias("found"))
    rows = asked.filter("asked").select("vec", F.col("vec_id").alias("query_id")).distinct()
    named = rows.join(listed.select("vec", F.col("cid").alias("qid")), "vec").select("qid", "query_id").join(results, "qid")
    each = named.select("query_id", F.explode("found").alias("f")).select("query_id", "f.vec_id", "f.score")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    others = each.filter(F.col("vec_id") != F.col("query_id")).withColumn("rank", F.row_number().over(ranked))
    return others.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
