"""Near duplicates by SimHash fingerprints, with pigeonring filtering."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremeter.llm.common import as_row, partitions, text_of, utf8
from faremeter.llm.components import components
from faremeter.sources.scratch import stored

SHINGLE_WORDS = 4
MOST_BITS = 4
_SEED = 42
#: Runs of equal keys above this length are linked by searching from member to member, shorter ones pair by pair.
_LONG_RUN = 48


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every run of `words` words joined by one space; all words if there are fewer; nothing without words."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    h = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([h(joined, _SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.array([h(joined[i:j], _SEED) for i, j in spans], np.uint64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes, repeats included; zero without words."""
    hashes = shingle_hashes(text, words)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t, words) for t in utf8(batch["text"])], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], prints], names=["doc_id", "mark", "print"])

    return run


def segment_widths(most: int) -> list[int]:
    """64 bits in most + 1 segments of nearly equal width."""
    m = most + 1
    return [64 // m + (i < 64 % m) for i in range(m)]


def _layout(most: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment, from the highest bits down."""
    out, at = [], 64
    for width in segment_widths(most):
        at -= width
        out.append((at, width))
    return out


def chain_keys(prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, which print) of the chains of two segments.

    With most + 1 segments a budget of most / (most + 1) differences per segment allows none in the first segment of a
    chain and one in the first two. Two prints that pass share the first segment and, for some bit, the second one
    without that bit. A key has the chain's start in its highest four bits and a hash of that bit and the two values
    below; if hashes collide the checks that follow tell the prints apart.
    """
    layout, keys = _layout(most), []
    values = [(prints >> np.uint64(shift)) & np.uint64((1 << width) - 1) for shift, width in layout]
    for i in range(len(layout)):
        j = (i + 1) % len(layout)
        for bit in range(layout[j][1]):
            second = values[j] & np.uint64(((1 << layout[j][1]) - 1) ^ (1 << bit))
            x = (values[i] << np.uint64(32)) ^ second ^ np.uint64(bit * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            keys.append(((x ^ (x >> np.uint64(32))) >> np.uint64(4)) | np.uint64(i << 60))
    return np.concatenate(keys), np.tile(np.arange(len(prints)), len(keys))


def _explode_keys(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_prints = batch["print"].to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(0, len(all_prints), 8192):
                prints = all_prints[i : i + 8192]
                keys, which = chain_keys(prints.view(np.uint64), most)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(prints[which])], names=["key", "print"])

    return run


def _chain_holds(diff: np.ndarray, start: np.ndarray, most: int) -> np.ndarray:
    """Whether the chains from these starts stay within their cumulative budgets; the last budget is the whole distance."""
    layout = _layout(most)
    m = len(layout)
    per_segment = np.stack([np.bitwise_count((diff >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in layout], axis=1)
    ok, total = np.ones(len(diff), bool), np.zeros(len(diff), np.int64)
    for length in range(1, m + 1):
        total = total + per_segment[np.arange(len(diff)), (start + length - 1) % m]
        ok &= total * m <= length * most
    return ok & (np.bitwise_count(diff) <= most)


def _links_of_long_run(prints: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever is connected in a run: each member reached is searched from once.

    The whole distance decides, so no link is lost; members already reached are not compared again.
    """
    rest = prints
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            near = np.bitwise_count(rest ^ one) <= most
            if near.any():
                reached = rest[near]
                yield np.full(len(reached), one), reached
                front.extend(reached)
                rest = rest[~near]


def links_in_runs(keys: np.ndarray, prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between prints in runs of equal keys (sorted), at most `most` bits apart."""
    if not len(keys):
        return prints, prints
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    lengths = np.diff(np.append(first, len(keys)))
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for at, n in zip(first[lengths > _LONG_RUN].tolist(), lengths[lengths > _LONG_RUN].tolist(), strict=True):
        for a, b in _links_of_long_run(prints[at : at + n], most):
            left.append(a)
            right.append(b)
    short = np.repeat((lengths > 1) & (lengths <= _LONG_RUN), lengths)
    keys, prints = keys[short], prints[short]
    starts = (keys >> np.uint64(60)).astype(np.int64)
    at = np.arange(len(keys))
    for step in range(1, _LONG_RUN):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        diff = prints[at] ^ prints[at + step]
        near = _chain_holds(diff, starts[at], most)
        left.append(prints[at[near]])
        right.append(prints[at[near] + step])
    a, b = np.concatenate(left), np.concatenate(right)
    pairs = np.unique(np.stack([a, b], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _link(most: int):
    def emit(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        a, b = links_in_runs(keys, prints, most)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = [], []  # the run that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            k, p = (batch[c].to_numpy().view(np.uint64) for c in ("key", "print"))
            last = int(np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))[-1])  # where the batch's last run begins
            goes_on = bool(keys) and keys[-1][-1] == k[0]
            if goes_on and last == 0:
                keys.append(k)
                prints.append(p)
                continue
            yield emit(np.concatenate([*keys, k[:last]]), np.concatenate([*prints, p[:last]]))
            keys, prints = [k[last:]], [p[last:]]
        if keys:
            yield emit(np.concatenate(keys), np.concatenate(prints))

    return run


def print_links(prints: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """Links (a, b) between distinct 64-bit fingerprints of a table (print) that connect all at most `most` bits apart.

    By pigeonring, prints at most `most` bits apart have a start from which every chain of consecutive segments stays
    within its share of the differences. Chains of two segments become keys (`chain_keys`); in a run of equal keys the
    longer chains prune what is left before the whole distance is taken. A long run gives links that connect it, not all
    its pairs.
    """
    if most < 1:
        return prints.sparkSession.createDataFrame([], "a long, b long")
    n = partitions(prints.sparkSession)
    keyed = prints.select("print").distinct().mapInArrow(_explode_keys(most), "key long, print long")
    sorted_runs = keyed.repartition(n, "key").sortWithinPartitions("key", "print")
    return sorted_runs.mapInArrow(_link(most), "a long, b long").distinct()


def document_prints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, mark, print), stored: fingerprints of whole texts, mark a hash of the text that tells rows apart."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), text_of().cast("binary").alias("text")
    )
    return stored(narrow.mapInArrow(_fingerprints(words), "doc_id long, mark long, print long"), "prints")


def print_components(prints: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """(print, root) for each fingerprint that has a link."""
    return components(print_links(prints, most)).select(F.col("node").alias("print"), "root")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MOST_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each document: the component's smallest doc_id is its id.

    Fingerprints at most `most` bits apart are linked; a component is what links reach. Equal fingerprints are one node,
    so copies are never paired. Null or empty text has fingerprint zero, which links like any other. A null doc_id is
    the smallest only where a component has no other. Repeated rows come out as often as they go in. Very long texts count
    with all their shingles. Other columns of docs are not read, whatever their names. No rows give no rows.
    """
    prints = document_prints(docs, words)
    roots = print_components(prints, most)
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = stored(rooted.join(ids, "root").select("print", "component_id"), "print-components")
    return prints.join(by_print, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MOST_BITS) -> DataFrame:
    """One document of each component stays: the smallest doc_id, then the smallest hash of the text; null ids last.

    Of rows that repeat the kept document with its text one stays, with the first values of the other columns.
    """
    prints = document_prints(docs, words)
    roots = print_components(prints, most)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    best = prints.groupBy("print").agg(F.min(order).alias("best"))
    rooted = best.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    kept = rooted.groupBy("root").agg(F.min("best").alias("best")).select("best.doc_id", "best.mark").distinct()
    given = docs.select(as_row(docs), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"))
    same = F.col("g.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("g.mark") == F.col("k.mark"))
    chosen = given.alias("g").join(kept.alias("k"), same, "left_semi")
    return chosen.dropDuplicates(["doc_id", "mark"]).select("row.*")
