"""Alignment of two tokenizers' tokens over a corpus, counted by an external merge.

Side A is a byte-level vocabulary over a space and the text, side B a vocabulary of pieces that adds the space itself.
Byte offsets at which tokens of both sides end cut a text into groups, and every A token of a group is linked to every B
token of it. The count of a pair of ids is the number of documents that hold it linked.

* Documents are taken in chunks of bounded size. A chunk's records (pair, document, occurrences) are sorted and parted by
  radix, the low bits of the A id; each part is a run: zstandard frames of ascending pairs with their documents.
* The pairs of the runs of a part are merged by a heap, at most `FAN_IN` runs at a time and level by level, so that no
  group grows with the corpus. Pairs are in order of the A side, so the greatest count of an A id is known as soon as the
  id has passed.
* The totals stream back along the same tree to the runs, and each chunk adds them up for its documents.
"""
from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeter.llm.common import packed, text_of, unpacked, utf8
from faremeter.llm.tokenids import _byte_symbols
from faremeter.sources.scratch import stored

#: A chunk ends with the document that reaches so many bytes of text, or with so many documents.
CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 60_000
#: Runs are parted by so many low bits of the A id.
RADIX_BITS = 8
#: Runs that one merge takes.
FAN_IN = 64
#: Pairs in a frame of a run.
FRAME = 8192
#: Links of a group from which on its distinct ids are paired instead of its tokens; both ways give the same records.
_WIDE = 4096
_PARTS = 1 << RADIX_BITS
_B_BITS, _DOC_BITS = 24, 16
_RUNS = "node long, part int, pairs binary, counts binary, docs binary, times binary, facts binary"
_MERGED = "part int, node long, pairs binary, counts binary"
_TOTALS = "part int, node long, pairs binary, totals binary"
_FACTS = pa.schema(
    [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# --------------------------------------------------------------------------- the two sides


class Definitions(NamedTuple):
    """What a broadcast holds of both vocabularies; the size does not depend on the data."""

    ranks: dict[bytes, int]
    pattern: str
    model: bytes


def definitions(byte_level: str, pattern: str, pieces: str) -> Definitions:
    """Both vocabularies from their files.

    The byte-level one is read from a file of the tokenizers library; its ids are in merge order, so they serve as ranks
    of the same merges. A file for which the two libraries differ on the probes is refused.
    """
    from tokenizers import Tokenizer

    with open(byte_level, encoding="utf-8") as f:
        content = json.load(f)
    symbols = {s: b for b, s in enumerate(_byte_symbols())}
    special = {t["content"] for t in content["added_tokens"]}
    ranks = {bytes(symbols[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in special}
    with open(pieces, "rb") as f:
        out = Definitions(ranks, pattern, f.read())
    library, own = Tokenizer.from_file(byte_level), _byte_encoder(out)
    library.encode_special_tokens = True
    for probe in ("", "  a\n\n b's  123 ", "l'été größer 你好 \U0001f600‍ !!?", " ".join(special), "\tx y\r\n z"):
        if own.encode_ordinary(" " + probe) != library.encode(" " + probe, add_special_tokens=False).ids:
            raise ValueError(f"{byte_level}: not a byte-level vocabulary with merges in order of ids, as {probe!r} shows")
    return out


def _byte_encoder(given: Definitions):
    import tiktoken

    return tiktoken.Encoding("given", pat_str=given.pattern, mergeable_ranks=given.ranks, special_tokens={})


@dataclass
class Sides:
    """Encoders of both sides and the bytes of each id."""

    given: Definitions
    names: np.ndarray = field(init=False)
    name_sizes: np.ndarray = field(init=False)

    def __post_init__(self):
        import sentencepiece

        self.a = _byte_encoder(self.given)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.given.model)
        self.n_a, self.n_b = max(self.given.ranks.values()) + 1, self.b.vocab_size()
        self.a_sizes = np.zeros(self.n_a, np.int64)
        for token, i in self.given.ranks.items():
            self.a_sizes[i] = len(token)
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.n_b)
        ]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # decimal ids with what may follow them: A id and ",", A id and "|", B id and ",", B id and ";"
        written = [f"{i}{end}".encode() for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for end in ends for i in range(n)]
        self.name_sizes = np.array([len(x) for x in written], np.int64)
        width = int(self.name_sizes.max())
        self.names = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in written), np.uint8).reshape(-1, width)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None where a side's bytes are not the space and the text."""
        if not text:
            return None
        b = self.b.encode(text)
        if b"".join([self.b_bytes[i] for i in b]) != b" " + text.encode():
            return None
        return self.a.encode_to_numpy(" " + text).astype(np.int64), np.array(b, np.int64)


class Aligned(NamedTuple):
    """The links of many documents at once: groups in order, and (part, A, B, document) records with occurrences."""

    n_groups: np.ndarray
    n_links: np.ndarray
    written: bytes
    written_ends: np.ndarray
    records: np.ndarray
    times: np.ndarray


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts c0, c1, ...: the owner of each of the sum(c) places, and the place inside its owner."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _summed(records: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct records in order, with the sum of their occurrences (one each if not given)."""
    if times is None:
        records = np.sort(records)
    else:
        order = np.argsort(records, kind="stable")
        records, times = records[order], times[order]
    first = np.flatnonzero(np.diff(records, prepend=records[:1] ^ np.uint64(1))) if len(records) else np.zeros(0, np.int64)
    if times is None:
        return records[first], np.diff(first, append=len(records))
    return records[first], np.add.reduceat(times, first) if len(first) else times


def _record(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
    a, b, doc = a.astype(np.uint64), b.astype(np.uint64), doc.astype(np.uint64)
    part, rest = a & np.uint64(_PARTS - 1), a >> np.uint64(RADIX_BITS)
    high = (part << np.uint64(16) | rest) << np.uint64(_B_BITS)
    return (high | b) << np.uint64(_DOC_BITS) | doc


def align(sides: Sides, a: np.ndarray, b: np.ndarray, a_docs: np.ndarray, b_docs: np.ndarray, n_docs: int) -> Aligned:
    """Groups and links of documents laid end to end; both sides cover the same bytes, document by document."""
    a_ends, b_ends = np.cumsum(sides.a_sizes[a]), np.cumsum(sides.b_sizes[b])
    size = int(a_ends[-1]) + 1 if len(a) else 1
    ends = np.zeros(size, bool)
    ends[b_ends] = True
    a_last = ends[a_ends]
    ends[:] = False
    ends[a_ends] = True
    b_last = ends[b_ends]
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    a_counts, b_counts = np.bincount(a_group), np.bincount(b_group)
    b_starts = np.cumsum(b_counts) - b_counts
    a_stops = np.cumsum(a_counts)
    group_docs = a_docs[a_last]
    links = a_counts * b_counts
    n_groups = np.bincount(group_docs, minlength=n_docs)
    n_links = np.zeros(n_docs, np.int64)
    np.add.at(n_links, group_docs, links)

    # the groups written out: A ids, then B ids, group by group
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + b_starts[a_group]] = a + sides.n_a * a_last
    codes[np.arange(len(b)) + a_stops[b_group]] = 2 * sides.n_a + b + sides.n_b * b_last
    parts = []
    for at in range(0, len(codes), 1 << 18):
        some = codes[at : at + (1 << 18)]
        shown = np.arange(sides.names.shape[1]) < sides.name_sizes[some][:, None]
        parts.append(sides.names[some][shown].tobytes())
    token_ends = np.searchsorted(a_docs, np.arange(n_docs), "right") + np.searchsorted(b_docs, np.arange(n_docs), "right")
    written_ends = np.concatenate([[0], np.cumsum(sides.name_sizes[codes])])[token_ends]

    # every A token with every B token of its group, one record each
    wide = links > _WIDE
    per_token = np.where(wide[a_group], 0, b_counts[a_group])
    owner, place = _spread(per_token)
    records, times = _summed(_record(a[owner], b[b_starts[a_group[owner]] + place], a_docs[owner]))
    if wide.any():
        extra, extra_times = [records], [times]
        for g in np.flatnonzero(wide):
            ids_a, times_a = np.unique(a[a_stops[g] - a_counts[g] : a_stops[g]], return_counts=True)
            ids_b, times_b = np.unique(b[b_starts[g] : b_starts[g] + b_counts[g]], return_counts=True)
            docs = np.full(len(ids_a) * len(ids_b), group_docs[g])
            extra.append(_record(np.repeat(ids_a, len(ids_b)), np.tile(ids_b, len(ids_a)), docs))
            extra_times.append(np.repeat(times_a, len(ids_b)) * np.tile(times_b, len(ids_a)))
        records, times = _summed(np.concatenate(extra), np.concatenate(extra_times))
    return Aligned(n_groups, n_links, b"".join(parts), written_ends, records, times)


# --------------------------------------------------------------------------- runs


def _planes(values: np.ndarray) -> bytes:
    """Integers as compressed planes of bytes, the low bytes of all first."""
    values = np.ascontiguousarray(values)
    return packed(values.view(np.uint8).reshape(len(values), values.itemsize).T.copy())


def _from_planes(data: bytes, dtype: str) -> np.ndarray:
    flat, size = unpacked(data, "u1"), np.dtype(dtype).itemsize
    return flat.reshape(size, -1).T.copy().view(dtype).ravel()


def _framed(*columns: np.ndarray) -> list[bytes]:
    """Columns of one length as frames of at most `FRAME` values: a table of sizes, then the frames."""
    out = []
    for values in columns:
        frames = [_planes(values[i : i + FRAME]) for i in range(0, len(values), FRAME)]
        out.append(np.array([len(frames), *map(len, frames)], "<u4").tobytes() + b"".join(frames))
    return out


def _frames(data: bytes, dtype: str) -> Iterator[np.ndarray]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    at = 4 * (n + 1)
    for size in np.frombuffer(data, "<u4", n, 4).tolist():
        yield _from_planes(data[at : at + size], dtype)
        at += size


def _whole(data: bytes, dtype: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *_frames(data, dtype)])


def merged(runs: list[tuple[bytes, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The k-way merge of runs (ascending pairs, counts): batches of ascending distinct pairs with summed counts.

    The heap holds each run's frame in memory by its last pair. Nothing below the least of those can still come, so all
    pairs up to it leave together; then that run's next frame is read. At most one frame of a run is unpacked.
    """
    cursors = [zip(_frames(p, "<u8"), _frames(c, "<u8"), strict=True) for p, c in runs]
    held: list[tuple[np.ndarray, np.ndarray] | None] = [next(c, None) for c in cursors]
    heap = [(int(h[0][-1]), i) for i, h in enumerate(held) if h is not None]
    heapq.heapify(heap)
    while heap:
        bound, _ = heap[0]
        pairs, counts = [], []
        for i, h in enumerate(held):
            if h is None:
                continue
            cut = int(np.searchsorted(h[0], bound, "right"))
            if cut:
                pairs.append(h[0][:cut])
                counts.append(h[1][:cut])
                held[i] = (h[0][cut:], h[1][cut:])
        while heap and heap[0][0] == bound:
            _, i = heapq.heappop(heap)
            held[i] = next(cursors[i], None)
            if held[i] is not None:
                heapq.heappush(heap, (int(held[i][0][-1]), i))
        yield _summed(np.concatenate(pairs), np.concatenate(counts))


def _chunks(shipped):
    def write(chunk: int, ids: list[int | None], texts: list[bytes], sides: Sides) -> Iterator[tuple]:
        a, b, a_docs, b_docs = [], [], [], []
        n_a, n_b = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for i, text in enumerate(texts):
            both = sides.encode(text.decode())
            if both is not None:
                a.append(both[0])
                b.append(both[1])
                n_a[i], n_b[i] = len(both[0]), len(both[1])
        none = np.zeros(0, np.int64)
        done = align(
            sides, np.concatenate([none, *a]), np.concatenate([none, *b]),
            np.repeat(np.arange(len(ids)), n_a), np.repeat(np.arange(len(ids)), n_b), len(ids),
        )
        starts = np.concatenate([[0], done.written_ends[:-1]]).tolist()
        digests = [
            hashlib.sha256(done.written[s : e - 1]).hexdigest() if e > s else ""
            for s, e in zip(starts, done.written_ends.tolist(), strict=True)
        ]
        columns = [ids, n_a, n_b, done.n_groups, done.n_links, digests]
        facts = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FACTS, strict=True)], schema=_FACTS)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _FACTS) as out:
            out.write_batch(facts)
        yield chunk, -1, None, None, None, None, sink.getvalue().to_pybytes()
        parts = (done.records >> np.uint64(16 + _B_BITS + _DOC_BITS)).astype(np.int64)
        cuts = np.searchsorted(parts, np.arange(_PARTS + 1))
        for part in range(_PARTS):
            s, e = int(cuts[part]), int(cuts[part + 1])
            if s == e:
                continue
            pairs = (done.records[s:e] >> np.uint64(_DOC_BITS)) & np.uint64((1 << (16 + _B_BITS)) - 1)
            docs = (done.records[s:e] & np.uint64((1 << _DOC_BITS) - 1)).astype("<u2")
            first = np.flatnonzero(np.diff(pairs, prepend=pairs[:1] ^ np.uint64(1)))
            distinct, counts = _framed(pairs[first].astype("<u8"), np.diff(first, append=e - s).astype("<u8"))
            yield chunk, part, distinct, counts, _planes(docs), _planes(done.times[s:e].astype("<u4")), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(Definitions(*shipped.value))
        chunk = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            columns = list(zip(*write(chunk, ids, texts, sides), strict=True))
            kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 5)
            names = ["node", "part", "pairs", "counts", "docs", "times", "facts"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), utf8(batch["text"]), strict=True):
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if held >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                    yield from flush()
                    chunk, ids, texts, held = chunk + 1, [], [], 0
        if ids:
            yield from flush()

    return run


# --------------------------------------------------------------------------- the tree of merges


def _row(part: int, node: int, **data: bytes) -> pa.Table:
    return pa.table(
        {"part": pa.array([part], pa.int32()), "node": pa.array([node], pa.int64())} | {k: pa.array([v], pa.binary()) for k, v in data.items()}
    )


def _merge_group(key: tuple, table: pa.Table) -> pa.Table:
    """One node from the runs below it."""
    batches = list(merged(list(zip(table["pairs"].to_pylist(), table["counts"].to_pylist(), strict=True))))
    pairs, counts = _framed(*(np.concatenate([x[i] for x in batches]) for i in (0, 1)))
    return _row(key[0].as_py(), key[1].as_py(), pairs=pairs, counts=counts)


def _with_best(key: tuple, table: pa.Table) -> pa.Table:
    """The totals of a part: twice each pair's count, plus one where no pair of the same A id has a greater count."""
    pairs, counts = _whole(table["pairs"][0].as_py(), "<u8"), _whole(table["counts"][0].as_py(), "<u8")
    side = pairs >> np.uint64(_B_BITS)
    first = np.flatnonzero(np.diff(side, prepend=side[:1] ^ np.uint64(1)))
    greatest = np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(side)))
    totals = counts << np.uint64(1) | (counts == greatest).astype("<u8")
    return _row(key[0].as_py(), 0, pairs=table["pairs"][0].as_py(), totals=_framed(totals)[0])


def _stream_back(key: tuple, below: pa.Table, above: pa.Table) -> pa.Table:
    """Totals of a node for each of the runs it was merged from, in the order of their own pairs."""
    pairs, totals = _whole(above["pairs"][0].as_py(), "<u8"), _whole(above["totals"][0].as_py(), "<u8")
    out = [_framed(totals[np.searchsorted(pairs, _whole(p, "<u8"))])[0] for p in below["pairs"].to_pylist()]
    return pa.table({"part": below["part"], "node": below["node"], "pairs": below["pairs"], "totals": pa.array(out, pa.binary())})


def _contributions(key: tuple, runs: pa.Table, totals: pa.Table) -> pa.Table:
    """The documents of a chunk with what their links add up to."""
    found = dict(zip(totals["part"].to_pylist(), totals["totals"].to_pylist(), strict=True))
    rows = runs.to_pylist()
    with pa.ipc.open_stream(next(r["facts"] for r in rows if r["part"] < 0)) as stream:
        facts = stream.read_all()
    n_best, count_sum = np.zeros(len(facts), np.int64), np.zeros(len(facts), np.int64)
    for row in rows:
        if row["part"] >= 0:
            total = np.repeat(_whole(found[row["part"]], "<u8").astype(np.int64), _whole(row["counts"], "<u8").astype(np.int64))
            docs, times = _from_planes(row["docs"], "<u2").astype(np.int64), _from_planes(row["times"], "<u4").astype(np.int64)
            np.add.at(count_sum, docs, times * (total >> 1))
            np.add.at(n_best, docs, times * (total & 1))
    columns = {c: facts[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table({**columns, "n_best": n_best, "count_sum": count_sum, "groups_sha256": facts["groups_sha256"]})


def _unpacked_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, pairs, totals in zip(*(batch[c].to_pylist() for c in ("part", "pairs", "totals")), strict=True):
            for p, t in zip(_frames(pairs, "<u8"), _frames(totals, "<u8"), strict=True):
                columns = [
                    ((p >> np.uint64(_B_BITS)) << np.uint64(RADIX_BITS) | np.uint64(part)).astype(np.int64),
                    (p & np.uint64((1 << _B_BITS) - 1)).astype(np.int64), (t >> np.uint64(1)).astype(np.int64),
                ]
                best = pa.array((t & np.uint64(1)).astype(bool))
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), best], names=["a_id", "b_id", "n_docs", "best"])


class Alignment:
    """A corpus aligned under two vocabularies; `docs` has doc_id and text, other columns are not read.

    Null, empty and not reproducible texts have no tokens: zeros and an empty digest. Long texts are aligned whole and
    make a chunk of their own. Repeated rows are documents of their own; rows with equal or null doc_id stay apart. Of
    pairs tied for the greatest count of an A id all are best. No rows give no rows. The work is done when an instance is
    made, in stored tables; both results read those.
    """

    def __init__(self, docs: DataFrame, given: Definitions):
        shipped = docs.sparkSession.sparkContext.broadcast(tuple(given))
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        self._runs = stored(texts.mapInArrow(_chunks(shipped), _RUNS), "align-runs")
        leaves = self._runs.filter("part >= 0").select("part", "node", "pairs", "counts")
        nodes, levels = self._runs.filter("part < 0").count(), [leaves]
        while not (len(levels) > 1 and nodes <= 1):
            nodes = max(1, -(-nodes // FAN_IN))
            # the runs of a part are dealt to the nodes above by a hash, about FAN_IN to each
            levels[-1] = levels[-1].withColumn("up", F.pmod(F.xxhash64("node"), F.lit(nodes)))
            up = levels[-1].groupBy("part", "up").applyInArrow(_merge_group, _MERGED)
            levels.append(stored(up, "align-level"))
        totals = levels[-1].groupBy("part").applyInArrow(_with_best, _TOTALS)
        self._root = totals = stored(totals, "align-totals")
        for level in reversed(levels[:-1]):
            below = level.select("part", "node", "up", "pairs").groupBy("part", "up")
            above = totals.groupBy("part", "node")
            totals = stored(below.cogroup(above).applyInArrow(_stream_back, _TOTALS), "align-totals")
        self._totals = totals

    def pairs(self) -> DataFrame:
        """(a_id, b_id, n_docs, best): how many documents hold the pair linked, and whether that is its A id's most."""
        return self._root.mapInArrow(_unpacked_pairs, "a_id long, b_id long, n_docs long, best boolean")

    def documents(self) -> DataFrame:
        """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per document."""
        runs = self._runs.select("node", "part", "counts", "docs", "times", "facts").groupBy("node")
        totals = self._totals.select("node", "part", "totals").groupBy("node")
        return runs.cogroup(totals).applyInArrow(_contributions, _RESULT)
