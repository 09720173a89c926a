"""WARC archives: writing with segmented and revisit records, reading with reassembly."""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeter.llm import files
from faremeter.llm.common import partitions, utf8

#: A record's block above this is cut into segments.
SEGMENT_BYTES = 32 << 10
#: Size of the chunks of the transfer framing.
CHUNK_BYTES = 8 << 10
#: A task goes on in another file beyond this.
FILE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "file string, records long, bytes long"
_BATCH_BYTES = 4 << 20


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, without a prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A payload in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join([b"%x\r\n%b\r\n" % (len(p), p) for p in parts]) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The payload of chunked transfer framing; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        size = re.match(rb"\s*([0-9A-Fa-f]+)", data[at:end]) if end >= 0 else None
        if not size:
            raise ValueError("broken chunk size")
        n, at = int(size[1], 16), end + 2
        if n == 0:
            return b"".join(out)
        if at + n > len(data):
            raise ValueError("a chunk ends early")
        out.append(data[at : at + n])
        at += n + 2


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{row}>"


def page_of(identifier: str) -> int | None:
    """The page that a record id names."""
    found = re.match(r"<urn:page:(-?\d+):", identifier)
    return int(found[1]) if found else None


def records_of(page: dict, segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of a page (page_id, row, url, payload, best: the response's page_id and row)."""
    own, payload = record_id(page["page_id"], page["row"]), page["payload"]
    common = [("WARC-Date", DATE), ("WARC-Record-ID", own)]
    if page["url"] is not None:
        common.append(("WARC-Target-URI", quote(page["url"], safe="%/:?#[]@!$&'()*+,;=~")))
    common += [("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"), ("Content-Type", "application/http;msgtype=response")]
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    best = record_id(page["best"]["page_id"], page["best"]["row"])
    if own != best:
        block = f"{head}Content-Length: {len(payload)}\r\n\r\n".encode()
        yield _record([("WARC-Type", "revisit"), *common, ("WARC-Profile", _PROFILE), ("WARC-Refers-To", best)], block)
        return
    block = f"{head}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record([("WARC-Type", "response"), *common], block)
        return
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", "1")], pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        headers = [
            ("WARC-Type", "continuation"), ("WARC-Date", DATE),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}{number}')}>"),
            ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(number)),
        ]
        if number == len(pieces):
            headers.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(headers, piece)


def _write(folder: str, segment_bytes: int, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, out, name, records, size = [], None, "", 0, 0
        for batch in batches:
            payloads = utf8(batch["payload"])
            for i, page in enumerate(batch.drop_columns(["payload"]).to_pylist()):
                for record in records_of(page | {"payload": payloads[i]}, segment_bytes):
                    if out is not None and size > file_bytes:
                        out.close()
                        done.append((name, records, size))
                        out = None
                    if out is None:
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = files.create(f"{folder}/{name}")
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = packer.compress(record) + packer.flush()
                    out.write(data)
                    records, size = records + 1, size + len(data)
        if out is not None:
            out.close()
            done.append((name, records, size))
        if done:
            columns = [pa.array(c) for c in zip(*done, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "records", "bytes"])

    return run


def write_archives(
    pages: DataFrame, folder: str | None = None, segment_bytes: int = SEGMENT_BYTES, least_revisit: int = 0,
    file_bytes: int = FILE_BYTES,
) -> str:
    """A record per row of pages (page_id, url, html), in gzip members; returns the folder.

    Of rows with equal payloads of at least least_revisit bytes the one with the largest page_id is the response; the
    others are revisits that refer to it. The rows of a payload meet in an aggregate and a join that Spark can split, not
    in one task. A response whose block exceeds segment_bytes goes on in continuation records. Each task writes files of
    its own; the table `manifest`, committed by Spark, lists those that count.
    Null html is empty; payloads of any length are written whole, in segments. Null page_id ranks below all others; of
    repeated rows one is the response. Null url: a record without a target. Other columns of pages are not read, whatever
    their names. No rows: an empty manifest.
    """
    spark = pages.sparkSession
    folder = folder or files.new_folder(spark, "archives")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    place = F.struct("page_id", "row")
    best = rows.groupBy("digest").agg(F.max(place).alias("same"))
    single = F.octet_length("payload") < least_revisit
    joined = rows.join(best, "digest").select(
        "page_id", "row", "url", "payload", F.when(single, place).otherwise(F.col("same")).alias("best")
    )
    joined.mapInArrow(_write(folder, segment_bytes, file_bytes), _MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


class _Unpacked:
    """The bytes of a file of gzip members, or of a plain one, piece by piece."""

    def __init__(self, source):
        self.source, self.data, self.at = source, b"", 0
        self.packed = source.read(2) == b"\x1f\x8b"
        source.seek(0)
        self.rest, self.unpacker = b"", zlib.decompressobj(31)

    def _more(self) -> bool:
        if not self.packed:
            new = self.source.read(1 << 20)
        else:
            new = b""
            while not new:
                raw = self.rest or self.source.read(1 << 20)
                if not raw:
                    return False
                if self.unpacker.eof:
                    self.unpacker = zlib.decompressobj(31)
                new = self.unpacker.decompress(raw)
                self.rest = self.unpacker.unused_data
        self.data, self.at = self.data[self.at :] + new, 0
        return bool(new)

    def until(self, end: bytes) -> bytes | None:
        """What comes before `end`, which is passed over; None at the end of the file."""
        while (i := self.data.find(end, self.at)) < 0:
            if not self._more():
                return None
        out, self.at = self.data[self.at : i], i + len(end)
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.data) - self.at < n:
            if not self._more():
                raise ValueError("a record ends early")
        out, self.at = self.data[self.at : self.at + n], self.at + n
        return out


def records_in(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of the records of an open archive."""
    data = _Unpacked(source)
    while (head := data.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins with {first[:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        if not headers.get("content-length", "").isdigit():
            raise ValueError(f"a record's Content-Length is {headers.get('content-length', 'missing')}")
        yield headers, data.exactly(int(headers["content-length"]))
        data.exactly(4)


def opened_block(block: bytes) -> tuple[dict[str, str], bytes]:
    """(HTTP headers, payload) of a response's block, without chunked framing."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return headers, unchunked(body) if headers.get("transfer-encoding", "").lower() == "chunked" else body


_PAGE = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("refers_to_id", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("problem", pa.string()), ("payload", pa.binary()),
        ("segment", pa.int64()), ("total", pa.int64()), ("stated", pa.string()),
    ]
)
_PAGE_DDL = (
    "record_id string, record_type string, uri string, refers_to_id string, payload_bytes long, payload_digest string, "
    "problem string, payload binary, segment long, total long, stated string"
)


def _page(row: dict, block: bytes, with_payload: bool) -> dict:
    """A whole record's row: its payload opened, measured and held against the digest that the archive states."""
    try:
        http, payload = opened_block(block)
        digest = payload_digest(payload)
        if row["record_type"] == "revisit":
            size, digest, payload = int(http["content-length"]), row["stated"], None
        else:
            size = len(payload)
            if row["stated"] not in (None, digest):
                row["problem"] = f"payload digest {digest}, stated {row['stated']}"
    except (ValueError, KeyError) as e:
        return row | {"problem": f"{e}"}
    return row | {"payload_bytes": size, "payload_digest": digest, "payload": payload if with_payload else None}


def _read(folder: str, with_payload: bool):
    def rows(name: str) -> Iterator[dict]:
        try:
            yield from whole_records(name)
        except (ValueError, zlib.error) as e:
            # where a record ends is not known, so what follows in this file is lost; other files are not
            yield dict.fromkeys(_PAGE.names) | {"problem": f"{name}: {e}"}

    def whole_records(name: str) -> Iterator[dict]:
        with files.open_input(f"{folder}/{name}") as source:
            for headers, block in records_in(source):
                kind = headers.get("warc-type")
                if kind not in ("response", "revisit", "continuation"):
                    continue
                number, total = headers.get("warc-segment-number"), headers.get("warc-segment-total-length")
                row = dict.fromkeys(_PAGE.names) | {
                    "record_id": headers.get("warc-segment-origin-id") or headers.get("warc-record-id"), "record_type": kind,
                    "uri": headers.get("warc-target-uri"), "refers_to_id": headers.get("warc-refers-to"),
                    "stated": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                }
                if row["record_id"] is None:
                    yield row | {"problem": "a record without WARC-Record-ID"}
                elif number is None:
                    yield _page(row, block, with_payload)
                elif not (number.isdigit() and (total or "0").isdigit()):
                    yield row | {"problem": f"segment {number} of total length {total}"}
                else:
                    yield row | {"segment": int(number), "total": int(total) if total else None, "payload": block}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["file"].to_pylist():
                held, size = [], 0
                for row in rows(name):
                    held.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, _PAGE)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, _PAGE)

    return run


def _reassemble(with_payload: bool):
    def run(table: pa.Table) -> pa.Table:
        segments = sorted(table.to_pylist(), key=lambda r: r["segment"])
        row = segments[0] | {"segment": None, "total": None, "payload": None}
        numbers = [s["segment"] for s in segments]
        total = next((s["total"] for s in segments if s["total"] is not None), None)
        block = b"".join(s["payload"] for s in segments)
        if numbers != list(range(1, len(numbers) + 1)) or total is None:
            row["problem"] = f"segments {numbers} of a record{'' if total else ' without its last one'}"
        elif len(block) != total:
            row["problem"] = f"{len(block)} bytes in its segments, {total} stated"
        else:
            row = _page(row, block, with_payload)
        return pa.Table.from_pylist([row], _PAGE)

    return run


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row per response and revisit of the archives that the folder's manifest lists.

    Segments are grouped by the record they originate from, wherever they lie, ordered by number, and must add up to the
    stated length; then chunked framing is decoded. Columns: record_id, page_id, record_type, uri, payload_bytes and
    payload_digest (a revisit's are those of the payload it refers to), refers_to (the response's page_id), payload (null
    for revisits), problem (why a record cannot be opened, null if it can). A record without an id or with broken segment
    numbers is a row with its problem; where a record has no length or a file breaks off, a row with the problem alone
    stands for the rest of that file.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    parsed = manifest.select("file").repartition(partitions(spark), "file").mapInArrow(_read(folder, with_payload), _PAGE_DDL)
    parsed = parsed.withColumn("segmented", F.col("segment").isNotNull())
    parts = parsed.filter("segmented").drop("segmented")
    joined = parts.groupBy("record_id").applyInArrow(_reassemble(with_payload), _PAGE_DDL)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+):", 1).try_cast("long")
    return parsed.filter("not segmented").drop("segmented").union(joined).select(
        "record_id", page("record_id").alias("page_id"), "record_type", "uri", "payload_bytes", "payload_digest",
        page("refers_to_id").alias("refers_to"), "payload", "problem",
    )


SQL = """
with hashed as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as digest from pages),
placed as (
  select *, max(page_id) over (partition by digest) as best from hashed)
select page_id, strlen(html)::bigint as payload_bytes,
  array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda j:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(((('0x' || digest[i * 5 + 1:i * 5 + 5])::int) >> (15 - 5 * j)) & 31) + 1]), '')), '')
    as payload_digest,
  case when page_id = best then 'response' else 'revisit' end as record_type,
  case when page_id <> best then best end as refers_to
from placed
"""
