from __future__ import annotations

import base64
import hashlib
import io
import random

import pytest

from faremeter.llm import files, warc


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    long = "".join(rng.choices("abc <>é\r\n", k=150_000))
    out = [(i, f"http://h/{i}?q=ä b\r\nX: y", f"<p>{i % 7}</p>") for i in range(60)]
    out += [(100, "u", long), (101, "u", long), (102, None, long + "!"), (103, "", None), (104, "v", ""), (None, "w", "<p>0</p>")]
    out += [(105, "twice", "twice"), (105, "twice", "twice"), (None, None, None), (106, "x", "0\r\n\r\nWARC/1.1\r\n\r\n")]
    return out


@pytest.mark.parametrize(("segment", "file_bytes"), [(32 << 10, 64 << 20), (1000, 2000)])
def test_round_trip(spark, rows, segment, file_bytes):
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, row int, best string")
    folder = warc.write_archives(pages, segment_bytes=segment, file_bytes=file_bytes)
    got = warc.read_archives(spark, folder).collect()
    assert len(got) == len(rows) and not any(r.problem for r in got)
    best = {}
    for page, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if page is None else page)
    want = []
    for page, _, html in rows:
        top = best[html or ""]
        kind = "response" if page == top else "revisit"
        want.append((page, len((html or "").encode()), digest(html), kind, None if kind == "response" else top))
    # of the rows that repeat page 105 one is the response
    want.remove((105, 5, digest("twice"), "response", None))
    want.append((105, 5, digest("twice"), "revisit", 105))
    have = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    by_page = {p: h for p, _, h in rows}
    for r in got:
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (by_page[r.page_id] or "")
        else:
            assert r.payload is None


def test_small_payloads_are_not_revisits(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "yy"), (4, "a", "yy")], "page_id long, url string, html string")
    folder = warc.write_archives(pages, least_revisit=2)
    got = {r.page_id: r.record_type for r in warc.read_archives(spark, folder).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_broken_archives_say_why(spark):
    page = {"page_id": 1, "row": 0, "url": "u", "payload": b"z" * 5000, "best": {"page_id": 1, "row": 0}}
    records = list(warc.records_of(page, 1000))
    assert len(records) > 4
    plain = warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:2:0>"), ("WARC-Payload-Digest", "sha1:AAAA")], b"HTTP/1.1 200 OK\r\n\r\nhello")
    bad_chunks = warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:3:0>")], b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nff\r\nshort")

    def read(parts):
        folder = files.new_folder(spark, "broken")
        names = []
        for i, part in enumerate(parts):
            with files.create(f"{folder}/{i}.warc") as f:
                f.write(part)
            names.append((f"{i}.warc", 1, len(part)))
        spark.createDataFrame(names, warc._MANIFEST).write.parquet(f"{folder}/manifest")
        return {r.page_id: r for r in warc.read_archives(spark, folder).collect()}

    whole = read(reversed(records))  # a segment to a file, in any order
    assert whole[1].problem is None and bytes(whole[1].payload) == b"z" * 5000
    assert "segments" in read(records[:2] + records[3:])[1].problem
    assert "without its last" in read(records[:-1])[1].problem
    assert "stated" in read([records[0], *[r.replace(b"Total-Length: 5", b"Total-Length: 6") for r in records[1:]]])[1].problem
    others = read([plain + bad_chunks])
    assert "digest" in others[2].problem and "chunk" in others[3].problem


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(pages)).count() == 0


def test_chunked_framing():
    for n in (0, 1, 10, 8192, 20_000):
        payload = bytes(range(256)) * (n // 256) + b"q" * (n % 256)
        assert warc.unchunked(warc.chunked(payload)) == payload
    assert warc.unchunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    assert [h["warc-type"] for h, _ in warc.records_in(io.BytesIO(warc._record([("WARC-Type", "a")], b"")))] == ["a"]


def test_broken_records_are_rows_with_a_problem(spark, tmp_path):
    """A record without an id, one with a broken segment number, one without a length: the other records and files stay."""
    def record(*headers, block=b"HTTP/1.1 200 OK\r\n\r\nbody"):
        lines = ["WARC/1.1", "WARC-Type: response", *headers]
        return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    length = "Content-Length: 23"
    first = record("WARC-Record-ID: <urn:page:1:a>", length)
    bad = [record(length), record("WARC-Record-ID: <urn:page:2:a>", "WARC-Segment-Number: x", length), record("WARC-Record-ID: <urn:page:3:a>")]
    (tmp_path / "a.warc").write_bytes(first + b"".join(bad) + first)
    (tmp_path / "b.warc").write_bytes(first[:-20])
    (tmp_path / "c.warc").write_bytes(record("WARC-Record-ID: <urn:page:4:a>", length))
    rows = [(f, 1, 1) for f in ("a.warc", "b.warc", "c.warc")]
    spark.createDataFrame(rows, warc._MANIFEST).write.parquet(str(tmp_path / "manifest"))
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in got if r.problem is None) == [1, 4]
    problems = sorted(r.problem for r in got if r.problem)
    assert len(problems) == 4
    for part in ("without WARC-Record-ID", "segment x", "Content-Length is missing", "ends early"):
        assert sum(part in p for p in problems) == 1, problems


def test_addresses_of_shared_folders():
    from faremeter.llm.files import known_address

    assert known_address("/a/b") == "file:///a/b" and known_address("file:/a/b") == "file:///a/b"
    assert known_address("file:///a/b") == "file:///a/b" and known_address("s3a://bucket/x") == "s3://bucket/x"
    assert known_address("dbfs:/mnt/x") == "file:///dbfs/mnt/x" and known_address("hdfs://name:9/x") == "hdfs://name:9/x"
    assert known_address("wasbs://c@a.net/x") == "abfss://c@a.net/x" and known_address("gs://b/x") == "gs://b/x"
