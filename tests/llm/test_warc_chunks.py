from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

import pytest

from cartwise.llm import warc_chunks as W

SCHEMA = "page_id long, url string, html string, digest string, chosen int, key string"
PAGES = [
    (1, "u", ""),
    (2, "u v\n", None),
    (3, None, "x"),
    (3, "u", "x"),
    (4, "u", "é" * 200_000),
    (5, "u", "é" * 200_000),
    (None, "u", "x"),
    (None, "q", "zz"),
    (None, "q", "zz"),
    (7, "w", "alone"),
]


def brute(rows):
    groups, out, seen = {}, [], set()
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    for i, _, h in rows:
        h = h or ""
        top = max((x for x in groups[h] if x is not None), default=None)
        response = len(groups[h]) == 1 or (i == top and (i, h) not in seen)
        if response:
            seen.add((i, h))
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        out.append((i, len(h.encode()), digest, "response" if response else "revisit", None if response else top))
    return sorted(out, key=str)


def test_round_trip(spark):
    pages = spark.createDataFrame([(*p, None, None, None) for p in PAGES], SCHEMA)
    folder, manifest = W.write_archives(pages)
    chunks = W.read_chunks(spark, folder, manifest)
    assert sorted(map(tuple, W.records(chunks).collect()), key=str) == brute(PAGES)
    rows = chunks.where("page_id = 5").orderBy("chunk_no").collect()
    assert len(rows) == -(-400_000 // W.CHUNK)
    assert b"".join(r["data"] for r in rows) == ("é" * 200_000).encode()
    running = hashlib.sha1()
    for r in rows:
        running.update(r["data"])
        assert r["digest"] == W.base32_sha1(running)


def test_files_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "body", None, None, None)], SCHEMA)
    folder, manifest = W.write_archives(pages, folder=str(tmp_path / "warc"))
    raw = gzip.decompress((tmp_path / "warc" / manifest.first()["file"]).read_bytes())
    head, body = raw.split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"Content-Length: 4" in head
    assert body == b"body\r\n\r\n"


def test_small_payloads_are_no_copies_under_a_bound(spark):
    pages = spark.createDataFrame([(i, "u", "ab", None, None, None) for i in (1, 2)], SCHEMA)
    folder, manifest = W.write_archives(pages, least=3)
    kinds = {r["record_type"] for r in W.records(W.read_chunks(spark, folder, manifest)).collect()}
    assert kinds == {"response"}


def test_empty_table(spark):
    folder, manifest = W.write_archives(spark.createDataFrame([], SCHEMA))
    assert W.records(W.read_chunks(spark, folder, manifest)).collect() == []


def test_each_record_is_a_member_of_its_own(spark, tmp_path):
    pages = spark.createDataFrame([(*p, None, None, None) for p in PAGES], SCHEMA)
    folder, manifest = W.write_archives(pages, folder=str(tmp_path / "warc"))
    found = 0
    for row in manifest.collect():
        raw = (tmp_path / "warc" / row["file"]).read_bytes()
        assert len(raw) == row["n_bytes"]
        members = 0
        while raw:
            member = zlib.decompressobj(wbits=31)
            text = member.decompress(raw)
            assert member.eof and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            raw, members = member.unused_data, members + 1
        assert members == row["n_records"]
        found += members
    assert found == len(PAGES)


def test_payloads_are_chunk_rows_before_they_are_written(spark):
    rows = W.chunked(spark.createDataFrame([(*p, None, None, None) for p in PAGES], SCHEMA))
    assert rows.agg({"chunk_no": "max"}).first()[0] == -(-400_000 // W.CHUNK) - 1
    assert all(len(r["data"]) <= W.CHUNK for r in rows.select("data").collect())
    assert rows.where("chunk_no = 0").count() == len(PAGES)


def test_a_payload_of_many_chunks_in_small_batches(spark):
    """Batches of a few chunks: records go on over the borders of batches."""
    big = "0123456789abcdef" * (1 << 16)
    pages = spark.createDataFrame([(i, "u", big if i < 3 else f"{i}{big}", None, None, None) for i in range(5)], SCHEMA)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        folder, manifest = W.write_archives(pages)
        rows = sorted(map(tuple, W.records(W.read_chunks(spark, folder, manifest)).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert rows == brute([(i, "u", big if i < 3 else f"{i}{big}") for i in range(5)])


def test_a_writer_refuses_chunks_that_do_not_belong(tmp_path):
    digest = hashlib.sha1(b"ab").hexdigest()
    writer = W.ArchiveWriter(str(tmp_path))
    writer.begin(1, 1, "u", digest, 2, True, None)
    with pytest.raises(ValueError):
        writer.add(2, b"ab")
    writer.add(1, b"a")
    with pytest.raises(ValueError):
        writer.begin(2, 2, "u", digest, 2, True, None)
