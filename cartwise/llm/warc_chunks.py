"""WARC archives by a chunked record table.

Right after the scan a payload becomes (record, chunk_no) rows of at most CHUNK bytes, and all that follows moves
chunks: they are shuffled by record, sorted, and written as they come, with a running digest that is held against
the one of the header. So the input's own cell is the last place where a record is whole. Records are numbered by
the scan; the input must give the same rows in the same order when a task is repeated, as tables do. Records of
equal payloads are told by SHA-256; of a group the largest page_id, and of its rows the first, is the response and
the others are revisit records without a payload that name it.

Archives are WARC 1.1 files of one gzip member per record, written by tasks under names of their own; the manifest,
a Parquet table, lists the files that count, so lost or repeated attempts leave no trace in a result. Reading goes
through the same chunk rows: a response's digest and length come from the bytes read, and are held against its
header; a revisit's come from its header.

Defined cases: identifiers are integers; a null payload is empty; empty payloads are equal to each other; repeated
rows are records of their own, one of them the response; a null page_id is a record with an empty page header, which
is a response only in a group without other identifiers; an empty table gives no archive; other columns but url are
ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.shared import map_batches, new_folder, open_store, partitions, write_table

CHUNK = 1 << 16
CHUNKS = (
    "page_id long, chunk_no long, data binary, total long, so_far long, digest string, last boolean, "
    "record_type string, refers_to long"
)
_NAMES = ["page_id", "chunk_no", "data", "total", "so_far", "digest", "last", "record_type", "refers_to"]
_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64()]
VERSION = b"WARC/1.1\r\n"


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def chunked(pages: DataFrame) -> DataFrame:
    """record, page_id, url, key, sha1, total, chunk_no, data; an empty payload has one empty chunk."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    whole = pages.select(
        F.monotonically_increasing_id().alias("record"),
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        payload.alias("payload"),
    ).select(
        "*",
        F.sha2("payload", 256).alias("key"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("total"),
    )
    chunks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("total") - 1) / CHUNK).cast("int")))
    return whole.select("*", F.explode(chunks).alias("chunk_no")).select(
        "record",
        "page_id",
        "url",
        "key",
        "sha1",
        "total",
        "chunk_no",
        F.substring("payload", F.col("chunk_no") * CHUNK + 1, F.lit(CHUNK)).alias("data"),
    )


def copies(pages: DataFrame, least: int = 0) -> DataFrame:
    """of, response, chosen: the records of payloads of at least `least` bytes that occur more than once, whether
    each is the response, and the response's page_id. Narrow rows only: no payload is shuffled."""
    text = F.coalesce(F.col("html"), F.lit(""))
    narrow = pages.select(
        F.monotonically_increasing_id().alias("of"),
        F.col("page_id").cast("long").alias("page_id"),
        F.octet_length(text).alias("size"),
        F.sha2(text.cast("binary"), 256).alias("key"),
    ).where(F.col("size") >= least)
    groups = (
        narrow.groupBy("key")
        .agg(F.max(F.struct("page_id", (-F.col("of")).alias("first"))).alias("top"), F.count("*").alias("held"))
        .where("held > 1")
    )
    return narrow.join(groups, "key").select(
        "of", (F.col("of") == -F.col("top.first")).alias("response"), F.col("top.page_id").alias("chosen")
    )


def write_archives(pages: DataFrame, least: int = 0, folder: str | None = None) -> tuple[str, DataFrame]:
    """Writes the archives; returns their folder and the manifest (file, n_records, n_bytes)."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    chunks = chunked(pages).repartition(partitions(spark), "record").sortWithinPartitions("record", "chunk_no")
    # The merge join streams the sorted chunks, so their order stays. A revisit needs its first row alone.
    rows = (
        chunks.join(copies(pages, least).hint("merge"), F.col("record") == F.col("of"), "left")
        .withColumn("response", F.coalesce("response", F.lit(True)))
        .where("response OR chunk_no = 0")
        .withColumn("data", F.when(F.col("response"), F.col("data")))
        .select("record", "page_id", "url", "sha1", "total", "chunk_no", "response", "chosen", "data")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            writer = writer or ArchiveWriter(folder)
            data = batch.column("data")
            heads = zip(*(batch.column(c).to_pylist() for c in batch.schema.names[:-1]), strict=True)
            for row, (record, page_id, url, sha1, total, chunk_no, response, chosen) in enumerate(heads):
                if chunk_no == 0:
                    writer.begin(record, page_id, url, sha1, total, response, chosen)
                if response:
                    writer.add(record, memoryview(data[row].as_buffer()))
        if writer is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in writer.close()], ["file", "n_records", "n_bytes"])

    manifest = write_table(map_batches(rows, work, "file string, n_records long, n_bytes long"), "warc_manifest")
    return folder, manifest


class ArchiveWriter:
    """Writes records chunk by chunk, each as a gzip member; holds nothing of a record but its running digest."""

    def __init__(self, folder: str):
        self.store, path = open_store(folder)
        self.store.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.gz"
        # The file is gzip already: without this the store would see the name and compress once more.
        self.sink = self.store.open_output_stream(f"{path}/{self.name}", compression=None)
        self.records = self.bytes = self.left = 0
        self.member: gzip.GzipFile | None = None

    def begin(self, record: int, page_id, url, sha1: str, size: int, response: bool, refers_to) -> None:
        self._end()
        name = "" if page_id is None else str(page_id)
        head = [
            ("WARC-Type", "response" if response else "revisit"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'record:{record}:page:{name}')}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Target-URI", "".join((url or "").split())),
            ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}"),
            ("Page-ID", name),
            ("Payload-Length", str(size)),
        ]
        if not response:
            head += [
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("Refers-To-Page-ID", "" if refers_to is None else str(refers_to)),
            ]
        self.left = size if response else 0
        head.append(("Content-Length", str(self.left)))
        self.member = gzip.GzipFile(fileobj=self, mode="wb", compresslevel=1, mtime=0)
        self.member.write(VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n")
        self.record, self.sha1 = record, sha1 if response else hashlib.sha1().hexdigest()
        self.digest = hashlib.sha1()
        self.records += 1

    def add(self, record: int, chunk) -> None:
        if record != self.record:
            raise ValueError(f"a chunk of record {record} inside record {self.record}")
        self.left -= len(chunk)
        self.digest.update(chunk)
        self.member.write(chunk)

    def _end(self) -> None:
        if self.member is None:
            return
        if self.left or self.digest.hexdigest() != self.sha1:
            raise ValueError(f"record {self.record} is not what its header says")
        self.member.write(b"\r\n\r\n")
        self.member.close()
        self.member = None

    def write(self, data) -> int:
        self.bytes += len(data)
        return self.sink.write(data)

    def flush(self) -> None:
        pass

    def close(self) -> tuple[str, int, int]:
        self._end()
        self.sink.close()
        return self.name, self.records, self.bytes


def read_file(folder: str, name: str) -> Iterator[tuple]:
    """Chunk rows of one archive, in order; holds one chunk at a time."""
    store, path = open_store(f"{folder}/{name}")
    with store.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as f:
        while True:
            line = f.readline()
            if not line:
                return
            if line != VERSION:
                raise ValueError(f"{name}: no record where one should start")
            head = {}
            while (line := f.readline()) not in (b"\r\n", b""):
                key, _, value = line.decode().rstrip("\r\n").partition(": ")
                head[key.rstrip(":")] = value
            number = lambda key: int(head[key]) if head.get(key) else None
            page_id, left, digest, at, chunk = number("Page-ID"), number("Content-Length"), hashlib.sha1(), 0, 0
            total, kind = number("Payload-Length"), head["WARC-Type"]
            claimed = head["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "revisit" or not left:
                if kind != "revisit" and base32_sha1(digest) != claimed:
                    raise ValueError(f"{name}: page {page_id} has another digest")
                yield page_id, 0, b"", total, total, claimed, True, kind, number("Refers-To-Page-ID")
            while left:
                data = f.read(min(CHUNK, left))
                if not data:
                    raise ValueError(f"{name}: page {page_id} is cut off")
                digest.update(data)
                at, left = at + len(data), left - len(data)
                if not left and (at != total or base32_sha1(digest) != claimed):
                    raise ValueError(f"{name}: page {page_id} has another digest or length")
                yield page_id, chunk, data, total, at, base32_sha1(digest), not left, kind, None
                chunk += 1
            f.read(4)


def read_chunks(spark: SparkSession, folder: str, manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunk rows of all archives of the manifest. Without data the rows carry lengths and digests only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows: list[tuple] = []
                for row in read_file(folder, name):
                    rows.append(row if with_data else (*row[:2], None, *row[3:]))
                    if len(rows) == 64:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return map_batches(manifest.repartition(partitions(spark), "file"), work, CHUNKS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES
    )


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: its last chunk has the length and digest of the whole payload."""
    return chunks.where("last").select(
        "page_id",
        F.col("so_far").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
