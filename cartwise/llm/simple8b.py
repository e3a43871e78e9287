"""Token-id files in Simple-8b: word-aligned packing of ids into 64-bit words.

A word is a selector in its low four bits and sixty bits of data: as many ids of equal width as the selector
says. An id of sixty bits or more follows a word with the escape selector as a raw word. Ids are packed in
blocks of BLOCK ids; a block starts with a new word, so that many blocks are packed and unpacked side by
side in numpy, and a reader can start at any block.

A shard file holds the magic bytes, the words of all blocks, the document index (id, validity, ids per
document), the block index (words per block) and a fixed trailer with the counts. Documents are dealt by
sampled ranges of doc_id and sorted, so the files in order hold the corpus in ascending doc_id order. Tasks
write under names of their own and the manifest, a Parquet table, names the files that count; a file of a
lost or repeated attempt is in no manifest.

Defined cases: a null or empty text has no ids but its end id; null ids come first; repeated rows are
stored one after the other; an empty table gives an empty manifest and no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.llm.shared import (
    map_batches,
    new_folder,
    open_store,
    partitions,
    slices,
    steady_objects,
    text_array,
    text_bytes,
    write_table,
)

BLOCK = 1024
GROUP = 256  # blocks that are packed or unpacked at a time
MAGIC = b"CWS8B001"
TRAILER = struct.Struct("<QQQ8s")  # documents, blocks, ids
ESCAPE = 0
#: Ids per word and bits per id of selectors 1 to 14.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = tuple(60 // n for n in COUNTS)


@functools.cache
def _limits() -> tuple[np.ndarray, np.ndarray]:
    """The first id too wide for each selector, and for ids of 16 bits the densest selector that is wide enough."""
    limits = np.array([1 << w for w in WIDTHS], np.uint64)
    return limits, (np.searchsorted(limits, np.arange(1 << 16, dtype=np.uint64), side="right") + 1).astype(np.uint8)


def _needed(ids: np.ndarray) -> np.ndarray:
    limits, short = _limits()
    if ids.size and int(ids.max()) < len(short):
        return short[ids]
    return (np.searchsorted(limits, ids, side="right") + 1).astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of consecutive blocks of the ids and the number of words of each block."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    if not len(ids):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    blocks = -(-len(ids) // BLOCK)
    pad = COUNTS[0]  # zeros that fit any width end each block
    grid = np.zeros((blocks, BLOCK + pad), np.uint64)
    full = np.zeros(blocks * BLOCK, np.uint64)
    full[: len(ids)] = ids
    grid[:, :BLOCK] = full.reshape(blocks, BLOCK)
    ends = np.full(blocks, BLOCK, np.int64)
    ends[-1] = len(ids) - (blocks - 1) * BLOCK

    # The densest selector that holds at each place: the widest of its word's ids, the zeros behind a block
    # among them, must fit. Where no word of a selector fits (but in those zeros), no denser one does.
    need = np.ones((blocks, BLOCK + pad), np.uint8)  # densest selector that is wide enough for each id
    need[:, :BLOCK] = _needed(grid[:, :BLOCK])
    selector = np.zeros((blocks, BLOCK), np.uint8)
    widest, held = need[:, :BLOCK].copy(), 1
    for k in range(len(COUNTS), 0, -1):
        for j in range(held, COUNTS[k - 1]):
            np.maximum(widest, need[:, j : j + BLOCK], out=widest)
        held = COUNTS[k - 1]
        fit = widest <= k
        if not fit[:, : BLOCK - pad].any() and k < len(COUNTS):
            break
        selector[fit] = k

    step = np.array([1, *COUNTS], np.int64)
    at, rows = np.zeros(blocks, np.int64), np.arange(blocks)
    starts, chosen, owner = [], [], []
    while len(rows):
        s = selector[rows, at[rows]]
        starts.append(at[rows])
        chosen.append(s)
        owner.append(rows)
        at[rows] += step[s]
        rows = rows[at[rows] < ends[rows]]
    start, sel, own = np.concatenate(starts), np.concatenate(chosen), np.concatenate(owner)
    order = np.argsort(own, kind="stable")  # within a block the order is that of the words
    start, sel, own = start[order], sel[order], own[order]

    size = 1 + (sel == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = sel
    base, flat = own * grid.shape[1] + start, grid.ravel()
    for k in np.unique(sel):
        mine = np.flatnonzero(sel == k)
        if k == ESCAPE:
            words[place[mine] + 1] = flat[base[mine]]
            continue
        word, first = np.full(len(mine), k, np.uint64), base[mine]
        for j in range(COUNTS[k - 1]):
            word |= flat[first + j] << np.uint64(4 + j * WIDTHS[k - 1])
        words[place[mine]] = word
    return words, np.bincount(own, weights=size, minlength=blocks).astype(np.int64)


def unpack(words: np.ndarray, words_of: np.ndarray, total: int) -> np.ndarray:
    """The ids of consecutive blocks; all blocks but the last are full. `total` is their number of ids."""
    if not total:
        return np.empty(0, np.uint64)
    sel = (words & np.uint64(15)).astype(np.int64)
    if (sel == ESCAPE).any():
        # A raw word follows an escape and may look like anything, so it is found word by word.
        raw = np.zeros(len(words), bool)
        for i in np.flatnonzero(sel == ESCAPE):
            if not raw[i]:
                raw[i + 1] = True
    else:
        raw = None
    step = np.array([1, *COUNTS, 0], np.int64)
    held = step[sel]
    if raw is not None:
        held[raw] = 0
        sel = np.where(raw, 15, sel)
    first = np.cumsum(words_of) - words_of
    before = np.cumsum(held) - held
    block = np.repeat(np.arange(len(words_of)), words_of)
    inside = before - before[first][block]  # place of the word's first id in its block
    out = np.zeros(len(words_of) * BLOCK + COUNTS[0], np.uint64)
    size = np.full(len(words_of), BLOCK, np.int64)
    size[-1] = total - (len(words_of) - 1) * BLOCK
    for k in np.unique(sel):
        mine = np.flatnonzero(sel == k)
        if k == 15:
            continue
        target = block[mine] * BLOCK + inside[mine]
        if k == ESCAPE:
            out[target] = words[mine + 1]
            continue
        n, width = COUNTS[k - 1], WIDTHS[k - 1]
        mask = np.uint64((1 << width) - 1)
        left = size[block[mine]] - inside[mine]
        for j in range(n):
            some = left > j
            if some.all():
                out[target + j] = (words[mine] >> np.uint64(4 + j * width)) & mask
            else:
                out[target[some] + j] = (words[mine[some]] >> np.uint64(4 + j * width)) & mask
    return out[:total]


KEPT_PIECES = 500_000
PART_BYTES = 10 << 20  # text that is encoded at a time

# Classes of characters, of code points up to CLASSED.
SPACE, LETTER, DIGIT, OTHER, UNSURE = range(5)
CLASSED = 0x2100


@functools.cache
def _classes() -> np.ndarray:
    """What the vocabulary's pre-tokeniser takes each code point for. White space beyond ASCII and unassigned
    code points are left to the library, which may know another version of Unicode."""
    out = np.full(CLASSED, OTHER, np.uint8)
    for i in range(CLASSED):
        kind = unicodedata.category(chr(i))
        if kind[0] == "L":
            out[i] = LETTER
        elif kind[0] == "N":
            out[i] = DIGIT
        elif kind[0] == "Z" or kind in ("Cn", "Cc"):
            out[i] = UNSURE
    out[[9, 10, 11, 12, 13, 32]] = SPACE
    return out


def pieces(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of the texts start that the pre-tokeniser makes, and which texts are left to the library.
    `data` holds the texts one after the other, `starts` where each starts and the end of the last.

    A piece is a contraction, or a run of letters, digits or other characters with the space before it, or white
    space: the last character of a run of white space before other text is on its own, or the space of what
    follows. The rules are the pattern's `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`.
    """
    at = np.flatnonzero((data & 0xC0) != 0x80)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    lead, second, third = padded[at], padded[at + 1] & 0x3F, padded[at + 2] & 0x3F
    point = lead.astype(np.uint16)
    two, three = (lead >= 0xC0) & (lead < 0xE0), (lead >= 0xE0) & (lead < 0xF0)
    point[two] = (lead[two] & 0x1F).astype(np.uint16) << 6 | second[two]
    point[three] = (lead[three] & 0x0F).astype(np.uint16) << 12 | second[three].astype(np.uint16) << 6 | third[three]
    known = (lead < 0xF0) & (point < CLASSED)
    kind = np.where(known, _classes()[np.where(known, point, 0)], UNSURE)

    first = np.zeros(len(at) + 1, bool)  # of a text; also the end
    first[np.searchsorted(at, starts)] = True
    space = np.concatenate([kind == SPACE, [False]])
    before = np.concatenate([[False], space[:-2]])  # whether white space comes before
    plain = np.concatenate([[False], lead[:-1] == 32])
    changed = np.concatenate([[True], kind[1:] != kind[:-1]])
    last = space[:-1] & ~space[1:] & ~first[1:]  # white space right before other text
    begins = np.where(space[:-1], ~before | last, np.where(before, ~plain, changed)) | first[:-1]

    # Contractions, where an apostrophe begins a piece.
    mark = np.flatnonzero((lead == 39) & begins)
    if len(mark):
        text = np.concatenate([np.where(first[:-1], 0, lead), [0, 0]])  # a text's first character follows nothing
        one, other = text[mark + 1], text[mark + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = (one == 114) & (other == 101) | (one == 118) & (other == 101) | (one == 108) & (other == 108)
        begins[mark[short | long] + 1] = False
        after = np.concatenate([mark[short] + 2, mark[long] + 3])
        after = after[after < len(begins)]
        begins[after[(kind[after] == LETTER)]] = True

    unsure = np.searchsorted(starts, at[kind == UNSURE], side="right") - 1
    left = np.zeros(len(starts) - 1, bool)
    left[unsure] = True
    return at[begins], left


class PieceEncoder:
    """Encodes with the tokenizers library, each distinct piece once while it is kept. A text with a special
    token's string or with characters that `pieces` does not know goes to the library as a whole."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # place of a piece
        self.ids = array("I")  # of all pieces, one after the other
        self.ends = array("Q", [0])

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _places(self, distinct: list[str]) -> np.ndarray:
        if len(self.known) > KEPT_PIECES:
            self.forget()
        known = self.known
        missing = [p for p in distinct if p not in known]
        for start in range(0, len(missing), 1 << 16):
            some = missing[start : start + (1 << 16)]
            for ids in self._library(some):
                self.ids.extend(ids)
                self.ends.append(len(self.ids))
            known.update(zip(some, range(len(known), len(known) + len(some)), strict=True))
        return np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))

    def run(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has; nulls are empty."""
        column = column.fill_null("")
        data, starts = text_bytes(column)
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(column), np.int64)
        begin, left = pieces(data, starts)
        for mark in self.special:
            left |= pc.match_substring(column, mark).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(column)), np.diff(np.searchsorted(begin, starts)))
        coded = text_array(data, np.append(begin[1:], len(data))).dictionary_encode()
        used = np.unique(coded.indices.to_numpy()[~left[owner]]) if left.any() else np.arange(len(coded.dictionary))
        place = np.zeros(len(coded.dictionary), np.int64)
        place[used] = self._places(coded.dictionary.take(pa.array(used)).to_pylist())
        place = place[coded.indices.to_numpy()]
        ends, pool = np.array(self.ends, np.int64), np.frombuffer(self.ids, np.uint32)
        size = np.where(left[owner], 0, ends[place + 1] - ends[place])
        shift = np.repeat(ends[place] - (np.cumsum(size) - size), size)
        ids = pool[np.arange(len(shift)) + shift]
        del pool  # an array with views cannot grow
        counts = np.bincount(owner, weights=size, minlength=len(column)).astype(np.int64)
        if not left.any():
            return ids, counts
        # The library's texts between the others.
        cut = np.split(ids, np.cumsum(counts)[:-1])
        for i, found in zip(np.flatnonzero(left), self._library(column.filter(pa.array(left)).to_pylist()), strict=True):
            cut[i], counts[i] = np.array(found, np.uint32), len(found)
        return np.concatenate(cut), counts


@functools.lru_cache(maxsize=2)
def _encoder(spec: str) -> PieceEncoder:
    return PieceEncoder(spec)


class ShardWriter:
    """Writes one shard file; holds GROUP blocks of ids and the document index at most."""

    def __init__(self, folder: str):
        self.store, path = open_store(folder)
        self.store.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.s8b"
        self.out = self.store.open_output_stream(f"{path}/{self.name}")
        self.out.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0
        self.words_of: list[np.ndarray] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= GROUP * BLOCK:
            self._flush(self.held // (GROUP * BLOCK) * GROUP * BLOCK)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        for start in range(0, count, GROUP * BLOCK):
            words, words_of = pack(ids[start : min(start + GROUP * BLOCK, count)])
            self.out.write(words.astype("<u8").tobytes())
            self.words_of.append(words_of)
        self.waiting, self.held = [ids[count:]], len(ids) - count

    def close(self) -> tuple[str, int, int]:
        self._flush(self.held)
        words_of = np.concatenate(self.words_of) if self.words_of else np.empty(0, np.int64)
        for column, kind in zip(zip(*self.docs, strict=True), ("<i8", "u1", "<u8"), strict=True):
            self.out.write(np.array(column, kind).tobytes())
        self.out.write(words_of.astype("<u4").tobytes())
        self.out.write(TRAILER.pack(len(self.docs), len(words_of), self.ids, MAGIC))
        self.out.close()
        return self.name, len(self.docs), self.ids


def read_shard(folder: str, name: str) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
    """(doc_id, its ids in parts) of a shard file in order; each document's parts are to be used up first."""
    store, path = open_store(f"{folder}/{name}")
    with store.open_input_file(path) as f:
        size = f.size()
        docs, blocks, total, magic = TRAILER.unpack(f.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC or f.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{name} is no token-id shard")
        index = size - TRAILER.size - docs * 17 - blocks * 4
        doc_ids = np.frombuffer(f.read_at(docs * 8, index), "<i8")
        valid = np.frombuffer(f.read_at(docs, index + docs * 8), "u1")
        lengths = np.frombuffer(f.read_at(docs * 8, index + docs * 9), "<u8").astype(np.int64)
        words_of = np.frombuffer(f.read_at(blocks * 4, index + docs * 17), "<u4").astype(np.int64)

        def groups() -> Iterator[np.ndarray]:
            at = len(MAGIC)
            for start in range(0, blocks, GROUP):
                mine = words_of[start : start + GROUP]
                raw = f.read_at(int(mine.sum()) * 8, at)
                at += len(raw)
                yield unpack(np.frombuffer(raw, "<u8"), mine, min(total - start * BLOCK, len(mine) * BLOCK))

        source, part = groups(), np.empty(0, np.uint64)

        def ids_of(length: int) -> Iterator[np.ndarray]:
            nonlocal part
            while length:
                if not len(part):
                    part = next(source)
                taken, part = part[:length], part[length:]
                length -= len(taken)
                yield taken

        for doc_id, known, length in zip(doc_ids.tolist(), valid.tolist(), lengths.tolist(), strict=True):
            yield (doc_id if known else None), ids_of(length)


MANIFEST = "part int, file string, n_docs long, n_ids long"


def write_ids(docs: DataFrame, tokenizer_file: str, end_id: int, folder: str | None = None) -> tuple[str, DataFrame]:
    """Writes the shards and returns their folder and the manifest with each file's first id position."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token_ids")
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, part = _encoder(spec.value), None, 0
        with steady_objects():
            for batch in batches:
                for piece in slices(batch, limit=PART_BYTES):
                    if writer is None:
                        writer, part = ShardWriter(folder), piece.column("part")[0].as_py()
                    ids, counts = encoder.run(piece.column("text"))
                    stops = np.cumsum(counts)
                    ids = np.insert(ids, stops, end_id)
                    stops += np.arange(1, len(stops) + 1)
                    for doc_id, start, stop in zip(
                        piece.column("doc_id").to_pylist(), (stops - counts - 1).tolist(), stops.tolist(), strict=True
                    ):
                        writer.add(doc_id, ids[start:stop])
        if writer is not None:
            name, n_docs, n_ids = writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name]), pa.array([n_docs]), pa.array([n_ids])],
                ["part", "file", "n_docs", "n_ids"],
            )

    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
        .withColumn("part", F.spark_partition_id())
    )
    manifest = write_table(map_batches(dealt, work, MANIFEST), "token_manifest")
    # One row per file: the running sum needs no more than the list of files in one task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return folder, manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at, rows = row["start"], []
                for doc_id, parts in read_shard(folder, row["file"]):
                    n = crc = 0
                    for ids in parts:
                        n, crc = n + len(ids), zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    rows.append((doc_id, at, n, crc))
                    at += n
                    if len(rows) == 4096:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    files = manifest.repartition(partitions(spark), "part")
    return map_batches(files, work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)
