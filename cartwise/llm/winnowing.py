"""Benchmark decontamination by winnowing.

Documents and items are sequences of words. Of every K consecutive words a hash is taken, and of every
WINDOW consecutive hashes the minimum is kept: two texts that share at least K + WINDOW - 1 words in a row
keep the same hash inside that span, so a shared span of SPAN = 10 words is always found. Kept hashes of
documents and items are joined, and each hit is extended word by word to both sides within the reach of a
window, on the word hashes that travel with it. Words of extended hits of SPAN words or more are hit words.

An item shorter than a window is one window; for each such length all document spans of that length are
compared, which is winnowing with one hash per window.

Before the join, documents drop hashes that cannot hit by a bitmap of fixed size (2 MB) over the items'
hashes; it only saves rows, the join decides. Words are compared by 64-bit hashes.

Defined cases: null and empty texts have no words and no hits; an item without words hits nothing; rows are
told by numbers of their own, so rows that share an identifier, have none or have one of any type get their own
hits; repeated items count once per identifier; an item without identifier marks words but is not reported;
empty tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.shared import map_batches, slices, type_of, write_table

SPAN = 10
K = 5
WINDOW = SPAN - K + 1
REACH = SPAN - K  # words on each side of a hit that travel with it
BITS = 24
KEPT_WORDS = 200_000

#: Digits, letters and all bytes above ASCII are parts of words; A-Z in lower case.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class WordHasher:
    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def close(self) -> None:
        """Drops the words met so far; a Python worker lives on for other tasks."""
        self.known = {}

    def run(self, text: str | None) -> np.ndarray:
        found = (text or "").encode().translate(_WORD_BYTES).split()
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        known = self.known
        for w in set(found).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w) or 1
        return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words; k is part of it."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    total = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        total = (total ^ words[j : len(words) - k + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the minima of all windows; all places where a window has its minimum."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.int64)
    if window == 1:
        return np.arange(n)
    if n <= window:
        return np.flatnonzero(hashes == hashes.min())
    least = hashes[: n - window + 1].copy()
    for j in range(1, window):
        np.minimum(least, hashes[j : n - window + 1 + j], out=least)
    kept = np.zeros(n, bool)
    for j in range(window):
        kept[j : n - window + 1 + j] |= hashes[j : n - window + 1 + j] == least
    return np.flatnonzero(kept)


def contexts(words: np.ndarray, places: np.ndarray, k: int, reach: int) -> np.ndarray:
    """The words around each place, `reach` on both sides, zero beyond the ends."""
    padded = np.concatenate([np.zeros(reach, np.uint64), words, np.zeros(reach + k, np.uint64)])
    return padded[places[:, None] + np.arange(k + 2 * reach)]


def _fingerprints(words: np.ndarray, short: list[int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(k, reach, hashes, places) of the long windows and of each length of short items."""
    hashes = gram_hashes(words, K)
    yield K, REACH, hashes, winnow(hashes, WINDOW)
    for k in short:
        hashes = gram_hashes(words, k)
        yield k, 0, hashes, np.arange(len(hashes))


def item_prints(items: DataFrame) -> DataFrame:
    """(item_id, k, hash, context) of the items, each context once per item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for part in slices(batch):
                ids, ks, found, around = [], [], [], []
                for item_id, text in zip(
                    part.column("item_id").to_pylist(), part.column("text").to_pylist(), strict=True
                ):
                    words = hasher.run(text)
                    if 0 < len(words) < SPAN:
                        prints = [(len(words), 0, gram_hashes(words, len(words)), np.zeros(1, np.int64))]
                    else:
                        prints = list(_fingerprints(words, []))
                    for k, reach, hashes, places in prints:
                        ids += [item_id] * len(places)
                        ks += [k] * len(places)
                        found.append(hashes[places])
                        around += [c.tobytes() for c in contexts(words, places, k, reach)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.string()),
                        pa.array(ks, pa.int32()),
                        pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64()),
                        pa.array(around, pa.binary()),
                    ],
                    ["item_id", "k", "hash", "of_item"],
                )

    source = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return map_batches(source, work, "item_id string, k int, hash long, of_item binary").distinct()


def document_prints(docs: DataFrame, bitmap: np.ndarray, short: list[int]) -> DataFrame:
    """row, doc_id, n_words and the hits that the bitmap lets pass. `row` numbers the rows of one evaluation."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    def hits_of(hasher: WordHasher, bits: np.ndarray, text: str | None) -> tuple[int, list[dict]]:
        words, mine = hasher.run(text), []
        for k, reach, hashes, places in _fingerprints(words, short):
            slot = (hashes[places] >> np.uint64(64 - BITS)).astype(np.int64)
            places = places[(bits[slot >> 3] >> (slot & 7)) & 1 == 1]
            if len(places):
                around = contexts(words, places, k, reach)
                mine += [
                    {"k": k, "hash": h, "place": p, "of_doc": c.tobytes()}
                    for h, p, c in zip(hashes[places].view(np.int64).tolist(), places.tolist(), around, strict=True)
                ]
        return len(words), mine

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.uint8)
        kind = pa.list_(
            pa.struct([("k", pa.int32()), ("hash", pa.int64()), ("place", pa.int64()), ("of_doc", pa.binary())])
        )
        with contextlib.closing(WordHasher()) as hasher:
            for batch in batches:
                for part in slices(batch):
                    found = [hits_of(hasher, bits, text) for text in part.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("row"),
                            part.column("doc_id"),
                            pa.array([n for n, _ in found], pa.int64()),
                            pa.array([hits for _, hits in found], kind),
                        ],
                        ["row", "doc_id", "n_words", "hits"],
                    )

    return map_batches(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
        work,
        f"row long, doc_id {type_of(docs, 'doc_id')}, n_words long, "
        "hits array<struct<k int, hash long, place long, of_doc binary>>",
    )


def extended(hits: DataFrame) -> DataFrame:
    """(row, item_id, lo, hi): spans that a document shares with an item, hi exclusive; only spans of SPAN
    words or of a whole short item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, place = (batch.column(c).to_numpy() for c in ("k", "place"))
            lo, hi, good = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64), np.zeros(len(k), bool)
            for size in np.unique(k):
                mine = np.flatnonzero(k == size)
                reach = REACH if size == K else 0
                width = size + 2 * reach
                # Short items of K words have contexts without sides.
                lengths = np.array([len(x) for x in batch.column("of_item").take(pa.array(mine)).to_pylist()])
                for bytes_ in np.unique(lengths):
                    rows = mine[lengths == bytes_]
                    width, reach = bytes_ // 8, (bytes_ // 8 - size) // 2
                    of = [
                        np.frombuffer(b"".join(batch.column(c).take(pa.array(rows)).to_pylist()), np.uint64)
                        for c in ("of_doc", "of_item")
                    ]
                    same = (of[0].reshape(-1, width) == of[1].reshape(-1, width)) & (of[0].reshape(-1, width) != 0)
                    core = same[:, reach : reach + size].all(axis=1)
                    after = np.cumprod(same[:, reach + size :], axis=1).sum(axis=1)
                    before = np.cumprod(same[:, :reach][:, ::-1], axis=1).sum(axis=1)
                    lo[rows], hi[rows] = place[rows] - before, place[rows] + size + after
                    good[rows] = core & ((before + size + after >= SPAN) if reach else True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("item_id"), pa.array(lo), pa.array(hi)],
                ["row", "item_id", "lo", "hi"],
            ).filter(pa.array(good))

    return map_batches(hits, work, "row long, item_id string, lo long, hi long")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted identifiers as strings) of each row."""
    prints = write_table(item_prints(items), "item_prints")
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    filled = (
        prints.withColumn("slot", F.shiftrightunsigned("hash", 64 - BITS).cast("int"))
        .groupBy(F.expr("slot DIV 8").alias("at"))
        .agg(F.expr("bit_or(shiftleft(1, slot % 8))").alias("bits"))
    )
    for batch in filled.toArrow().to_batches():  # at most one row per byte of the bitmap
        bits[batch.column("at").to_numpy()] = batch.column("bits").to_numpy()
    short = sorted(r["k"] for r in prints.where(F.octet_length("of_item") == F.col("k") * 8).select("k").distinct().collect())

    found = write_table(document_prints(docs, bits, short), "document_prints")
    hits = found.select("row", F.inline("hits")).join(
        prints.withColumnsRenamed({"k": "item_k", "hash": "item_hash"}),
        (F.col("k") == F.col("item_k"))
        & (F.col("hash") == F.col("item_hash"))
        & (F.octet_length("of_doc") == F.octet_length("of_item")),
    )
    spans = write_table(
        extended(hits.select("row", "item_id", "k", "place", "of_doc", "of_item")).distinct(), "spans"
    )

    # Union of the spans of a document: a span adds what lies beyond the furthest end before it. Spans are cut
    # into tiles first, so that an ordered group is one tile of a document, however long the document is.
    tile = 4096
    tiled = (
        spans.select("row", "lo", "hi")
        .distinct()
        .select("*", F.explode(F.sequence(F.floor(F.col("lo") / tile), F.floor((F.col("hi") - 1) / tile))).alias("t"))
        .select(
            "row",
            "t",
            F.greatest("lo", F.col("t") * tile).alias("lo"),
            F.least("hi", (F.col("t") + 1) * tile).alias("hi"),
        )
        .distinct()
    )
    before = Window.partitionBy("row", "t").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    covered = tiled.withColumn("end", F.coalesce(F.max("hi").over(before), F.lit(0))).groupBy("row").agg(
        F.sum(F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", "end"))).alias("n_hit")
    )
    named = spans.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    result = covered.join(named, "row")
    return (
        found.select("row", "doc_id", "n_words")
        .join(result, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows without a hit word, with the columns of the input. Rows are told by identifier and text, so rows
    that share an identifier, or have none, are judged each by its own text."""
    text_key = F.xxhash64(docs["text"])
    found = decontaminate(docs.select(F.struct("doc_id", text_key.alias("of")).alias("doc_id"), "text"), items)
    hit = found.where("n_hit > 0").select(F.col("doc_id.doc_id").alias("hit_id"), F.col("doc_id.of").alias("hit_of")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit_id"]) & (text_key == hit["hit_of"]), "left_anti")
