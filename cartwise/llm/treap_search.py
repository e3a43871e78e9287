"""Ranked lexical search with a K2-treap over the grid of terms and documents.

The index is a table of shards. A shard holds some documents as columns, in ascending order of identifier,
and their terms as rows, the most frequent first; a point of the grid is the impact of a term in a document.
The grid is halved in both directions again and again. Of every cell with points the treap keeps the largest
impact, so parents are never below their children; a cell with one point is that point, a cell with more has
a mask of its quarters, and cells of a level lie in Z-order, so that no pointers are stored.

An item descends along the rows of all its terms at once, over ranges of documents: a state is a range and,
for every term, the cell of that row and range. The sum of weight times largest impact bounds every score in
the range. The best bounds are split first, and lower documents first among equals, until no open range can
beat the 50 documents found; so results are exact, ties included. States are split in small groups with numpy.
Some shards are searched first: the others leave off where no range can reach the 50th score found there.

Impacts need the number of documents and of terms, which one pass counts before. Shards are made where the
documents are, with at most about POINTS points each, so nothing is shuffled but results: the best of each
shard and item. Items are searched in blocks of bounded size; a block is what is broadcast.

Terms are told by 64-bit hashes. Defined cases: null and empty texts have no terms and do not count; an item
without terms, or whose terms occur nowhere, has no rows; rows that share an item identifier are one item with
the terms of all, a null identifier is one of them; repeated documents are ranked each; documents without
identifier come after others of the same score; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.llm.shared import map_batches, slices, steady_objects, text_bytes, write_table

BEST = 50
POINTS = 1_000_000  # of a shard, beyond the last document's
SAMPLED = 16  # one shard of so many is searched first, for scores that the others' documents must reach
BLOCK_BYTES = 32 << 20  # item text that is searched for at a time
SPLIT = 96  # ranges that are split at a time
SPACING = 8  # a cell has 2 ** SPACING times fewer rows than documents, so that maxima tell rows apart early
PART_BYTES = 1 << 20  # text that is split into terms at a time
CODEC = "zstd"

#: What a term is made of, as the contract's pattern; A-Z in lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM_BYTES).split()


def hashes_of(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    m = 50 + (50 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


#: How far bits move, and where they are then, while a number's bits are spread.
_INTERLEAVED = (
    (32, 0x00000000FFFFFFFF),
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in _INTERLEAVED[1:]:
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _gather(x: np.ndarray) -> np.ndarray:
    """The bits at the even places."""
    x = x & np.uint64(_INTERLEAVED[-1][1])
    for (shift, _), (_, mask) in zip(_INTERLEAVED[:0:-1], _INTERLEAVED[-2::-1], strict=True):
        x = (x | (x >> np.uint64(shift))) & np.uint64(mask)
    return x.astype(np.int64)


_QUARTERS = np.array([bin(m).count("1") for m in range(16)], np.int64)
#: Children of a cell before its quarter q, by mask.
_BEFORE = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)


class Treap:
    """The cells, level after level and in Z-order within a level, so the children of a cell are where the
    children of all cells before it end. A side of the grid has 2 ** height places."""

    def __init__(self, height: int, mask: np.ndarray, most: np.ndarray, row: np.ndarray, column: np.ndarray):
        self.height = height
        self.mask = mask  # quarters with points of each cell; 0 for a single point
        self.most = most  # largest impact of each cell
        self.row, self.column = row, column  # of single points, by place among the single points
        self.child = 1 + np.cumsum(_QUARTERS[mask]) - _QUARTERS[mask]
        self.point = np.cumsum(mask == 0) - 1

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
        rows = rows << SPACING
        side = int(max(rows.max(), columns.max())) + 1 if len(rows) else 1
        if side > 1 << 32:
            raise ValueError("a document with more distinct terms than the grid has rows")
        height = (side - 1).bit_length()
        codes = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(codes)
        codes, values = codes[order], values[order]
        masks, most, points = [], [], []
        for level in range(height + 1):
            if not len(codes):
                break
            cells = codes >> np.uint64(2 * (height - level))
            starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
            held = np.diff(starts, append=len(codes))
            single = held == 1
            below = (codes >> np.uint64(max(2 * (height - level - 1), 0))) & np.uint64(3)
            quarters = np.bitwise_or.reduceat(np.uint8(1) << below.astype(np.uint8), starts)
            masks.append(np.where(single, np.uint8(0), quarters))
            most.append(np.maximum.reduceat(values, starts))
            points.append(codes[starts[single]])
            stay = np.repeat(~single, held)
            codes, values = codes[stay], values[stay]
        if not masks:
            return cls(0, *(np.empty(0, t) for t in (np.uint8, np.int64, np.int64, np.int64)))
        point = np.concatenate(points)
        row = _gather(point >> np.uint64(1)) >> SPACING
        return cls(height, np.concatenate(masks), np.concatenate(most), row, _gather(point))

    def best(self, rows: np.ndarray, weights: np.ndarray, columns: int, k: int, least: int = 1) -> list[tuple[int, int]]:
        """(score, column) of the k columns with the largest sums of weight times impact, the largest first
        and the lower column first among equals; only sums of `least` and more."""
        if not len(rows) or not len(self.mask):
            return []
        # Of each state and term: the cell (-1 none, -2 a single point), the point's column, the largest impact.
        pool = np.zeros((4 * SPLIT, 3, len(rows)), np.int64)
        self._settle(rows, pool[:1])
        used = 1
        heap = [(-int(pool[0, 2] @ weights), 0, 0, 0)]
        found: list[tuple[int, int]] = []
        while heap and len(found) < k:
            group = []
            while heap and len(group) < SPLIT:
                bound, low, level, at = heap[0]
                if -bound < least:
                    heap.clear()
                    break
                if level == self.height:
                    if group:
                        break  # a result counts only when nothing before it is open
                    found.append((-bound, low))
                    if len(found) == k:
                        break
                else:
                    group.append((low, level, at))
                heapq.heappop(heap)
            if not group or len(found) == k:
                continue
            low, level, at = np.array(group, np.int64).T
            halves, starts, levels = self._halves(rows, low, level, pool[at])
            bounds = halves[:, 2] @ weights
            kept = np.flatnonzero((bounds >= least) & (starts < columns))
            # Half of the new states take their parents' places.
            places = np.concatenate([at, np.arange(used, used + max(len(kept) - len(at), 0))])[: len(kept)]
            used += max(len(kept) - len(at), 0)
            if used > len(pool):
                pool = np.concatenate([pool, np.zeros_like(pool)])
            pool[places] = halves[kept]
            rows_of = zip((-bounds[kept]).tolist(), starts[kept].tolist(), levels[kept].tolist(), places.tolist(), strict=True)
            for entry in rows_of:
                heapq.heappush(heap, entry)
        return found

    def _halves(self, rows: np.ndarray, low: np.ndarray, level: np.ndarray, states: np.ndarray):
        """States, first documents and levels of both halves of all ranges."""
        shift = self.height - level - 1
        half = np.int64(1) << shift
        row_bit = ((rows << SPACING) >> shift[:, None]) & 1
        out = np.concatenate([states, states])
        starts = np.concatenate([low, low + half])
        cell, column, value = out[:, 0], out[:, 1], out[:, 2]
        gone = (cell == -2) & ((column < starts[:, None]) | (column >= (starts + np.concatenate([half, half]))[:, None]))
        inner = cell >= 0
        i, j = np.nonzero(inner)
        parent = cell[i, j]
        quarter = 2 * row_bit[i % len(low), j] + (i >= len(low))
        mask = self.mask[parent]
        has = (mask >> quarter) & 1 == 1
        gone[i[~has], j[~has]] = True
        cell[i[has], j[has]] = self.child[parent[has]] + _BEFORE[mask[has], quarter[has]]
        cell[gone], value[gone] = -1, 0
        self._settle(rows, out)
        return out, starts, np.concatenate([level + 1, level + 1])

    def _settle(self, rows: np.ndarray, states: np.ndarray) -> None:
        """Fills in the largest impacts of cells; single points become points or, of other rows, nothing."""
        cell, column, value = states[:, 0], states[:, 1], states[:, 2]
        i, j = np.nonzero(cell >= 0)
        places = cell[i, j]
        value[i, j] = self.most[places]
        single = self.mask[places] == 0
        i, j, place = i[single], j[single], self.point[places[single]]
        own = self.row[place] == rows[j]
        cell[i, j] = np.where(own, -2, -1)
        column[i, j] = self.column[place]
        value[i[~own], j[~own]] = 0


_ARRAYS = ("doc_ids", "known", "terms", "rows", "df", "mask", "most", "row", "column")
_KINDS = dict(zip(_ARRAYS, ("<i8", "u1", "<u8", "<u4", "<u4", "u1", "<u4", "<u4", "<u4"), strict=True))
SHARD = "height int, draw int, " + ", ".join(f"{a} struct<n: int, data: binary>" for a in _ARRAYS)


def _packed(name: str, x: np.ndarray) -> dict:
    return {"n": len(x), "data": pa.compress(x.astype(_KINDS[name]).tobytes(), codec=CODEC, asbytes=True)}


def _unpacked(shard: dict, name: str) -> np.ndarray:
    packed, kind = shard[name], _KINDS[name]
    size = packed["n"] * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(packed["data"], decompressed_size=size, codec=CODEC) if size else b"", kind)


class ShardBuilder:
    """Collects documents and turns them into a shard."""

    def __init__(self, documents: int, length: int):
        self.documents, self.length = documents, length
        self.clear()

    def clear(self) -> None:
        self.ids: list[int | None] = []
        self.of: list[np.ndarray] = []  # distinct terms, as hashes, of each document
        self.impact: list[np.ndarray] = []
        self.points = 0

    def add(self, doc_id: int | None, terms: list[int], known: dict[bytes, int]) -> None:
        hashes = np.fromiter(map(known.__getitem__, terms), np.uint64, len(terms))
        if not len(hashes):
            return
        distinct, tf = np.unique(hashes, return_counts=True)
        self.ids.append(doc_id)
        self.of.append(distinct)
        self.impact.append(impacts(tf, np.int64(len(hashes)), self.documents, self.length))
        self.points += len(distinct)

    def shard(self) -> pa.RecordBatch:
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        ids = [self.ids[i] for i in order]
        columns = np.repeat(np.arange(len(order)), [len(self.of[i]) for i in order])
        terms, row, df = np.unique(np.concatenate([self.of[i] for i in order]), return_inverse=True, return_counts=True)
        place = np.empty(len(terms), np.int64)
        place[np.argsort(-df, kind="stable")] = np.arange(len(terms))
        treap = Treap.build(place[row], columns, np.concatenate([self.impact[i] for i in order]))
        arrays = (
            np.array([i or 0 for i in ids], np.int64),
            np.array([i is not None for i in ids]),
            terms,
            place,
            df,
            treap.mask,
            treap.most,
            treap.row,
            treap.column,
        )
        self.clear()
        packed = [_packed(n, x) for n, x in zip(_ARRAYS, arrays, strict=True)]
        kind = pa.struct([("n", pa.int32()), ("data", pa.binary())])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([treap.height], pa.int32()),
                pa.array([zlib.crc32(terms.tobytes()) % SAMPLED], pa.int32()),
                *[pa.array([x], kind) for x in packed],
            ],
            ["height", "draw", *_ARRAYS],
        )


def term_counts(column: pa.Array) -> np.ndarray:
    """How many terms each text has: terms begin where a byte of a term follows none."""
    data, starts = text_bytes(column)
    part = np.frombuffer(_TERM_BYTES, np.uint8)[data] != 32
    begins = part & ~np.concatenate([[False], part[:-1]])[: len(part)]
    first = starts[:-1][starts[:-1] < starts[1:]]
    begins[first] = part[first]
    before = np.concatenate([[0], np.cumsum(begins)])
    return before[starts[1:]] - before[starts[:-1]]


def statistics(docs: DataFrame) -> tuple[int, int]:
    """Number of documents with terms and of all their terms."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                n = term_counts(part.column("text"))
                yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["d", "n"])

    counted = map_batches(docs.select("text"), work, "d long, n long")
    found = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("d", "n")]).first()
    return found["d"], found["n"]


def build_index(docs: DataFrame, documents: int, length: int) -> DataFrame:
    """The shards, written to the shared folder."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = ShardBuilder(documents, length)
        with steady_objects():
            for batch in batches:
                for part in slices(batch, limit=PART_BYTES):
                    split = [terms_of(t) for t in part.column("text").to_pylist()]
                    distinct = list(set().union(*split))
                    known = dict(zip(distinct, hashes_of(distinct).tolist(), strict=True))
                    for doc_id, terms in zip(part.column("doc_id").to_pylist(), split, strict=True):
                        builder.add(doc_id, terms, known)
                        if builder.points >= POINTS:
                            yield builder.shard()
            if builder.ids:
                yield builder.shard()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return write_table(map_batches(source, work, SHARD), "treap_index")


def document_frequencies(index: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """How many documents hold each of the terms (sorted hashes)."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        for batch in batches:
            for place in range(batch.num_rows):
                (shard,) = batch.slice(place, 1).to_pylist()
                held, df = _unpacked(shard, "terms"), _unpacked(shard, "df")
                at = np.minimum(np.searchsorted(held, asked), len(held) - 1)
                has = held[at] == asked
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked[has].view(np.int64)), pa.array(df[at[has]].astype(np.int64))], ["term", "df"]
                )

    counted = map_batches(index.select("terms", "df"), work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"] & 0xFFFFFFFFFFFFFFFF: r["df"] for r in counted.collect()}


def _shard_results(index: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], least: dict[int, int], k: int) -> DataFrame:
    """(item, doc_id, score): each shard's best for each query. A document must reach the query's `least` score
    and the k best that the task has found before, so none of the k best of all is left out."""
    sent = index.sparkSession.sparkContext.broadcast((queries, least))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, least = sent.value
        seen = {i: [least.get(i, 1)] * k for i in range(len(asked))}  # the k best scores, a heap
        for batch in batches:
            for place in range(batch.num_rows):
                (shard,) = batch.slice(place, 1).to_pylist()
                held, rows = _unpacked(shard, "terms"), _unpacked(shard, "rows").astype(np.int64)
                ids, known = _unpacked(shard, "doc_ids"), _unpacked(shard, "known").astype(bool)
                mask, most, row, column = (_unpacked(shard, a) for a in ("mask", "most", "row", "column"))
                treap = Treap(shard["height"], mask, most, row, column)
                out = []
                for item, (terms, weights) in enumerate(asked):
                    at = np.minimum(np.searchsorted(held, terms), len(held) - 1)
                    has = held[at] == terms
                    best = treap.best(rows[at[has]], weights[has], len(ids), k, seen[item][0])
                    for score, c in best:
                        heapq.heappushpop(seen[item], score)
                        out.append((item, c, score))
                item, at, score = (np.array([r[i] for r in out], np.int64) for i in range(3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item), pa.array(ids[at], mask=~known[at]), pa.array(score)], ["item", "doc_id", "score"]
                )

    return map_batches(index, work, "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item. Spark keeps each task's first rows of the window before it shuffles."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(index: DataFrame, items: dict, documents: int, k: int) -> DataFrame:
    """(item, rank, doc_id, score) for the items of a block; `item` is its place in the block."""
    asked = np.unique(np.concatenate([*items.values(), np.empty(0, np.uint64)]))
    weights = {t: weight(df, documents) for t, df in document_frequencies(index, asked).items()}
    queries = []
    for terms in items.values():
        kept = np.array([t for t in terms.tolist() if weights.get(t, 0) > 0], np.uint64)
        queries.append((kept, np.array([weights[t] for t in kept.tolist()], np.int64)))
    first = write_table(_ranked(_shard_results(index.where("draw = 0"), queries, {}, k), k), "first_shards")
    least = {r["item"]: r["score"] for r in first.where(F.col("rank") == k).collect()}  # one row per item
    rest = _shard_results(index.where("draw > 0"), queries, least, k)
    return _ranked(first.drop("rank").unionByName(rest), k)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms (distinct hashes) of each identifier."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [np.unique(hashes_of(terms_of(t))).view(np.int64) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id"), pa.array(found, pa.list_(pa.int64()))], ["item_id", "terms"]
                )

    kind = items.schema["item_id"].dataType.simpleString()
    split = map_batches(items.select("item_id", "text"), work, f"item_id {kind}, terms array<long>")
    return split.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score of each item's `k` best documents."""
    if k < 1:
        raise ValueError("k must be 1 or more")
    spark: SparkSession = docs.sparkSession
    documents, length = statistics(docs)
    asked = write_table(item_terms(items), "item_terms")
    size = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()["n"] * 8
    blocks = max(1, -(-size // BLOCK_BYTES))
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    if not documents:
        return out
    index = build_index(docs, documents, length)
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(blocks)) == block).collect()
        if not mine:
            continue
        terms = {i: np.array(r["terms"], np.int64).view(np.uint64) for i, r in enumerate(mine)}
        ranked = _search_block(index, terms, documents, k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)], f"item long, item_id {kind}")
        out = out.unionByName(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
