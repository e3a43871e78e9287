"""Near-duplicate documents by min-max hashing.

A document's set holds the 64-bit hashes of its distinct word shingles. Every permutation of the hashes
gives two signature values, the minimum and the maximum, each equal in two documents with the probability of
their Jaccard similarity; so 80 permutations give 160 values, banded 32 x 5. At a similarity of 0.85 a pair
misses all bands with a probability of 7e-9, at 0.80 of 3e-6. Candidates are confirmed on their full sets.

Documents of equal sets form a class and only its smallest document is banded. Links matter by connected
component, so not all pairs of a bucket are formed. Members are compared with one pivot per bucket, first
the smallest and then SAMPLED random ones, which joins what belongs together. Where a bucket then still holds
several components, its members outside the largest are held against all its members in blocks of BLOCK
documents: inside a task, numpy bounds the overlap of two sets by the counts of their hashes in GROUPS groups
(the sum of the smaller counts), and only pairs that the bound lets pass, once for all bands, are compared on
full sets. The bound never drops a link, so no link between components is lost.

Defined cases: null texts and texts without words have empty sets and are linked with nothing; a text of
fewer words than a shingle has one shingle, the whole sequence; rows that share an identifier count as one
document; null identifiers are never reached by others; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import map_batches, slices, type_of, write_table

PERMUTATIONS = 80
BANDS = 32
ROWS = 2 * PERMUTATIONS // BANDS
KEPT_WORDS = 200_000
CHUNK = 4096  # shingles that are permuted at a time
SAMPLED = 2
BLOCK = 1024
GROUPS = 256


@functools.cache
def _constants(seed: int = 20240) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the permutations, and the multipliers of places in a shingle or band."""
    rng = np.random.default_rng(seed)
    draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(PERMUTATIONS), draw(PERMUTATIONS), draw(64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads sums of products over all bits (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of shingle hashes. Words are what ASCII white space separates, A-Z in lower case."""

    def __init__(self, size: int):
        self.size = size
        self.known: dict[bytes, int] = {}

    def words(self, text: str | None) -> np.ndarray:
        found = (text or "").encode().lower().split()
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        known = self.known
        for w in set(found).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))

    def close(self) -> None:
        """Drops the words met so far; a Python worker lives on for other tasks."""
        self.known = {}

    def set_of(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes."""
        words = self.words(text)
        if not len(words):
            return words
        places = _constants()[2]
        size = min(self.size, len(words))
        total = np.full(len(words) - size + 1, size, np.uint64)
        for j in range(size):
            total += words[j : len(words) - size + 1 + j] * places[j]
        return np.unique(_mixed(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """All minima, then all maxima."""
    times, plus, _ = _constants()
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        permuted = times[:, None] * hashes[None, start : start + CHUNK] + plus[:, None]
        np.minimum(low, permuted.min(axis=1), out=low)
        np.maximum(high, permuted.max(axis=1), out=high)
    return np.concatenate([low, high])


def bands(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    places = _constants()[2]
    grid = values.reshape(BANDS, ROWS)
    total = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * places[ROWS]
    for j in range(ROWS):
        total = total + _mixed(grid[:, j]) * places[j]
    return _mixed(total).view(np.int64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (null for an empty set), bands of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with contextlib.closing(Shingler(size)) as shingler:
            for batch in batches:
                for part in slices(batch):
                    counts, keys, found = [], [], []
                    for text in part.column("text").to_pylist():
                        hashes = shingler.set_of(text)
                        counts.append(len(hashes))
                        keys.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                        found.append(bands(signature(hashes)) if len(hashes) else [])
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id"),
                            pa.array(counts, pa.int64()),
                            pa.array(keys, pa.binary()),
                            pa.array(found, pa.list_(pa.int64())),
                        ],
                        ["doc_id", "n_shingles", "set_key", "bands"],
                    )

    schema = f"doc_id {type_of(docs, 'doc_id')}, n_shingles long, set_key binary, bands array<long>"
    return map_batches(docs.select("doc_id", "text"), work, schema)


def group_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes fall into each group; sets of more than 65,535 hashes are never bounded by them."""
    return np.minimum(np.bincount(hashes >> np.uint64(56), minlength=GROUPS), 65535).astype("<u2")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, its full set and its counts by group."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with contextlib.closing(Shingler(size)) as shingler:
            for batch in batches:
                for part in slices(batch, limit=1 << 20):
                    found = [shingler.set_of(t) for t in part.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id"),
                            pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64())),
                            pa.array([group_counts(x).tobytes() for x in found], pa.binary()),
                        ],
                        ["doc_id", "hashes", "counts"],
                    )

    schema = f"doc_id {type_of(docs, 'doc_id')}, hashes array<long>, counts binary"
    return map_batches(docs.select("doc_id", "text"), work, schema)


def block_pairs(left: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of different components in a bucket that may be similar, each in its first common band.

    `left` has (band, c, comp), `info` (c, n, bands, counts). A block holds about BLOCK documents.
    """
    sized = left.groupBy("band", "comp").agg(F.count("*").alias("held"))
    buckets = sized.groupBy("band").agg(
        F.max_by("comp", "held").alias("top"), F.sum("held").alias("m"), F.max("held").alias("most")
    )
    buckets = buckets.select(
        "band",
        "top",
        F.ceil((F.col("m") - F.col("most")) / BLOCK).cast("int").alias("few"),
        F.ceil(F.col("m") / BLOCK).cast("int").alias("all"),
    )
    rows = left.join(buckets, "band")
    spread = lambda n: F.pmod(F.xxhash64("c"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    side = lambda asks: ["band", "c", "comp", F.lit(asks).alias("asks")]
    asked = rows.where("comp <> top").select(*side(True), spread("few").alias("i"), every("all").alias("j"))
    held = rows.select(*side(False), every("few").alias("i"), spread("all").alias("j"))
    placed = asked.union(held).join(info, "c")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = rows[rows.asks], rows[~rows.asks]
        ids, sizes, comps = y.c.to_numpy(), y.n.to_numpy(), y.comp.to_numpy()
        if not len(x) or not len(y):
            return pd.DataFrame({"a": ids[:0], "b": ids[:0]})
        counts = np.frombuffer(b"".join(y.counts), "<u2").reshape(len(y), GROUPS)
        keys = np.stack(y.bands.to_numpy())
        found = []
        for c, n, comp, mine, band_keys, band in zip(x.c, x.n, x.comp, x.counts, x.bands, x.band, strict=True):
            at = np.flatnonzero((comps != comp) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)))
            shared = np.minimum(counts[at], np.frombuffer(mine, "<u2")).sum(axis=1, dtype=np.int64)
            shared[np.minimum(sizes[at], n) > 65535] = n
            at = at[100 * shared >= percent * (sizes[at] + n - shared)]
            first = np.asarray(band_keys)[(keys[at] == band_keys).argmax(axis=1)]
            found += [(min(c, d), max(c, d)) for d in ids[at[first == band]]]
        return pd.DataFrame(found, columns=["a", "b"], dtype=ids.dtype)

    kind = type_of(info, "c")
    return placed.groupBy("band", "i", "j").applyInPandas(compare, f"a {kind}, b {kind}").distinct()


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("both", both)
        .where(F.col("both") * 100 >= F.lit(percent) * (F.size("of_a") + F.size("of_b") - F.col("both")))
        .select("a", "b")
        .distinct()
    )


def sorted_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Joins tables of labels and members by sorting. Small ones would else be broadcast, and the driver builds a
    broadcast table of some MB for each of the many joins, however few their rows are."""
    return left.join(right.hint("merge"), on, how)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of a link. Labels take the smallest label
    next to them and then that label's own label, until nothing changes; tables are written each round.

    Edges, with one from each node to itself, and lowered labels are written too: read twice from a plan, either
    would be planned and run twice, and the driver holds the plans and broadcast tables of all rounds."""
    ends = [F.struct(F.col(x).alias("node"), F.col(y).alias("next")) for x in "ab" for y in "ab"]
    edges = write_table(links.select(F.inline(F.array(*ends))).distinct(), "edges")
    labels = edges.where("node = next").select("node", F.col("next").alias("label"))
    while True:
        seen = sorted_join(edges, labels.withColumnRenamed("node", "next"), "next")
        own = F.max(F.when(F.col("node") == F.col("next"), F.col("label")))
        lower = write_table(seen.groupBy("node").agg(own.alias("was"), F.min("label").alias("lower")), "lower")
        jump = lower.select(F.col("node").alias("lower"), F.col("lower").alias("label"))
        stepped = write_table(sorted_join(lower, jump, "lower").select("node", "was", "label"), "labels")
        labels = stepped.select("node", "label")
        if stepped.where("was <> label").isEmpty():
            return labels


def _mixed_buckets(left: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component, of the buckets that still hold several components."""
    known = labels.select(F.col("node").alias("c"), F.col("label").alias("comp"))
    left = sorted_join(left.drop("comp"), known, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    mixed = left.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return sorted_join(left, mixed.select("band"), "band", "left_semi")


def _joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links. Only the labels at the ends of links are joined anew."""
    if links.isEmpty():
        return labels
    to = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_l"))
    between = sorted_join(sorted_join(links, to("a"), "a", "left"), to("b"), "b", "left")
    between = between.select(F.coalesce("a_l", "a").alias("a"), F.coalesce("b_l", "b").alias("b")).distinct()
    merged = components(between).select(F.col("node").alias("label"), F.col("label").alias("new"))
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    known = labels.union(ends.select("node", F.col("node").alias("label")))
    known = known.groupBy("node").agg(F.min("label").alias("label"))
    renamed = sorted_join(known, merged, "label", "left")
    return write_table(renamed.select("node", F.coalesce("new", "label").alias("label")), "labels")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id) per row."""
    sketch = write_table(sketches(docs, size), "sketches")
    classes = (
        sketch.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("c"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    )
    classes = write_table(classes, "classes")

    keyed = classes.select("c", "n", F.explode("bands").alias("band"))
    shared = keyed.groupBy("band").agg(F.min("c").alias("pivot"), F.count("*").alias("held")).where("held > 1")
    members = write_table(keyed.join(shared.select("band", "pivot"), "band"), "members")

    ids = members.select(F.col("c").alias("doc_id")).distinct()
    sets = write_table(shingle_sets(docs.join(ids, "doc_id", "left_semi"), size), "sets")
    sizes = members.select("c", "n").distinct()

    def confirmed(pairs: DataFrame, checked: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """New pairs of similar sizes, written; and the links among them."""
        small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
        pairs = pairs.where(small * 100 >= F.lit(percent) * large).select("a", "b").distinct()
        if checked is not None:
            pairs = sorted_join(pairs, checked, ["a", "b"], "left_anti")
        pairs = write_table(pairs, "pairs")
        return pairs, linked(pairs, sets, percent)

    # First each document with its smallest pivot alone, which joins most groups.
    first = members.where("c <> pivot").groupBy("c").agg(F.min("pivot").alias("a"), F.first("n").alias("b_n"))
    first = first.join(sizes.withColumnsRenamed({"c": "a", "n": "a_n"}), "a").withColumnRenamed("c", "b")
    checked, links = confirmed(first, None)
    labels = components(write_table(links, "links"))

    left = members.drop("pivot")
    for step in range(SAMPLED):
        left = write_table(_mixed_buckets(left, labels), "left")
        pivots = left.groupBy("band").agg(
            F.min_by(F.struct("c", "n", "comp"), F.xxhash64("c", F.lit(step))).alias("p")
        )
        pairs = sorted_join(left, pivots, "band").where("comp <> p.comp")
        new, links = confirmed(
            pairs.select(
                F.least("c", "p.c").alias("a"),
                F.greatest("c", "p.c").alias("b"),
                F.col("n").alias("a_n"),
                F.col("p.n").alias("b_n"),
            ),
            checked,
        )
        checked = checked.union(new)
        labels = _joined_components(labels, write_table(links, "links"))
        # A pivot has been compared with all of its bucket that it was not joined with before.
        left = sorted_join(left, pivots.select("band", F.col("p.c").alias("c")), ["band", "c"], "left_anti")

    left = write_table(_mixed_buckets(left, labels), "left")
    info = classes.select("c", "n", "bands").join(sets.select(F.col("doc_id").alias("c"), "counts").distinct(), "c")
    pairs = block_pairs(left.select("band", "c", "comp"), info, percent).join(checked, ["a", "b"], "left_anti")
    links = linked(write_table(pairs, "pairs"), sets, percent)
    labels = _joined_components(labels, write_table(links, "links"))

    reached = classes.join(labels.withColumnRenamed("node", "c"), "c", "left").select(
        "set_key", F.coalesce("label", "c").alias("component")
    )
    return sketch.join(reached, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(False)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one of the smallest identifier, with the columns of the input.
    Rows without words or identifier stay; rows are told by their identifier."""
    found = near_duplicates(docs, size, percent)
    gone = found.where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
