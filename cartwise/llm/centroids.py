"""Language identification by nearest centroid.

A text becomes counts of byte 1- to 3-grams of its lower-case letters, hashed into DIMENSIONS places, damped
by a logarithm, weighted by inverse document frequency and normalised. Each language has up to CLUSTERS
centroids (spherical k-means, none with less than LEAST_SHARE of the language's rows), and the nearest centroid
by cosine decides. A text is rejected if it has no letter, or if it is further from its language than texts of
that language and about its length are: if its cosine is under MARGIN of the LOW quantile of training texts,
which are measured whole and in pieces of LENGTHS. Texts under the shortest length are not rejected by distance.

The model is fitted on at most about TRAIN_ROWS labelled rows, shared out among the languages by a hash of
the identifier; its size does not depend on the corpus. Of more than MOST_LANGUAGES labels those with most rows
are learned. Prediction reads whole texts, in parts of PART bytes.

Defined cases: null texts and texts without letters are `und` with score 0 and rejected; without any
labelled row every text is `und` with score 0 and only texts without letters are rejected; rows with a
null label or identifier are predicted but not learned from; repeated rows give repeated results; an empty
table gives no rows; other columns are ignored or, with `carry`, kept in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import map_batches, slices, text_bytes, type_of

DIMENSIONS = 4096
CLUSTERS = 3
TRAIN_ROWS = 4000
MOST_LANGUAGES = 500
LEAST_SHARE = 0.05
LENGTHS = (24, 48, 96, 192, 384, 768, 1536)  # letters and gaps of the pieces that floors are measured on
LOW, MARGIN = 0.05, 0.5
STEPS = 20  # per unit of a logarithm that is packed into a byte
PART = 1 << 18
UNKNOWN = "und"

_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_TIMES = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_SHIFT = np.uint32(32 - DIMENSIONS.bit_length() + 1)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def letters_of(text: str) -> np.ndarray:
    """Bytes of the lower-case letters; runs of other characters are one space."""
    raw = np.frombuffer(b" " + text.lower().encode().translate(_LETTERS) + b" ", np.uint8)
    space = raw == 32
    return raw[~(space & np.concatenate([[False], space[:-1]]))]


def gram_counts(raw: np.ndarray) -> np.ndarray:
    """Hashed counts of the byte n-grams."""
    raw = raw.astype(np.uint32)
    counts = np.zeros(DIMENSIONS, np.int64)
    for start in range(0, len(raw), PART):
        mixed = np.zeros(0, np.uint32)
        part = raw[start : start + PART + 2]
        for n in range(3):
            reach = min(PART, len(part) - n)
            if reach <= 0:
                break
            mixed = (mixed[:reach] if n else np.zeros(reach, np.uint32)) + (part[n : n + reach] + np.uint32(1)) * _TIMES[n]
            hashed = mixed * np.uint32(0x27D4EB2F)
            hashed ^= hashed >> np.uint32(15)
            counts += np.bincount((hashed * np.uint32(0x165667B1)) >> _SHIFT, minlength=DIMENSIONS)
    return counts


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray  # of each centroid's language and each length

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether the text is rejected."""
        raw = [letters_of(t) for t in texts]
        rows = np.stack([np.log1p(gram_counts(r)) for r in raw]).astype(np.float32) * self.idf
        cosine = unit(rows) @ self.centroids.T
        best = cosine.argmax(axis=1)
        found = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)
        floor = self.floors[best, length_class([len(r) for r in raw])]
        return [self.languages[i] for i in best], found, found < floor


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def length_class(sizes: list[int]) -> np.ndarray:
    """0 under the shortest length, then one class up to each next length, the last for all beyond."""
    return np.searchsorted(np.array(LENGTHS), sizes, side="right")


def _clusters(rows: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Spherical k-means from k-means++ starts. A cluster with too few rows starts anew from a random row, and
    is dissolved if it still has too few at the end."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(rows)))]
    while len(chosen) < min(k, len(rows)):
        far = np.clip(1 - (rows @ rows[chosen].T).max(axis=1), 0, None).astype(float)
        if far.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(rows), p=far / far.sum())))
    centres = rows[chosen].copy()
    least = LEAST_SHARE * len(rows)
    for turn in range(2 * rounds):
        owner = (rows @ centres.T).argmax(axis=1)
        held = np.bincount(owner, minlength=len(centres))
        if turn >= rounds and (held < least).any() and len(centres) > 1:
            centres = np.delete(centres, held.argmin(), axis=0)
            continue
        for c in range(len(centres)):
            if held[c] >= least:
                centres[c] = unit(rows[owner == c].mean(axis=0))
            elif turn < rounds // 2:
                centres[c] = rows[rng.integers(len(rows))]
    return centres


def _vectors(packed: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted unit vectors of packed rows, which are unpacked a few at a time: only the result is held whole."""
    out = np.empty(packed.shape, np.float32)
    for start in range(0, len(packed), 256):
        out[start : start + 256] = unit(packed[start : start + 256].astype(np.float32) / STEPS * idf)
    return out


def _gathered(column: pa.ChunkedArray) -> np.ndarray:
    """The packed rows in one array, copied from chunk to chunk."""
    out = np.empty((len(column), DIMENSIONS), np.uint8)
    at = 0
    for chunk in column.chunks:
        out[at : at + len(chunk)] = text_bytes(chunk)[0].reshape(-1, DIMENSIONS)
        at += len(chunk)
    return out


def _packed(counts: np.ndarray) -> bytes:
    """Logarithms of the counts in a byte each, which is what the driver gathers of a training row."""
    return np.minimum(np.rint(np.log1p(counts) * STEPS), 255).astype(np.uint8).tobytes()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """Model from the labelled rows that are not held out."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(
        ~held_out(F.col("doc_id"))
    )
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not sizes:
        return None
    each = -(-train_rows // len(sizes))
    share = F.lit(None).cast("double")
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, each / r["count"]))).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * F.lit(1 << 30)
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Grams of each text (length class -1) and of one piece of it."""
        for batch in batches:
            for part in slices(batch):
                found = []
                for lang, text, at in zip(*(part.column(c).to_pylist() for c in ("lang", "text", "place")), strict=True):
                    raw = letters_of(text)
                    found.append((lang, -1, raw))
                    kind = at % len(LENGTHS)
                    if len(raw) >= LENGTHS[kind]:
                        start = at // len(LENGTHS) % (len(raw) - LENGTHS[kind] + 1)
                        found.append((lang, kind + 1, raw[start : start + LENGTHS[kind]]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.int32()),
                        pa.array([_packed(gram_counts(f[2])) for f in found], pa.binary()),
                    ],
                    ["lang", "kind", "grams"],
                )

    sample = map_batches(
        labelled.where(drawn).select(F.col("lang").cast("string").alias("lang"), "text", place.alias("place")),
        features,
        "lang string, kind int, grams binary",
    ).toArrow()
    langs, kinds = np.array(sample.column("lang").to_pylist(), object), sample.column("kind").to_numpy()
    if not len(langs):
        return None
    rows = _gathered(sample.column("grams"))  # the driver's one copy; languages are unpacked in turn
    del sample
    pa.default_memory_pool().release_unused()
    texts = kinds < 0
    held = np.zeros(DIMENSIONS, np.int64)
    for start in range(0, len(rows), 512):
        held += (rows[start : start + 512][texts[start : start + 512]] > 0).sum(axis=0)
    idf = (np.log((1 + texts.sum()) / (1 + held)) + 1).astype(np.float32)
    names, centres, floors = [], [], []
    for lang in sorted(set(langs)):
        mine = np.flatnonzero(langs == lang)
        # The order of arrival must not matter.
        mine = mine[np.lexsort((*rows[mine, :8].T, kinds[mine]))]
        own, whole = _vectors(rows[mine], idf), texts[mine]
        found = _clusters(own[whole], CLUSTERS)
        names += [lang] * len(found)
        centres.append(found)
        floors += [_floors((own @ found.T).max(axis=1), kinds[mine])] * len(found)
        del own  # before the next language is unpacked
    return Model(names, np.concatenate(centres), idf, np.array(floors))


def _floors(cosine: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Of each length class, what a text of the language has nearly always. Longer texts are nearer, so a class
    takes the pieces of its least length, or of shorter ones where none are as long."""
    out = np.zeros(len(LENGTHS) + 1)
    for kind in range(1, len(LENGTHS) + 1):
        mine = cosine[kinds == kind]
        out[kind] = MARGIN * np.quantile(mine, LOW) if len(mine) else out[kind - 1]
    return out


def identify(docs: DataFrame, model: Model | None, carry: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, rejected of each row; with `carry` the row, as a struct, and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judged(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = sent.value
        letters = np.array([has_letter(t) for t in texts], bool)
        langs, scores, rejected = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), ~letters
        at = np.flatnonzero(letters)
        if known is not None and len(at):
            langs[at], scores[at], rejected[at] = known.score([texts[i] for i in at])
        return langs, scores, rejected

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                for start in range(0, part.num_rows, 256):
                    piece = part.slice(start, 256)
                    langs, scores, rejected = judged(piece.column("text").to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores), pa.array(rejected)],
                        ["doc_id", "lang_pred", "score", "rejected"],
                    )

    def work_on_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.column("carried").slice(start, 256)
                _, _, rejected = judged(pc.struct_field(rows, "text").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(rejected), rows], ["rejected", "carried"])

    if carry:
        whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("carried"))
        return map_batches(whole, work_on_rows, f"rejected boolean, carried {type_of(whole, 'carried')}")
    schema = f"doc_id {type_of(docs, 'doc_id')}, lang_pred string, score double, rejected boolean"
    return map_batches(docs.select("doc_id", "text"), work, schema)


def drop_rejected(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows whose language is known, with the columns of the input. A row crosses to Python once, as a struct."""
    return identify(docs, fit(docs, train_rows), carry=True).where("NOT rejected").select("carried.*")
