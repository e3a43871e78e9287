"""Fill-in-middle transformation by displacement scatter.

A text is cut into prefix, middle and suffix, and the three are put out in another order between sentinels.
Instead of cutting and joining strings, all texts of a batch stay one run of bytes: every piece has a shift,
the distance from its place in the input to its place in the output. The changes of the shift at the borders
of pieces are a difference array, its cumulative sum is the shift of every byte, and one numpy scatter writes
the output. Restoring finds the sentinels in the output and gathers by the same shifts. Both run window by
window over the batch, so that the arrays beside input and output have a fixed size.

Cuts, form and order follow from the identifier alone: of the SHA-256 of `1:` and the identifier, the first
four groups of eight hex digits choose two cuts, whether a text is transformed, and its order.

Defined cases: null and empty texts are `plain` with an empty output; a text that holds a sentinel's string
is `plain`; a null identifier counts as the empty string; repeated rows give repeated results; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import map_batches, slices, text_array, text_bytes, type_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = len(PREFIX)
PLAIN, PSM, SPM = "plain", "psm", "spm"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
WINDOW = 1 << 20  # bytes that are shifted at a time


def windows(size: int) -> Iterator[tuple[int, int]]:
    for start in range(0, size, WINDOW):
        yield start, min(start + WINDOW, size)


def leads(data: np.ndarray) -> np.ndarray:
    """Whether each byte starts a code point."""
    return (data & 0xC0) != 0x80


def code_points(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Code points before each of the places, which ascend."""
    out, before = np.zeros(len(starts), np.int64), 0
    for lo, hi in windows(len(data)):
        counted = np.concatenate([[0], np.cumsum(leads(data[lo:hi]))])
        mine = slice(*np.searchsorted(starts, [lo, hi]))
        out[mine] = before + counted[starts[mine] - lo]
        before += int(counted[-1])
    out[np.searchsorted(starts, len(data)) :] = before
    return out


def places_of(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The byte where the code point of each rank starts; ranks ascend, those beyond the last give the end."""
    out, before = np.full(len(ranks), len(data), np.int64), 0
    for lo, hi in windows(len(data)):
        at = np.flatnonzero(leads(data[lo:hi])) + lo
        mine = slice(*np.searchsorted(ranks, [before, before + len(at)]))
        out[mine] = at[ranks[mine] - before]
        before += len(at)
    return out


def sentinels(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the sentinels' strings start, and the letter of each."""
    found, letters = [], []
    for lo, hi in windows(max(len(data) - MARK + 1, 0)):
        part = data[lo : hi + MARK - 1]
        at = np.flatnonzero((part[: hi - lo] == PREFIX[0]) & (part[2 : hi - lo + 2] == PREFIX[2]))
        letter = part[at + 1]
        good = (letter == PREFIX[1]) | (letter == SUFFIX[1]) | (letter == MIDDLE[1])
        found.append(at[good] + lo)
        letters.append(letter[good])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint8)
    return np.concatenate(found), np.concatenate(letters)


def shifted(starts: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lo, hi, places): where each byte of a window goes. `starts` are the pieces' first bytes in ascending
    order, an empty piece before the one that has the byte, and `shifts` the distances of the pieces."""
    change = np.diff(shifts, prepend=0)
    carried = 0
    for lo, hi in windows(size):
        mine = slice(*np.searchsorted(starts, [lo, hi]))
        steps = np.zeros(hi - lo, np.int64)
        np.add.at(steps, starts[mine] - lo, change[mine])
        steps[0] += carried
        moved = np.cumsum(steps)
        carried = int(moved[-1])
        yield lo, hi, np.arange(lo, hi) + moved


def _layout(sizes: np.ndarray, order: np.ndarray, extra: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where the prefix, middle and suffix of each text start in its output. `order` has the rank of each piece
    in the output, `extra` the bytes of the sentinel before each."""
    at = np.zeros_like(sizes)
    for piece in range(3):
        earlier = order < order[:, piece, None]
        at[:, piece] = begin + ((sizes + extra) * earlier).sum(axis=1) + extra[:, piece]
    return at


#: Ranks of prefix, middle and suffix in the output.
_ORDERS = {PLAIN: (0, 1, 2), PSM: (0, 2, 1), SPM: (1, 2, 0)}


def _pieces(cut1: np.ndarray, cut2: np.ndarray, starts: np.ndarray, forms: np.ndarray):
    """(input starts, sizes, output starts) of all pieces and the ends of the outputs."""
    begin = np.stack([starts[:-1], cut1, cut2], axis=1)
    sizes = np.stack([cut1, cut2, starts[1:]], axis=1) - begin
    order = np.array([_ORDERS[f] for f in forms], np.int64).reshape(-1, 3)
    extra = np.where((forms == PLAIN)[:, None], 0, MARK) * np.ones((1, 3), np.int64)
    ends = np.cumsum((sizes + extra).sum(axis=1))
    return begin, sizes, _layout(sizes, order, extra, ends - (sizes + extra).sum(axis=1)), ends


def transform(column: pa.Array, keys: np.ndarray) -> dict[str, np.ndarray | pa.Array]:
    """n, form, code points of prefix and middle (-1 if plain) and output of each text. `keys` has four
    numbers per text: two that choose the cuts, one for plain and one for the order."""
    data, starts = text_bytes(column)
    first = code_points(data, starts)
    n = np.diff(first)
    held = np.zeros(len(n), bool)
    at, _ = sentinels(data)
    owner = np.searchsorted(starts, at, side="right") - 1
    held[owner[at + MARK <= starts[owner + 1]]] = True
    plain = (n == 0) | held | (keys[:, 2] % 100 >= PLAIN_FROM)
    forms = np.where(plain, PLAIN, np.where(keys[:, 3] % 100 < SPM_BELOW, SPM, PSM))
    low, high = (f(keys[:, 0] % (n + 1), keys[:, 1] % (n + 1)) for f in (np.minimum, np.maximum))
    cuts = places_of(data, (first[:-1, None] + np.stack([low, high], axis=1)).ravel()).reshape(-1, 2)
    begin, sizes, goes, ends = _pieces(*np.minimum(cuts, starts[1:, None]).T, starts, forms)

    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for lo, hi, places in shifted(begin.ravel(), (goes - begin).ravel(), len(data)):
        out[places] = data[lo:hi]
    marked = ~plain
    for piece, mark in enumerate((PREFIX, MIDDLE, SUFFIX)):
        for i in range(MARK):
            out[goes[marked, piece] - MARK + i] = mark[i]
    hide = lambda x: np.where(plain, -1, x)
    return {"n": n, "form": forms, "prefix": hide(low), "middle": hide(high - low), "output": text_array(out, ends)}


def restore(column: pa.Array, forms: np.ndarray) -> pa.Array:
    """The texts, from outputs and forms alone."""
    data, starts = text_bytes(column)
    at, letters = sentinels(data)
    owner = np.searchsorted(starts, at, side="right") - 1
    inside = (at + MARK <= starts[owner + 1]) & (forms[owner] != PLAIN)
    at, letters, owner = at[inside], letters[inside], owner[inside]
    marked = np.flatnonzero(forms != PLAIN)
    if not np.array_equal(owner, np.repeat(marked, 3)):
        raise ValueError("an output without its three sentinels")
    # Pieces in the order of the output: a plain output is one piece between two empty ones.
    begin = np.stack([starts[:-1], starts[1:], starts[1:]], axis=1)
    begin[marked] = at.reshape(-1, 3) + MARK
    stop = np.stack([starts[1:], starts[1:], starts[1:]], axis=1)
    stop[marked, :2] = at.reshape(-1, 3)[:, 1:]
    sizes = stop - begin
    rank = np.array([_ORDERS[f] for f in forms], np.int64).reshape(-1, 3)
    rank[forms == PLAIN] = (0, 1, 2)
    expected = np.array([PREFIX[1], MIDDLE[1], SUFFIX[1]])
    if not np.array_equal(np.take_along_axis(letters.reshape(-1, 3), rank[marked], axis=1), np.tile(expected, (len(marked), 1))):
        raise ValueError("sentinels in another order")
    # By place in the text.
    begin, sizes = (np.take_along_axis(x, rank, axis=1) for x in (begin, sizes))
    ends = np.cumsum(sizes.sum(axis=1))
    goes = (ends - sizes.sum(axis=1))[:, None] + np.cumsum(sizes, axis=1) - sizes
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for lo, hi, places in shifted(goes.ravel(), (begin - goes).ravel(), len(out)):
        out[lo:hi] = data[places]
    return text_array(out, ends)


def keys(doc_id: Column) -> list[Column]:
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of each row."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                chosen = np.stack([part.column(f"h{i + 1}").to_numpy() for i in range(4)], axis=1)
                found = transform(part.column("text"), chosen)
                count = lambda x: pa.array(x, pa.int64(), mask=x < 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(found["n"], pa.int64()),
                        pa.array(found["form"].tolist(), pa.string()),
                        count(found["prefix"]),
                        count(found["middle"]),
                        found["output"],
                    ],
                    names,
                )

    schema = f"doc_id {type_of(docs, 'doc_id')}, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_batches(docs.select("doc_id", "text", *keys(docs["doc_id"])), work, schema)


def restored(made: DataFrame) -> DataFrame:
    """The rows with their `text`, rebuilt from `output` and `form`; all other columns are kept."""
    if "text" in made.columns:
        raise ValueError("the restored text needs the name `text`")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "output"):
                texts = restore(part.column("output"), np.array(part.column("form").to_pylist(), object))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, "text"])

    return map_batches(made, work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema) + ", text string")
