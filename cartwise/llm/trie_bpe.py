"""BPE encoding and decoding by prefix-sharing trie traversal.

In BPE the encoding of a prefix followed by its last token determines the encoding of every longer prefix:
the last token of a prefix is the one token that ends there, starts where some shorter prefix ends, and that
merges would not have joined otherwise with that shorter prefix's last token. So it is enough to know one
token per prefix. The distinct words of a batch form a trie, a depth-first walk over it gives each node its
last token from the nodes above it, and words that share a prefix share that work; sorted words are the paths
of that walk in order, so only the current path is held. Which tokens end at a node follows from the longest
token prefix that ends there, the walk's state. An encoding is read off by following last tokens upwards.

Each task works on its own rows; words met before are kept in two bounded generations of a cache, so that
memory does not grow with the corpus and nothing is shuffled.

Defined cases: null and empty texts give no tokens and an empty decoded text; repeated rows give repeated
results; an empty table gives no rows; other columns are ignored. The special tokens' strings in a text
become the special tokens, as in the tokenizers library.
"""

from __future__ import annotations

import contextlib
import functools
import json
import re
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartwise.llm.shared import map_batches, slices, steady_objects, type_of

END = "</w>"
NEVER = 1 << 60
KEPT_WORDS = 120_000  # words per cache generation
PART_BYTES = 1 << 20  # text that is split into words at a time
KEPT_PAIRS = 200_000


class TrieBpe:
    """Encoder of one vocabulary. Words are strings of byte-level symbols; the last one takes END."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.ids = vocab
        self.names = {i: t for t, i in vocab.items()}
        self.rank: dict[int, int] = {}  # left * base + right -> rank of the merge
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> left, right, rank
        self.base = max(vocab.values()) + 1
        for rank, (left, right) in enumerate(merges):
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.rank[a * self.base + b] = rank
            self.parts.setdefault(whole, (a, b, rank))
        plain = {t: i for t, i in vocab.items() if not t.endswith(END) or t == END}
        ending = {t[: -len(END)]: i for t, i in vocab.items() if t.endswith(END) and t != END}
        # By suffix, for inner nodes and for word ends; tokens that no merge can reach never occur.
        self.inner = {t: i for t, i in plain.items() if self._reachable(i)}
        self.final = {t: i for t, i in ending.items() if self._reachable(i)}
        # Prefixes of all tokens: the longest one that ends a path is the walk's state there.
        self.starts = {t[:n] for t in [*self.inner, *self.final] for n in range(1, len(t) + 1)}
        self.length = {i: len(t) for t, i in [*plain.items(), *ending.items()]}
        self._spines: tuple[dict, dict] = ({}, {})
        self._fits: dict[int, bool] = {}
        self._moves: dict[str, tuple[str, list[tuple[int, int]]]] = {}
        self._ends: dict[str, list[tuple[int, int]]] = {}

    def _reachable(self, token: int) -> bool:
        """Whether BPE of the token's own string gives just that token."""
        if token not in self.parts:
            return True
        symbols, stack = [], [token]
        while stack:
            t = stack.pop()
            if t in self.parts:
                a, b, _ = self.parts[t]
                stack += [b, a]
            else:
                symbols.append(t)
        return self._merge(symbols) == [token]

    def _merge(self, symbols: list[int]) -> list[int]:
        """BPE by its definition: again and again the leftmost pair of the lowest rank."""
        whole = {r: t for t, (_, _, r) in self.parts.items()} if not hasattr(self, "_whole") else self._whole
        self._whole = whole
        symbols = list(symbols)
        while len(symbols) > 1:
            ranks = [self.rank.get(a * self.base + b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == NEVER:
                break
            symbols[at : at + 2] = [whole[ranks[at]]]
        return symbols

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The token and its first (side 0) or last (side 1) parts, each with the rank of the merge that ends it."""
        known = self._spines[side]
        if token not in known:
            spine, until, t = [(token, NEVER)], NEVER, token
            while t in self.parts:
                until, t = self.parts[t][2], self.parts[t][side]
                spine.append((t, until))
            known[token] = spine
        return known[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are side by side: no parts that touch at their border would
        have merged before the merges that use those parts up. At equal rank the leftmost pair is first."""
        key = left * self.base + right
        found = self._fits.get(key)
        if found is None:
            rank, base, found = self.rank, self.base, True
            for a, a_until in self._spine(left, 1):
                for b, b_until in self._spine(right, 0):
                    r = rank.get(a * base + b)
                    if r is not None and r < a_until and r <= b_until:
                        found = False
            if len(self._fits) >= KEPT_PAIRS:
                self._fits.clear()
            self._fits[key] = found
        return found

    def forget(self) -> None:
        for learned in (self._moves, self._ends, self._fits, *self._spines):
            learned.clear()

    def _move(self, path: str) -> tuple[str, list[tuple[int, int]]]:
        """State after a state and one more symbol, and the inner tokens that end there, the longest first."""
        state = path
        while state and state not in self.starts:
            state = state[1:]
        if len(self._moves) >= KEPT_PAIRS:
            self._moves.clear()
        found = self._moves[path] = state, self._tokens(state, self.inner)
        return found

    def _end(self, path: str) -> list[tuple[int, int]]:
        """Tokens that end a word, by the state before its last symbol and that symbol."""
        if len(self._ends) >= KEPT_PAIRS:
            self._ends.clear()
        found = self._ends[path] = self._tokens(path, self.final)
        return found

    @staticmethod
    def _tokens(path: str, tokens: dict[str, int]) -> list[tuple[int, int]]:
        """(size, token) of the suffixes of the path that are tokens, the longest first."""
        return [(len(path) - i, tokens[path[i:]]) for i in range(len(path)) if path[i:] in tokens]

    def encode(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Tokens of each distinct word. In sorted order the words are a trie's paths, depth first: a path
        branches off the one before it, whose last tokens and states up to there are still in place."""
        words = sorted(words)
        fits, moves, ends, length, base = self._fits, self._moves, self._ends, self.length, self.base
        room = max(map(len, words), default=0) + 1
        last, states = [0] * room, [""] * room  # of the walk's prefix of d symbols
        out: dict[str, list[int]] = {}
        trunk = ""
        for word in words:
            stem, depth = word[:-1], 0
            for a, b in zip(stem, trunk, strict=False):
                if a != b:
                    break
                depth += 1
            trunk, state = stem, states[depth]
            for symbol in stem[depth:]:
                depth += 1
                path = state + symbol
                state, tokens = moves.get(path) or self._move(path)
                for size, token in tokens:
                    if size == depth:
                        break
                    before = last[depth - size]
                    good = fits.get(before * base + token)
                    if good or good is None and self.fits(before, token):
                        break
                else:
                    raise ValueError(f"no token ends {path!r}")
                last[depth], states[depth] = token, state
            path = state + word[-1]
            for size, token in ends.get(path) or self._end(path):
                if size > depth:
                    break
                before = last[depth + 1 - size]
                good = fits.get(before * base + token)
                if good or good is None and self.fits(before, token):
                    break
            else:
                raise ValueError(f"no token ends {word!r}")
            at = depth + 1 - size
            found = [token]
            while at:
                token = last[at]
                found.append(token)
                at -= length[token]
            found.reverse()
            out[word] = found
        return out


# White space and letters for which the short way below equals the tokenizer's own rules.
CHUNK = re.compile("[^ \t\n\r\x0b\x0c]+")
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
COMMON = re.compile("[!-~À-ÖØ-öø-ÿ]+")
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


class TextCodec:
    """Texts to ids and back, for a vocabulary with word ends, by cached chunks between white space."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        model = json.loads(spec)
        self.bpe = TrieBpe(model["model"]["vocab"], [tuple(m) for m in model["model"]["merges"]])
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        tokenizer = Tokenizer.from_str(spec)
        self.normalise, self.pre_tokenise = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self.symbols = str.maketrans({chr(b): s for b, s in enumerate(byte_symbols())})
        names = {**self.bpe.names, **{i: t for t, i in self.special.items()}}
        self.names = np.array([names.get(i, "") for i in range(max(names) + 1)], object)
        self.ids_of: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.words: dict[str, list[int]] = {}

    def _pieces(self, chunk: str) -> list[str]:
        if COMMON.fullmatch(chunk):
            found = SPLIT.findall(chunk.lower())
            if chunk.isascii():
                return found
            return [p.encode().decode("latin-1").translate(self.symbols) for p in found]
        return [p for p, _ in self.pre_tokenise(self.normalise(chunk))]

    def _learn(self, chunks: Iterable[str]) -> None:
        """Puts chunks that are not there into the young generation."""
        ids_of, old, words = self.ids_of, self.old, self.words
        missing = []
        for c in chunks:
            ids = old.get(c)
            if ids is None:
                missing.append((c, self._pieces(c)))
            else:
                ids_of[c] = ids
        words.update(self.bpe.encode({p for _, pieces in missing for p in pieces if p not in words}))
        for c, pieces in missing:
            ids_of[c] = array("I", [i for p in pieces for i in words[p]]).tobytes()

    def run(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Little-endian 32-bit ids and the decoded text of each text."""
        split = [self._chunks(t) for t in texts]
        if len(self.ids_of) > KEPT_WORDS:
            self.old, self.ids_of = self.ids_of, {}
        if len(self.words) > KEPT_WORDS:
            self.words = {}
        for s, i in self.special.items():
            self.ids_of[s] = struct.pack("<I", i)
        self._learn(set().union(*split).difference(self.ids_of))
        ids = [b"".join(map(self.ids_of.__getitem__, chunks)) for chunks in split]
        return ids, list(map(self.decode, ids))

    def close(self) -> None:
        """Drops the words met so far and what was learned of their paths; the vocabulary stays."""
        self.ids_of, self.old, self.words = {}, {}, {}
        self.bpe.forget()

    def _chunks(self, text: str) -> list[str]:
        if self.special_at is None or "<" not in text or not self.special_at.search(text):
            return text.split() if not OTHER_SPACE.search(text) else CHUNK.findall(text)
        out: list[str] = []
        for part in self.special_at.split(text):
            out += [part] if part in self.special else CHUNK.findall(part)
        return out

    def decode(self, ids: bytes) -> str:
        """Text of little-endian 32-bit ids."""
        return " ".join(self.names[np.frombuffer(ids, "<u4")].tolist())


@functools.lru_cache(maxsize=2)
def _codec(spec: str) -> TextCodec:
    return TextCodec(spec)


def encode_decode(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), n_tokens, decoded. The vocabulary file is read by the
    driver and sent to the executors; its size does not depend on the corpus."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "ids", "n_tokens", "decoded"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        with steady_objects(), contextlib.closing(codec):  # a worker lives on for other tasks
            for batch in batches:
                for part in slices(batch, limit=PART_BYTES):
                    ids, texts = codec.run([t or "" for t in part.column("text").to_pylist()])
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id"),
                            pa.array(ids, pa.binary()),
                            pa.array([len(x) // 4 for x in ids], pa.int64()),
                            pa.array(texts, pa.string()),
                        ],
                        names,
                    )

    return map_batches(
        docs.select("doc_id", "text"),
        work,
        f"doc_id {type_of(docs, 'doc_id')}, ids binary, n_tokens long, decoded string",
    )
