from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cartwise.llm import simple8b as S

from .conftest import TEXTS

FILE = public_tokenizers.path("byte_bpe_50k.json")


def test_packing_round_trip():
    rng = np.random.default_rng(4)
    cases = [[], [0], [2**59], [2**60], [2**64 - 1, 0, 5], [0] * 5000, [2**63] * 3000]
    for _ in range(40):
        widths = rng.integers(0, 63, rng.integers(1, 4000))
        cases.append([int(rng.integers(0, 2**62)) >> int(62 - w) for w in widths])
    for ids in cases:
        ids = np.array(ids, np.uint64)
        words, words_of = S.pack(ids)
        assert (S.unpack(words, words_of, len(ids)) == ids).all()


def test_small_ids_are_dense():
    words, _ = S.pack(np.ones(60 * 1024, np.uint64))
    assert len(words) == 60 * -(-1024 // 60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    with open(FILE, encoding="utf-8") as f:
        return S.PieceEncoder(f.read())


def same(encoder, library, given):
    ids, counts = encoder.run(pa.array(given, pa.string()))
    for text, found in zip(given, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert found.tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_pieces_encode_like_whole_texts(encoder, library):
    given = ["\n\n a  b \n", "x<|endoftext|>y \n<|endoftext|>", "a\x85 b\xa0c d", "it's  we'll 12 34!!  \t\n", ""]
    same(encoder, library, given)
    same(encoder, library, ["'s", "'s't're", "a'll'd", "!'s 's  's\t's", "''s", "9'm'", "l", "'l", "'", None, "ve", "\n'veil"])


def test_random_texts_encode_like_whole_texts(encoder, library):
    rng = random.Random(8)
    letters = ["a", "B", "é", "'", "s", "'ll", "'re", "ve", " ", " ", "  ", "9", "²", "!", "—", "\n", "\t", "\r\n", "_"]
    odd = ["\xa0", "\x1c", "\x85", "\u2003", "ª", "中", "İ", "\u0301", "😀", "<|endoftext|>", "\x00"]
    for more in ([], odd):
        chosen = letters + more
        same(encoder, library, ["".join(rng.choice(chosen) for _ in range(rng.randint(0, 15))) for _ in range(4000)])


def test_all_characters_around_letters_and_digits(encoder, library):
    same(encoder, library, [f"a{chr(i)}b {chr(i)}1" for i in range(0x3100)])


def test_kept_pieces_are_dropped_when_there_are_too_many(library, monkeypatch):
    monkeypatch.setattr(S, "KEPT_PIECES", 3)
    with open(FILE, encoding="utf-8") as f:
        encoder = S.PieceEncoder(f.read())
    for text in ("one two three", "four five", "six one two seven", "one"):
        same(encoder, library, [text, "two"])


@pytest.mark.parametrize("docs", ["awkward", "nothing"])
def test_files_hold_all_documents_in_order(spark, docs, request, library):
    df = request.getfixturevalue(docs)
    folder, manifest = S.write_ids(df, FILE, end_id=2)
    rows = sorted(S.read_ids(spark, folder, manifest).collect(), key=lambda r: r["start"])
    given = TEXTS if docs == "awkward" else []
    assert len(rows) == len(given)
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in given), key=lambda i: (i is not None, i))
    at, left = 0, []
    for i, t in given:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        left.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        left.remove((r["doc_id"], r["n_tokens"], r["ids_crc32"]))
    assert not left
