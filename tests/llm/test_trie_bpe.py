from __future__ import annotations

import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartwise.llm import trie_bpe as T

from .conftest import TEXTS

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def codec():
    with open(FILE, encoding="utf-8") as f:
        return T.TextCodec(f.read())


def texts():
    rng = random.Random(5)
    near = "abcdefghinorstéñß'.,0 \n"
    yield from ["", " ", "aaaaaaaaaaa aaaa", "Hi<|endoftext|>you <|startoftext|> x", "İ ΣΑΣ ΟΔΟΣ", "don't I'Ll 'S"]
    yield from ["a\x85z\x1cq\xa0b", "한국어 हिन्दी 😀👍🏽", "ªºµ²½ ⅷ ١٢٣", "ab" * 300, "!" * 99, "\u0000 é"]
    for _ in range(400):
        yield "".join(rng.choice(near) for _ in range(rng.randint(1, 60)))
    for _ in range(100):
        yield "".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0xD7FF)])) for _ in range(30))


def test_same_ids_and_text_as_the_library(codec, library):
    given = list(texts())
    ids, decoded = codec.run(given)
    for text, i, d in zip(given, ids, decoded, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert struct.unpack(f"<{len(i) // 4}I", i) == tuple(want), text
        assert d == library.decode(want, skip_special_tokens=False), text


def test_full_caches_change_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(T, "KEPT_WORDS", 5)
    monkeypatch.setattr(T, "KEPT_PAIRS", 5)
    test_same_ids_and_text_as_the_library(codec, library)


def test_awkward_rows(awkward, library):
    rows = T.encode_decode(awkward, FILE).collect()
    want = sorted(
        (str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in TEXTS
    )
    got = sorted((str(r["doc_id"]), list(struct.unpack(f"<{r['n_tokens']}I", r["ids"]))) for r in rows)
    assert got == want


def test_empty_table(nothing):
    assert T.encode_decode(nothing, FILE).collect() == []
