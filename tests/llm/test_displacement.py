from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from cartwise.llm import displacement as D

from .conftest import keyed


def numbers(doc_id):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def brute(doc_id, text):
    text, (h1, h2, h3, h4) = text or "", numbers(doc_id)
    n = len(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("window", [1, 3, 7, 1 << 20])
def test_scatter_and_gather(monkeypatch, window):
    monkeypatch.setattr(D, "WINDOW", window)
    rng = random.Random(window)
    for round_ in range(12):
        letters = ["a", "é", "中", "😀", "<", "P", "S", "M", ">", "S>", "\n"] + ["<P>"] * (round_ % 3 == 0)
        rows = [
            (rng.randint(0, 10**9), "".join(rng.choice(letters) for _ in range(rng.randint(0, 12))))
            for _ in range(rng.randint(0, 60))
        ]
        column = pa.array([t for _, t in rows], pa.string())
        if len(rows) > 5:
            column, rows = column.slice(2), rows[2:]
        found = D.transform(column, np.array([numbers(i) for i, _ in rows], np.int64).reshape(-1, 4))
        hide = lambda x: None if x < 0 else x
        got = zip(
            found["n"].tolist(),
            found["form"].tolist(),
            map(hide, found["prefix"].tolist()),
            map(hide, found["middle"].tolist()),
            found["output"].to_pylist(),
            strict=True,
        )
        assert list(got) == [brute(*r) for r in rows]
        back = D.restore(found["output"], np.array(found["form"].tolist(), object))
        assert back.to_pylist() == [t for _, t in rows]


def test_outputs_without_their_sentinels_are_refused():
    for output in ("<P>a<S>b", "<S>a<P>b<M>c", "<M>a<S>b<P>c"):
        with pytest.raises(ValueError):
            D.restore(pa.array([output]), np.array([D.PSM], object))


def test_awkward_rows(awkward):
    found = D.restored(D.fill_in_middle(awkward))
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "text"]
    want = [(r["doc_id"], *brute(r["doc_id"], r["text"]), r["text"] or "") for r in awkward.collect()]
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert keyed(found) == sorted(want, key=key)


def test_empty_table_and_text_identifiers(spark, nothing):
    assert D.restored(D.fill_in_middle(nothing)).collect() == []
    rows = [("a", "hello world"), ("b", "<P>"), ("c", "x" * 50)]
    found = D.fill_in_middle(spark.createDataFrame(rows, "doc_id string, text string"))
    assert keyed(found) == sorted((i, *brute(i, t)) for i, t in rows)
