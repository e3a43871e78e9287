from __future__ import annotations

import random
import re

import numpy as np

from cartwise.llm import winnowing as W


def words_of(text):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(10, len(words))
        for j in range(len(words) - n + 1 if n else 0):
            # An item without identifier marks words and is not reported.
            windows.setdefault(tuple(words[j : j + n]), set()).update(() if item is None else (str(item),))
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for j in range(len(words) - n + 1):
                if tuple(words[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(words[j : j + n])]
        out.append((doc, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in W.decontaminate(d, i).collect()), key=str)


def test_every_shared_span_of_ten_words_is_found(spark):
    rng = random.Random(3)
    some = lambda n, signs: " ".join(rng.choice(signs) for _ in range(n))
    items = [(i, some(rng.randint(0, 14), "abc")) for i in range(8)] + [(20 + i, some(25, "defgh")) for i in range(4)]
    items += [(50, "q " * 30), (51, None), (52, ""), (None, "x y z"), (53, "x y z w v"), (53, "x y z w v")]
    docs = [(i, some(rng.randint(0, 60), "abc")) for i in range(60)]
    docs += [(100 + i, some(9, "xyz") + " " + items[8 + i % 4][1][i : i + 23] + " end") for i in range(20)]
    docs += [(900, "q " * 5000), (901, None), (902, "X y-z W v!x y z w v"), (903, "")]
    assert run(spark, docs, items) == brute(docs, items)


def test_winnowing_keeps_a_hash_of_every_window():
    hashes = np.random.default_rng(1).integers(0, 50, 400).astype(np.uint64)
    kept = set(W.winnow(hashes, 6).tolist())
    for start in range(395):
        window = hashes[start : start + 6]
        assert {start + j for j in np.flatnonzero(window == window.min())} <= kept


def test_awkward_rows(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = {(r["doc_id"], r["n_hit"]) for r in W.decontaminate(awkward, items).collect() if r["n_hit"]}
    assert rows == {(1, 3), (2, 3)}
    out = W.drop_contaminated(awkward, items)
    assert out.columns == awkward.columns and out.count() == awkward.count() - 2
    assert W.decontaminate(nothing, items).collect() == []
    assert W.decontaminate(awkward, items.limit(0)).where("n_hit > 0").collect() == []


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def test_rows_are_told_apart_whatever_their_identifiers(spark):
    rows = [(1, PASSAGE), (1, "a clean text"), (None, PASSAGE), (None, "another clean one"), (2, PASSAGE), (2, PASSAGE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, PASSAGE)], "item_id long, text string")
    found = sorted(((r["doc_id"] or 0), r["n_words"], r["n_hit"], r["items"]) for r in W.decontaminate(docs, items).collect())
    clean = [(0, 3, 0, []), (1, 3, 0, [])]
    assert found == sorted([*clean, (0, 12, 12, ["7"]), (1, 12, 12, ["7"]), (2, 12, 12, ["7"]), (2, 12, 12, ["7"])])
    kept = W.drop_contaminated(docs, items)
    assert sorted(r["text"] for r in kept.collect()) == ["a clean text", "another clean one"]


def test_identifiers_of_any_type_and_items_without_one(spark):
    docs = spark.createDataFrame([("x", PASSAGE), ("y", "a clean text")], "doc_id string, text string")
    items = spark.createDataFrame([(None, PASSAGE)], "item_id long, text string")
    found = {r["doc_id"]: (r["n_hit"], r["items"]) for r in W.decontaminate(docs, items).collect()}
    assert found == {"x": (12, []), "y": (0, [])}
    assert [r["doc_id"] for r in W.drop_contaminated(docs, items).collect()] == ["y"]
