from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cartwise.llm import treap_search as T

from .conftest import keyed


def brute(docs, items, k=50):
    """The contract's ranking, one score after the other."""
    texts = [(i, T.terms_of(t)) for i, t in docs]
    texts = [(i, t) for i, t in texts if t]
    n_docs, length = len(texts), sum(len(t) for _, t in texts)
    df = Counter(x for _, t in texts for x in set(t))
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(T.terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, t in texts:
            tf, score = Counter(t), 0
            m = 100 - 50 + (50 * len(t) * n_docs) // length
            for x in terms & tf.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                score += w * ((1000000000 * tf[x]) // (1000 * tf[x] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort()
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(scored[:k])]
    return sorted(out, key=str)


def test_terms_are_the_pattern():
    import re

    pattern = re.compile(T.TERM)
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randint(0, 0x7F), rng.randint(0x80, 0x24F), 0x4E2D])) for _ in range(40))
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        assert [t.decode() for t in T.terms_of(text)] == pattern.findall(lowered)
    assert T.terms_of(None) == []


def test_terms_are_counted_like_they_are_split():
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "é", " ", "-", "9", "中"]) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    column = pa.array([None, "", *texts, None, "x"])
    assert T.term_counts(column).tolist() == [len(T.terms_of(t)) for t in column.to_pylist()]
    assert T.term_counts(column.slice(7, 100)).tolist() == [len(T.terms_of(t)) for t in column.slice(7, 100).to_pylist()]
    assert T.term_counts(pa.array([], pa.string())).tolist() == []


@pytest.mark.parametrize("seed", range(8))
def test_treap_gives_the_best_columns(seed):
    rng = np.random.default_rng(seed)
    n_rows, n_columns = int(rng.integers(1, 60)), int(rng.integers(1, 300))
    grid = rng.integers(1, 6, (n_rows, n_columns)) * (rng.random((n_rows, n_columns)) < rng.choice([0.02, 0.3, 1]))
    rows, columns = np.nonzero(grid)
    treap = T.Treap.build(rows, columns, grid[rows, columns])
    for _ in range(20):
        chosen = rng.permutation(n_rows)[: rng.integers(1, 9)]
        weights = rng.integers(1, 4, len(chosen))
        scores = weights @ grid[chosen]
        want = sorted((-int(s), c) for c, s in enumerate(scores) if s > 0)[:50]
        assert [(-s, c) for s, c in treap.best(chosen, weights, n_columns, 50)] == want
        least = int(rng.integers(1, max(scores) + 2))
        found = treap.best(chosen, weights, n_columns, 50, least)
        assert [(-s, c) for s, c in found] == [w for w in want if -w[0] >= least]


def test_parents_are_never_below_their_children():
    rng = np.random.default_rng(1)
    grid = rng.integers(0, 9, (40, 90))
    rows, columns = np.nonzero(grid)
    treap = T.Treap.build(rows, columns, grid[rows, columns])
    held = T._QUARTERS[treap.mask]
    parents = np.repeat(np.arange(len(treap.mask)), held)
    assert len(parents) == len(treap.mask) - 1
    assert (treap.most[parents] >= treap.most[1:]).all()


def test_same_ranks_as_brute_force(spark, awkward, monkeypatch):
    monkeypatch.setattr(T, "POINTS", 40)  # several shards
    items = [(1, "one brown fox"), (2, ""), (3, None), (4, "nowhere"), (4, "dale one"), (None, "über 中文 ale"), (5, "one")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    found = T.search(awkward.repartition(3), asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items)


def test_ties_go_to_the_lowest_identifiers_across_shards(spark, monkeypatch):
    monkeypatch.setattr(T, "POINTS", 30)
    monkeypatch.setattr(T, "BLOCK_BYTES", 16)  # several blocks of items
    monkeypatch.setattr(T, "SAMPLED", 3)
    rng = random.Random(3)
    docs = [(i, "alpha beta" if i % 3 else f"alpha w{rng.randint(0, 5)}") for i in range(400)]
    items = [(i, t) for i, t in enumerate(["alpha", "beta gamma", "w1 w2 beta", "w9", "alpha w0"])]
    found = T.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark, nothing, awkward):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert T.search(nothing, items).collect() == []
    assert T.search(awkward, items.limit(0)).collect() == []
    with pytest.raises(ValueError):
        T.search(awkward, items, k=0)


def test_fewer_results_on_request(spark, awkward):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert keyed(T.search(awkward, items, k=2).select("rank", "doc_id")) == [(1, 6), (2, 7)]
