from __future__ import annotations

import random
import re

import numpy as np
import pytest

from cartwise.llm import minmax as M

from .conftest import TEXTS


def brute(rows, size, percent):
    """(doc_id, set size, component) by comparing everything with everything."""
    sets = []
    for _, text in rows:
        words = [w for w in re.split(rb"[ \t-\r]+", (text or "").encode().lower()) if w]
        k = min(size, len(words))
        sets.append({tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if words else set())
    label = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                    continue
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return sorted(((i, len(s), c) for (i, _), s, c in zip(rows, sets, label, strict=True)), key=str)


def test_set_values_and_signature_estimate_similarity():
    rng = random.Random(2)
    words = [str(rng.random()) for _ in range(4000)]
    a = M.Shingler(3).set_of(" ".join(words))
    b = M.Shingler(3).set_of(" ".join(words[:3600]))
    true = len(set(a) & set(b)) / len(set(a) | set(b))
    assert abs(float(np.mean(M.signature(a) == M.signature(b))) - true) < 0.1


def edited(rng, base, edits):
    words = list(base)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_chains_and_groups_of_copies(spark, size, percent):
    rng = random.Random(7)
    rows, base = [], [f"w{i}" for i in range(120)]
    for i in range(60):  # copies at about the threshold: links without a common pivot
        rows.append((100 + i, edited(rng, base, rng.randint(0, 4))))
    chain = [f"c{i}" for i in range(200)]
    for i in range(12):
        rows.append((300 + i, " ".join(chain[2 * i : 2 * i + 120])))
    rows += [(400 + i, f"word{i} other{i} more{i} text{i}") for i in range(30)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = M.near_duplicates(docs, size, percent).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == brute(rows, size, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_awkward_rows(awkward):
    rows = [(i, t) for i, t in TEXTS if i is not None]
    got = M.near_duplicates(awkward.where("doc_id IS NOT NULL"), 3, 85).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == brute(rows, 3, 85)
    out = M.drop_near_duplicates(awkward)
    assert out.columns == awkward.columns
    kept = {r["doc_id"] for r in out.collect()}
    assert kept == {None, 1, 3, 4, 5, 6, 8, 9, 11, 12}


def test_empty_table(nothing):
    assert M.near_duplicates(nothing).collect() == []


def test_label_rounds_read_written_tables_and_broadcast_nothing(spark, monkeypatch):
    """The driver's memory: a round's plan has one join at most, and no join of small tables is broadcast."""
    plans, write = [], M.write_table

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(M, "write_table", watched)
    chain = [(i, i + 1) for i in range(1, 12)] + [(20, 22), (21, 22)]
    got = M.components(write(spark.createDataFrame(chain, "a long, b long"), "links"))
    assert sorted(map(tuple, got.collect())) == [(i, 1) for i in range(1, 13)] + [(20, 20), (21, 20), (22, 20)]
    assert all(len(re.findall(r"Join ", p)) <= 1 and "Broadcast" not in p for _, p in plans), plans

    plans.clear()
    more = write(spark.createDataFrame([(5, 21), (30, 31)], "a long, b long"), "links")
    again = M._joined_components(got, more)
    want = [(i, 1) for i in [*range(1, 13), 20, 21, 22]] + [(30, 30), (31, 30)]
    assert sorted(map(tuple, again.collect())) == want
    assert plans and all("Broadcast" not in p for _, p in plans), plans

    plans.clear()
    same = M._joined_components(again, more.limit(0))
    assert sorted(map(tuple, same.collect())) == want and not plans
