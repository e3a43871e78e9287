from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from cartwise.llm import content_sort as C

from .conftest import TEXTS


def brute(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    best = {t: keep([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    return sorted(
        ((i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows),
        key=str,
    )


@pytest.mark.parametrize(("name", "keep"), [("smallest", min), ("largest", max)])
def test_awkward_rows(awkward, name, keep):
    rows = C.mark_copies(awkward, name).collect()
    got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=str)
    assert got == brute(TEXTS, keep)
    kept = [r for r in rows if r["kept"]]
    assert len({r["text_sha256"] for r in rows}) == len(kept)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_a_group_of_a_third_of_all_rows(spark):
    docs = spark.range(3000).withColumn("text", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    docs = docs.select(F.col("id").alias("doc_id"), "text")
    rows = C.mark_copies(docs, "largest")
    hot = rows.where("group_size > 1")
    assert hot.count() == 1000 and rows.where("kept").count() == 2001
    assert [tuple(r) for r in hot.select("keep_id", "group_size").distinct().collect()] == [(2997, 1000)]


def test_input_columns_are_carried(awkward):
    out = C.drop_copies(awkward)
    assert out.columns == awkward.columns and out.count() == len({t or "" for _, t in TEXTS})


def test_normalisation(awkward):
    rows = C.mark_copies(awkward, "smallest", normalise=lambda t: F.lower(F.trim(t)))
    assert {r["doc_id"]: r["keep_id"] for r in rows.where("doc_id IN (1, 2)").collect()} == {1: 1, 2: 1}


def test_empty_table(nothing):
    assert C.mark_copies(nothing).collect() == []
