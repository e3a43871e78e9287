from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from cartwise.llm import centroids
from cartwise.llm.shared import drop_table, table, write_table

FOLDER = os.environ.get("CARTWISE_TEST_DIR", "/root/testdata/sf0.001")


def test_stages_keep_columns_and_remove_what_they_decide(spark, awkward, tmp_path):
    passage = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    more = spark.createDataFrame(
        [(50, f"something before {passage} and after", "en"), (51, "1234 5678", "en")],
        "doc_id long, text string, lang string",
    )
    docs = awkward.unionByName(more, allowMissingColumns=True)
    left = {}
    for name, stage in P.STAGES:
        columns = docs.columns
        docs = write_table(stage(spark, docs, str(tmp_path)), name)
        left[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert name == P.STAGES[-1][0] or docs.columns == columns
    assert left["language_id"].isdisjoint({3, 4, 5, 8, 51}) and {1, 2, 6, 9, 50} <= left["language_id"]
    assert {12} <= left["exact_dedup"] and 13 not in left["exact_dedup"] and 7 not in left["exact_dedup"]
    assert 1 in left["near_dedup"] and left["near_dedup"].isdisjoint({2, 10})
    assert 50 not in left["decontamination"] and left["decontamination"] == left["near_dedup"] - {50}
    assert left["bpe"] == left["decontamination"]


def test_empty_documents(spark, nothing, tmp_path):
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = nothing
    for name, stage in P.STAGES:
        docs = write_table(stage(spark, docs, str(tmp_path)), name)
        assert docs.count() == 0


def lowered_words(text, pattern):
    return re.findall(pattern, bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def brute_stages(rows, items, model):
    """(identifiers left by each stage, digests of the last), one document after the other."""
    left, out = dict(rows), {}

    def kept(name, ids):
        for i in set(left) - set(ids):
            del left[i]
        out[name] = set(left)

    known = {i: t for i, t in left.items() if t is not None and any(c.isalpha() for c in t)}
    gone = model.score(list(known.values()))[2]
    kept("language_id", [i for i, g in zip(known, gone, strict=True) if not g])
    kept("exact_dedup", {t: i for i, t in sorted(left.items(), reverse=True)}.values())

    shingles = {}
    for i, t in left.items():
        words = lowered_words(t, rb"[^\x20\x09-\x0D]+")
        n = min(5, len(words))
        shingles[i] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if n else set()
    group = {i: i for i in left}
    ids = sorted(left)
    for a in ids:
        for b in ids:
            x, y = shingles[a], shingles[b]
            if a < b and x and 100 * len(x & y) >= 80 * len(x | y) and group[a] != group[b]:
                lo, hi = sorted((group[a], group[b]))
                group = {i: lo if g == hi else g for i, g in group.items()}
    kept("near_dedup", [i for i in ids if group[i] == i])

    pattern = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for _, text in items:
        words = lowered_words(text, pattern)
        n = min(10, len(words))
        windows |= {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if n else set()
    sizes = {len(w) for w in windows}

    def clean(text):
        words = lowered_words(text, pattern)
        return not any(tuple(words[j : j + n]) in windows for n in sizes for j in range(len(words) - n + 1))

    kept("decontamination", [i for i, t in left.items() if clean(t)])
    library = Tokenizer.from_file(P.WORD_BPE)
    digests = {}
    for i, t in left.items():
        found = library.encode(t, add_special_tokens=False).ids
        text = library.decode(found, skip_special_tokens=False)
        ids_digest = hashlib.sha256(np.array(found, "<u4").tobytes()).hexdigest()
        digests[i] = (len(found), ids_digest, hashlib.sha256(text.encode()).hexdigest())
    return out, digests


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_the_pipeline_equals_brute_force(spark):
    docs = table(spark, FOLDER, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    want, digests = brute_stages(rows, items, centroids.fit(docs))
    at = docs
    for name, stage in P.STAGES[:-1]:
        at = write_table(stage(spark, at, FOLDER), name)
        assert {r["doc_id"] for r in at.select("doc_id").collect()} == want[name], name
    assert len(want["decontamination"]) < len(want["near_dedup"]) < len(want["exact_dedup"]) < len(rows)
    made = P.run(spark, FOLDER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in made} == digests


def test_superseded_tables_are_removed(spark):
    kept, gone = (write_table(spark.range(3).toDF("doc_id"), name) for name in ("a", "b"))
    drop_table(gone)
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.schema("doc_id long").parquet(gone.inputFiles()[0]).count()
    drop_table(table(spark, FOLDER, "documents"))  # none of ours: nothing happens
    assert table(spark, FOLDER, "documents").count() > 0
