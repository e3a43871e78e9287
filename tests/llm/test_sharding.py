from __future__ import annotations

import zlib

from cartwise.llm import sharding as S

from .conftest import TEXTS


def test_every_row_gets_a_shard_and_a_gapless_place(awkward):
    rows = S.shard(awkward, 3).collect()
    assert len(rows) == len(TEXTS)
    for shard in range(3):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(
            range(sum(r["shard"] == shard for r in rows))
        )
    by_id = {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows}
    assert by_id == {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in TEXTS}


def test_empty_table(nothing):
    assert S.shard(nothing, 3).collect() == []


def test_sizes_are_near_equal(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', cast(id % 97 AS int)) AS text")
    sizes = {r["shard"]: r["total"] for r in S.shard(docs, 24).groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "total").collect()}
    assert len(sizes) == 24 and max(sizes.values()) <= 1.02 * min(sizes.values())


def _loads(sizes):
    return [S.SlotLoad(i, s, 1) for i, s in enumerate(sizes)]


def test_growing_moves_slots_into_the_new_shard_only():
    before = S.first_map(_loads([10 + i % 7 for i in range(400)]), 7)
    after = S.grow(before)
    assert after.version == before.version + 1 and after.shards == 8
    assert all(after.owner[s] == 7 for s in S.moved(before, after))
    total = after.shard_bytes()
    assert max(total) <= 1.05 * min(total)


def test_rebalancing_moves_few_slots():
    before = S.first_map(_loads([10] * 400), 8)
    loads = _loads([10 + 30 * (before.owner[i] == 0 and i % 3 == 0) for i in range(400)])
    after = S.rebalance(before, loads, 0.02)
    total, mean = after.shard_bytes(), sum(x.bytes for x in loads) / 8
    assert all(abs(t - mean) <= 0.03 * mean for t in total)
    assert 0 < len(list(S.moved(before, after))) < 60


def test_versions_are_kept(spark, tmp_path):
    first = S.first_map(_loads([5, 4, 3, 2]), 2)
    second = S.grow(first)
    for m in (first, second):
        S.save_map(spark, str(tmp_path), m)
    for m in (first, second):
        rows = S.load_map(spark, str(tmp_path), m.version).orderBy("virtual_slot").collect()
        assert [r["shard"] for r in rows] == list(m.owner)
