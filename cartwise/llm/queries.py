"""The registered queries of the corpus operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import (
    centroids,
    content_sort,
    crf_pii,
    displacement,
    host_paths,
    licence_rules,
    minmax,
    sharding,
    simple8b,
    treap_search,
    trie_bpe,
    warc_chunks,
    winnowing,
)
from cartwise.llm.shared import table

SHARDS = 24
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by virtual slots; law `bytes`."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )


def op2_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents; the largest identifier stays."""
    return content_sort.mark_copies(table(spark, sf_dir, "documents"), keep="largest")


def token_digests(coded: DataFrame, *more: str) -> DataFrame:
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *more,
    )


def op3_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document to BPE ids and back."""
    return token_digests(trie_bpe.encode_decode(table(spark, sf_dir, "documents"), WORD_BPE))


def op4_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base patterns and what the trained chain adds."""
    found = crf_pii.find_pii(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in crf_pii.BASE_KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op5_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document in Simple-8b files, read back from them."""
    folder, manifest = simple8b.write_ids(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)
    return simple8b.read_ids(spark, folder, manifest)


def op6_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, similarity 0.85."""
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op7_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document by sentence rules."""
    return licence_rules.scan_licences(table(spark, sf_dir, "documents"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside 10-word windows of benchmark items."""
    found = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; every fifth document by checksum is held out of the training."""
    docs = table(spark, sf_dir, "documents")
    found = centroids.identify(docs, centroids.fit(docs))
    return found.select("doc_id", centroids.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op10_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back from the archives."""
    folder, manifest = warc_chunks.write_archives(table(spark, sf_dir, "pages"))
    return warc_chunks.records(warc_chunks.read_chunks(spark, folder, manifest, with_data=False))


def op11_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its host's winning paths."""
    return host_paths.main_text(table(spark, sf_dir, "pages"))


def op12_displacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in fill-in-middle form, and restored from it."""
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    made = displacement.fill_in_middle(table(spark, sf_dir, "documents"))
    return displacement.restored(made.withColumn("output_sha256", digest("output"))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", digest("text").alias("restored_sha256")
    )


def op13_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for each benchmark item."""
    return treap_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP2_SQL = """
SELECT doc_id,
    max(doc_id) OVER g AS keep_id,
    count(*) OVER g AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
    sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW g AS (PARTITION BY t)"""

_NUMBER = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
OP12_SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), c AS (
    SELECT *, least({_NUMBER.format(1)} % (n + 1), {_NUMBER.format(9)} % (n + 1)) AS lo,
        greatest({_NUMBER.format(1)} % (n + 1), {_NUMBER.format(9)} % (n + 1)) AS hi,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR {_NUMBER.format(17)} % 100 >= 90 THEN 'plain'
            WHEN {_NUMBER.format(25)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM d
), p AS (
    SELECT *, substr(t, 1, lo) AS prefix, substr(t, lo + 1, hi - lo) AS middle, substr(t, hi + 1) AS suffix FROM c
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p"""

_TERMS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{treap_search.TERM}')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS all_docs, sum(len(ts)) AS all_terms FROM d WHERE len(ts) > 0),
t AS (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d),
tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM t GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
w AS (
    SELECT item_id, term, CAST(floor(1000 * ln(CAST(2 * all_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
    FROM q JOIN df USING (term), s
), scored AS (
    SELECT item_id, r, any_value(doc_id) AS doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * all_docs) // all_terms))))) AS BIGINT)
            AS score
    FROM w JOIN tf USING (term), s GROUP BY item_id, r
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_virtual_slots,
            op2_content_sort,
            op3_trie_bpe,
            op4_crf_pii,
            op5_simple8b,
            op6_minmax,
            op7_licence_rules,
            op8_winnowing,
            op9_centroids,
            op10_warc_chunks,
            op11_host_paths,
            op12_displacement,
            op13_treap_search,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_content_sort": OP2_SQL,
        "op7_licence_rules": licence_rules.oracle(),
        "op12_displacement": OP12_SQL,
        "op13_treap_search": OP13_SQL,
    }
