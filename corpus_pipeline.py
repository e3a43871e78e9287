"""Cleaning and tokenising a corpus: language, exact copies, near copies, benchmark passages, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as Parquet in the
shared folder and hands it on. All stages but the last keep the columns of the documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwise.llm import centroids, content_sort, minmax, trie_bpe, winnowing  # noqa: E402
from cartwise.llm.queries import WORD_BPE, token_digests  # noqa: E402
from cartwise.llm.shared import drop_table, table, write_table  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or far from all known languages go."""
    return centroids.drop_rejected(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest identifier."""
    return content_sort.drop_copies(docs, keep="smallest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, similarity 0.8."""
    return minmax.drop_near_duplicates(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row, or a whole shorter item, with the benchmark go."""
    return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded text, and the ids."""
    return token_digests(trie_bpe.encode_decode(docs, WORD_BPE), "ids")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: SQL can state neither the trained language model nor the tokenizer; tests/llm/test_pipeline.py holds the kept
#: documents of all stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's table is removed once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        made = write_table(stage(spark, docs, sf_dir), name)
        if number:
            drop_table(docs)
        docs = made
    return docs
