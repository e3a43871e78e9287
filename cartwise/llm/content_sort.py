"""Exact dedup by content sort.

Rows are range-partitioned by sampled splitters over the normalised text and sorted there, on disk if need
be, so that equal texts lie side by side; one pass over the sorted rows compares each full text with its
neighbour's and marks the row that stays. DataFrame operations only.

The sort key begins with a short prefix and a 64-bit hash of the text, so that the sampled splitters which
pass the driver stay small and most comparisons end early; the full text is the last part of the key and
decides equality. A group of copies above a quarter of a mean partition is cut into pieces, each sorted like
a group of its own; the pieces' first rows, fewer than eight per partition, are then compared in full.

Defined cases: a null text counts as empty; repeated rows are copies of each other and one of them stays;
a null id loses against any other; an empty table gives no rows; other columns are ignored or carried
unchanged inside one struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.shared import partitions, text_or_empty, write_table

PREFIX = 24  # characters of the text at the head of the sort key
PIECES = 4  # pieces of a hot group per mean partition


def _same(text: Column) -> Column:
    return text


def mark_copies(
    docs: DataFrame,
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = _same,
    carry: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 [, carried].

    `keep` names the identifier of a group that stays. With `carry`, all input columns travel along in the
    struct `carried`.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    spark = docs.sparkSession
    parts = partitions(spark)
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        normalise(text_or_empty()).alias("norm"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("carried")] if carry else []),
    ).withColumn("h", F.xxhash64("norm"))

    # Hot groups: at most parts * PIECES hashes can lie above the mean share, so broadcasting them is bounded.
    total = docs.count()
    share = max(1.0, total / (parts * PIECES))
    hot = (
        rows.groupBy("h")
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > share)
        .select("h", F.ceil(F.col("copies") / F.lit(share)).cast("int").alias("pieces"))
    )
    spread = rows.join(F.broadcast(hot), "h", "left").select(
        *rows.columns,
        F.col("pieces").isNotNull().alias("hot"),
        F.coalesce(F.pmod(F.xxhash64("doc_id"), "pieces"), F.lit(0)).cast("int").alias("piece"),
        F.substring("norm", 1, PREFIX).alias("prefix"),
    )

    best_first = F.col("doc_id").asc_nulls_last() if keep == "smallest" else F.col("doc_id").desc_nulls_last()
    neighbours = Window.partitionBy("prefix", "h", "piece", "norm").orderBy(best_first)
    whole = neighbours.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = (
        spread.repartitionByRange(parts, "prefix", "h", "piece")
        .withColumn("best", F.first("doc_id").over(whole))
        .withColumn("n", F.count("*").over(whole))
        .withColumn("place", F.row_number().over(neighbours))
        .select(
            "doc_id",
            "best",
            "n",
            "place",
            "hot",
            "piece",
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            F.when(F.col("hot") & (F.col("place") == 1), F.col("norm")).alias("rep"),
            *(["carried"] if carry else []),
        )
    )
    marked = write_table(marked, "marked")

    # The pieces of each hot text, by their first rows.
    of_text = Window.partitionBy("rep")
    choose = F.min if keep == "smallest" else F.max
    merged = marked.where(F.col("rep").isNotNull()).select(
        "text_sha256",
        "piece",
        choose("best").over(of_text).alias("group_best"),
        F.sum("n").over(of_text).alias("group_n"),
        F.first("piece")
        .over(
            of_text.orderBy(
                F.col("best").asc_nulls_last() if keep == "smallest" else F.col("best").desc_nulls_last(), "piece"
            ).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        )
        .alias("group_piece"),
    )
    out = marked.join(F.broadcast(merged), ["text_sha256", "piece"], "left")
    return out.select(
        "doc_id",
        F.when(F.col("hot"), F.col("group_best")).otherwise(F.col("best")).alias("keep_id"),
        F.when(F.col("hot"), F.col("group_n")).otherwise(F.col("n")).cast("long").alias("group_size"),
        ((F.col("place") == 1) & (~F.col("hot") | (F.col("piece") == F.col("group_piece")))).alias("kept"),
        "text_sha256",
        *(["carried"] if carry else []),
    )


def drop_copies(
    docs: DataFrame, keep: str = "smallest", normalise: Callable[[Column], Column] = _same
) -> DataFrame:
    """The rows that stay, with the columns of the input."""
    return mark_copies(docs, keep, normalise, carry=True).where("kept").select("carried.*")
