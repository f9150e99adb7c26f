"""Exact dedup by a heavy-hitter split, DataFrame functions only.

1. Every text is reduced to the SHA-256 of itself without white space.
2. A Misra-Gries summary (Spark's ``approx_top_k`` sketch, the Misra-Gries
   variant of Anderson et al. 2017) of the digests is built per group of
   partitions and merged, so no task sees more than ``FAN_IN`` summaries.
3. The summary's candidates are verified: an exact count and the winning row
   per candidate, by an aggregate with at most ``HEAVY_MOST`` groups.
4. The verified winners (at most ``HEAVY_MOST`` rows of about 100 bytes) are
   broadcast; copies of a heavy digest are settled map-side, without a shuffle.
5. All other digests go through ordinary shuffles: count and winner per digest, by partial
   sums, then the rows meet the digests that occur more than once. So a digest just
   below the share, or one that the summary misses, is a row per task in the first and, as
   a join on one row, split by AQE in the second. It is only slower, never wrong.

Of equal texts the row with the most code points stays, then the smallest
doc_id (null last), then the smallest hash of its text, then any of the
repeated rows. A null text counts as empty. Very long texts are hashed whole, where they
are read. An empty table gives an empty result. Other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.common import fresh, stored, text_or_empty

WHITE = " \t\n\x0b\x0c\r"
#: Counters of one Misra-Gries summary and most heavy digests to broadcast.
COUNTERS = 2048
HEAVY_MOST = 256
#: A digest is heavy from this share of all rows.
HEAVY_SHARE = 0.001
#: Summaries are merged in this many groups first.
FAN_IN = 64


def digest(column: str = "text") -> Column:
    """Lowercase hex SHA-256 of the text without white space."""
    return F.sha2(F.translate(text_or_empty(column), WHITE, ""), 256)


def heavy_candidates(thin: DataFrame) -> DataFrame:
    """At most HEAVY_MOST rows (digest): a superset of the clearly frequent digests."""
    parts = thin.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(digest, {COUNTERS})").alias("summary")
    )
    merged = parts.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_combine(summary, {COUNTERS})").alias("summary")
    )  # grouped: no row for an empty table
    top = merged.select(
        F.explode(F.expr(f"approx_top_k_estimate(summary, {HEAVY_MOST})")).alias("top")
    )
    return top.select(F.col("top.item").alias("digest")).where(F.col("digest").isNotNull())


def best(n_chars: str, doc_id: str, tie: str) -> Column:
    """The smallest of these structs belongs to the row that stays."""
    return F.struct(
        (-F.col(n_chars)).alias("less_chars"),
        F.col(doc_id).isNull().alias("no_id"),
        F.col(doc_id).alias("doc_id"),
        F.col(tie).alias("tie"),
    )


def verified_winners(thin: DataFrame, tie: str) -> DataFrame:
    """(digest, n, win) of the heavy digests, HEAVY_MOST rows at most."""
    exact = (
        thin.join(F.broadcast(heavy_candidates(thin)), "digest")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(best("n_chars", "doc_id", tie)).alias("win"))
    )
    return exact.where((F.col("n") > 1) & (F.col("n") >= HEAVY_SHARE * thin.count()))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    thin = stored(
        docs.select(
            "doc_id",
            digest().alias("digest"),
            F.length(text_or_empty()).alias("n_chars"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "exact-dedup",
    )
    winners = stored(verified_winners(thin, "row_no"), "exact-dedup-heavy")
    marked = thin.join(F.broadcast(winners), "digest", "left")
    heavy = told(marked.where(F.col("n").isNotNull()))
    light = marked.where(F.col("n").isNull()).drop("n", "win")
    repeated = light.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(best("n_chars", "doc_id", "row_no")).alias("win")
    ).where("n > 1")
    return heavy.unionByName(told(light.join(repeated, "digest", "left")))


def told(rows: DataFrame) -> DataFrame:
    """The report's columns from rows with the count and winner of their digest (null: alone)."""
    alone = F.col("n").isNull()
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("win.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("win.tie") == F.col("row_no"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def distinct_texts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    key, chars, tie, n, win = fresh(docs, "digest", "n_chars_", "tie", "n_copies", "win")
    thin = stored(
        docs.select(
            "doc_id",
            digest().alias("digest"),
            F.length(text_or_empty()).alias("n_chars"),
            F.xxhash64(text_or_empty()).alias("tie"),
        ),
        "exact-dedup",
    )
    winners = stored(verified_winners(thin, "tie"), "exact-dedup-heavy").select(
        F.col("digest").alias(key), F.col("n").alias(n), F.col("win").alias(win)
    )
    full = docs.select(
        "*",
        digest().alias(key),
        F.length(text_or_empty()).alias(chars),
        F.xxhash64(text_or_empty()).alias(tie),
    ).join(F.broadcast(winners), key, "left")
    left = full.where(F.col(n).isNull() | (best(chars, "doc_id", tie) == F.col(win)))
    ranked = Window.partitionBy(key).orderBy(
        F.col(chars).desc(), F.col("doc_id").asc_nulls_last(), F.col(tie)
    )
    (rank,) = fresh(full, "rank")
    return (
        left.withColumn(rank, F.row_number().over(ranked))
        .where(F.col(rank) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
