"""Exact length histogram and what its suffix sums answer for every context limit.

Documents are aggregated by encoded length. Suffix sums run in two steps, inside blocks of BLOCK lengths and
over the blocks' sums, so that no task holds the whole histogram. One row stands for a length that occurs;
between two of them every answer is linear in the limit, so at_limits() is exact for any limit.

Defined results: null and empty texts have length 0 and count as documents; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 128


def histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """length, n_docs."""
    return lengths.groupBy(F.col(length).cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For each length as a context limit: documents at, within and over it, tokens within, truncated and all totals, and the share within."""
    rows = hist.withColumn("block", F.floor(F.col("length") / BLOCK).cast("long"))
    tokens = F.col("length") * F.col("n_docs")
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum(tokens).alias("bt"))
    past = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = blocks.select(
        F.col("block").alias("at"),
        F.coalesce(F.sum("bd").over(past), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("bt").over(past), F.lit(0)).alias("tokens_above"),
        F.sum("bd").over(every).alias("all_docs"),
        F.sum("bt").over(every).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"id": F.coalesce(F.sum("n_docs").over(inside), F.lit(0)), "it": F.coalesce(F.sum(tokens).over(inside), F.lit(0))})
    rows = rows.join(above, rows["block"] == above["at"])
    over, tokens_over = F.col("id") + F.col("docs_above"), F.col("it") + F.col("tokens_above")
    within = F.col("all_docs") - over
    return rows.select(
        F.col("length").alias("context_limit"),
        "n_docs",
        within.alias("docs_within"),
        over.alias("docs_over"),
        (F.col("all_tokens") - tokens_over).alias("tokens_within"),
        (F.col("all_tokens") - tokens_over + F.col("length") * over).alias("truncated_total"),
        F.col("all_tokens").alias("total_tokens"),
        (within / F.col("all_docs")).alias("quantile"),
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Totals truncated at any limits: context_limit, docs_within, truncated_total."""
    rows = hist.withColumn("context_limit", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])))
    cut = F.least("length", "context_limit") * F.col("n_docs")
    return rows.groupBy("context_limit").agg(F.sum(F.when(F.col("length") <= F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_within"), F.sum(cut).alias("truncated_total"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least the given share of documents keeps within: share, length."""
    rows = sums.withColumn("share", F.explode(F.array(*[F.lit(float(x)) for x in shares])))
    return rows.where(F.col("quantile") >= F.col("share")).groupBy("share").agg(F.min("context_limit").alias("length"))
