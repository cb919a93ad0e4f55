"""Exact length histogram: totals, quantiles and truncated totals for every context limit.

Documents are aggregated by encoded length; suffix sums over the histogram
then answer every limit at once. The sums run inside blocks of lengths and
over one row per block, so no task holds the whole histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 256


def histogram(counted: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """(n_tokens, n_docs): the documents of each length; rows of null length are left out."""
    return (counted.where(F.col(length_col).isNotNull()).groupBy(F.col(length_col).alias("n_tokens"))
                   .agg(F.count(F.lit(1)).alias("n_docs")))


def limits(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per length L that occurs, taken as a context limit.

    n_docs have length L; docs_within and tokens_within have at most L,
    docs_over and tokens_over more; truncated_total is the sum of
    min(length, L); lost_tokens what truncation drops; share_within is the
    quantile of L. An empty histogram gives no rows.
    """
    h = hist.withColumn("block", F.floor(F.col("n_tokens") / block))
    h = h.withColumn("mass", F.col("n_tokens") * F.col("n_docs"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("mass").alias("bm"))
    over = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = blocks.select("block", F.coalesce(F.sum("bd").over(over), F.lit(0)).alias("docs_after"),
                           F.coalesce(F.sum("bm").over(over), F.lit(0)).alias("mass_after"),
                           F.sum("bd").over(every).alias("docs"), F.sum("bm").over(every).alias("tokens"))
    after = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    s = h.join(blocks, "block").select(
        "n_tokens", "n_docs", "docs", "tokens",
        (F.coalesce(F.sum("n_docs").over(after), F.lit(0)) + F.col("docs_after")).alias("docs_over"),
        (F.coalesce(F.sum("mass").over(after), F.lit(0)) + F.col("mass_after")).alias("tokens_over"))
    lost = F.col("tokens_over") - F.col("docs_over") * F.col("n_tokens")
    return s.select("n_tokens", "n_docs", (F.col("docs") - F.col("docs_over")).alias("docs_within"), "docs_over",
                    (F.col("tokens") - F.col("tokens_over")).alias("tokens_within"), "tokens_over",
                    (F.col("tokens") - lost).alias("truncated_total"), lost.alias("lost_tokens"),
                    ((F.col("docs") - F.col("docs_over")) / F.col("docs")).alias("share_within"))


def quantile(lim: DataFrame, q: float) -> DataFrame:
    """The smallest length (one row) that at least the share ``q`` of the documents does not exceed."""
    return lim.where(F.col("share_within") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def at_limit(lim: DataFrame, limit: int) -> DataFrame:
    """Totals for any limit, also one that is no document's length: (docs_over, truncated_total), one row."""
    over = F.sum(F.when(F.col("n_tokens") > limit, F.col("n_docs")).otherwise(0))
    kept = F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs"))
    return lim.agg(over.alias("docs_over"), kept.alias("truncated_total"))
