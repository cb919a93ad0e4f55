"""Metrics and statistics that grow by a month: mergeable counts per run, published together.

A run's n-gram counts and sentence totals (A2-A7) or length histogram (A13)
are written once. A new month adds its own; a month counted again replaces
its own; the report adds up what is published and reads no text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import fixed_values as V
from ..operators import metrics as M
from ..operators.tokengrams import TOP_BITS, deal_blocks, gram_blocks
from ..session import materialize, shuffles_dropped
from ..sources import publish

QUANTILES = (0.5, 0.9, 0.99)


def _publish(spark: SparkSession, root: str, run: str, tables: dict[str, DataFrame]) -> None:
    version = publish.current(spark, root) or publish.Version()
    folder = publish.new_folder(run)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/{folder}")
        version = version.with_run(name, run, folder)
    publish.publish(spark, root, version)


PASS_BITS = 2       # the n-grams of all runs are added up in 2^bits passes, so that only a share of them is shuffled at a time


def add_diversity_run(preds: DataFrame, root: str, run: str, by=(), orders=V.DISTINCT_ORDERS, pred: str = "pred") -> None:
    """Count one run's predictions (A2-A7) into the tables below ``root``; its n-grams lie there as the tasks counted them."""
    tok = M.with_metric_tokens(preds, pred)
    _publish(preds.sparkSession, root, run, {"grams": gram_blocks(tok, "tokens", orders, list(by), PASS_BITS),
                                             "totals": M.sentence_totals(tok, "tokens", orders, by)})


def diversity_report(spark: SparkSession, root: str, by=(), orders=V.DISTINCT_ORDERS, runs: list | None = None) -> DataFrame:
    """A2-A7 over all published runs (or some), equal to one pass over all their rows."""
    by = list(by)
    blocks = publish.read_published(spark, f"{root}/grams", runs=runs)
    totals = materialize(M.merge_totals(publish.read_published(spark, f"{root}/totals", runs=runs), orders, by), "totals")
    passes = 1 << PASS_BITS
    bits = min(M.gram_bits(blocks, M.tokens_of(totals) // passes, orders), TOP_BITS - PASS_BITS)
    sums = []
    with shuffles_dropped(spark):
        for k in range(passes):
            some = deal_blocks(blocks.where(F.col("part") == k), by, PASS_BITS + bits)
            sums.append(materialize(M.block_sums(some, by, bits), "gram-sums"))
    return M.diversity_of(M.merge_sums(reduce(DataFrame.unionByName, sums), by), totals, orders, by)


def length_counts(rows: DataFrame, length, chars, by=("lang", "split")) -> DataFrame:
    """(by..., length, n, chars): how many rows have a length, and their characters. Tables of different rows add up."""
    return rows.groupBy(*by, length.cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.sum(chars.cast("long")).alias("chars"))


def add_length_run(rows: DataFrame, root: str, run: str, length, chars, by=("lang", "split")) -> None:
    """Count one run's rows (A13) into the table below ``root``."""
    _publish(rows.sparkSession, root, run, {"lengths": length_counts(rows, length, chars, by)})


def length_report(counts: DataFrame, by=("lang", "split"), quantiles=QUANTILES) -> DataFrame:
    """(by..., n, mean, chars, p<q>...) for every combination of ``by`` and their totals, named "all".

    One aggregate over grouping sets; a quantile is the least length that a
    share q of the rows does not exceed, exact on the histogram.
    """
    by = list(by)
    sets = [[c for i, c in enumerate(by) if m >> i & 1] for m in range(1 << len(by))]
    g = counts.groupingSets([[*s, "length"] for s in sets], *by, "length").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), *[F.grouping(c).alias(f"_all_{c}") for c in by])
    g = g.select(*[F.when(F.col(f"_all_{c}") == 1, F.lit("all")).otherwise(F.col(c)).alias(c) for c in by], *[f"_all_{c}" for c in by], "length", "n", "chars")
    key = [*by, *[f"_all_{c}" for c in by]]
    # A window row is a length of a group, not a text.
    upto = Window.partitionBy(*key).orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("_upto", F.sum("n").over(upto)).withColumn("_of", F.sum("n").over(Window.partitionBy(*key)))
    cells = [F.min(F.when(F.col("_upto") >= F.ceil(F.col("_of") * F.lit(float(q))), F.col("length"))).alias(f"p{round(q * 100)}") for q in quantiles]
    out = g.groupBy(*key).agg(F.sum("n").alias("n"), (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean"),
                              F.sum("chars").alias("chars"), *cells)
    return out.drop(*[f"_all_{c}" for c in by])
