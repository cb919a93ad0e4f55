"""Positional building blocks that stay balanced when one group is huge.

``row_number()`` over ``partitionBy(lang)`` puts a whole language in one
task; a language may hold a third of all rows. These helpers split such
groups across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize


def _parts(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rank_within(df: DataFrame, group_cols: list, order_cols: list,
                num_partitions: int | None = None, broadcast_offsets: bool = True) -> DataFrame:
    """Add ``rn`` (1-based position in the group by ``order_cols``) and ``n`` (group size).

    The rows are range-partitioned on (group, order), so a big group spans
    many partitions. Each partition counts its rows per group; a running sum
    of those counts over the partitions gives every piece its offset. The
    offsets table has at most (partitions + groups) rows and is broadcast.
    ``group_cols + order_cols`` must be unique: the position of a row in its
    partition then does not depend on shuffle fetch order, so a recomputed
    partition gets the same numbers. An explicit partition count keeps AQE
    from coalescing this exchange, which keeps partition ids stable.

    The groups here are languages (and splits), a short list, which bounds
    the broadcast offsets table. For a high-cardinality group pass
    ``broadcast_offsets=False`` and the offsets join shuffles instead.
    """
    keys = list(group_cols) + list(order_cols)
    # Written once: the counts and the join back must see the same partition
    # ids. Read twice instead, the range partitioner samples its input again,
    # and a different sample (input order is not fixed) gives other bounds.
    r = materialize(df.repartitionByRange(_parts(df, num_partitions), *keys)
                      .sortWithinPartitions(*keys)
                      .withColumn("_pid", F.spark_partition_id())
                      .withColumn("_mid", F.monotonically_increasing_id()), "ranked")
    stats = r.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select("_pid", *group_cols, "_first",
                        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_before"),
                        F.sum("_cnt").over(Window.partitionBy(*group_cols)).alias("n"))
    out = r.join(F.broadcast(offs) if broadcast_offsets else offs, ["_pid", *group_cols])
    return (out.withColumn("rn", F.col("_before") + (F.col("_mid") - F.col("_first")) + 1)
               .drop("_pid", "_mid", "_first", "_before"))


def top_k_per_group(df: DataFrame, group_cols: list, order_cols: list, k,
                    salt_buckets: int | None = None) -> DataFrame:
    """Rows whose position in their group by ``order_cols`` is <= k (exact).

    Two rounds: the first ranks inside (group, salt) sub-groups, so a hot
    group is spread over ``salt_buckets`` tasks; only each sub-group's first
    k survive, so the second round sees at most salt_buckets * k rows per
    group. ``k`` may be an int or a Column (a per-row cap).
    """
    s = _parts(df, salt_buckets)
    cap = F.lit(k) if isinstance(k, int) else k
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order_cols), F.lit(s)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
    first = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= cap).drop("_r", "_salt")
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return first.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= cap).drop("_r")


BORDER_ROWS = 100_000
DIGITS = 19


def _spelled_order(df: DataFrame, col: str) -> tuple[DataFrame, int]:
    """``df`` with ``_code``, a string that orders rows as ``col`` does, and how many characters of it make a cell.

    Strings are their own code; whole numbers are spelled with leading zeros
    from the smallest one on. Nulls come first, as in an ascending sort.
    """
    kind = df.schema[col].dataType.simpleString()
    if kind == "string":
        return df.withColumn("_code", F.when(F.col(col).isNotNull(), F.concat(F.lit("1"), F.col(col))).otherwise(F.lit("0"))), 2
    least = df.agg(F.min(col)).first()[0] or 0
    # The distance from the smallest number may need more than a long has.
    wide = F.lpad((F.col(col).cast("decimal(20,0)") - F.lit(least).cast("decimal(20,0)")).cast("string"), DIGITS + 1, "0")
    return df.withColumn("_code", F.when(F.col(col).isNotNull(), F.concat(F.lit("1"), wide)).otherwise(F.lit("0"))), 4


def _common(a: str, b: str) -> str:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return a[:n]


def first_k_per_group(df: DataFrame, group_cols: list, order_cols: list, k, border_rows: int = BORDER_ROWS,
                      hexadecimal: bool = False) -> DataFrame:
    """Rows whose position in their group by ``order_cols`` is <= k (exact), whatever k.

    A histogram of the first characters of the order key (added up in the
    tasks) tells in which cell the cut lies; that cell is refined until it has
    few rows. Then one filter keeps the rows before the cell, and its rows
    alone, ``border_rows`` of a group or those of one order key, are ranked.
    Rows are neither moved nor sorted otherwise. ``k`` may be an int or a
    Column that is constant in a group. The groups are a short list (languages,
    splits), a row of which the driver holds each. The first order column is a
    string or a whole number (``hexadecimal``: a digest, for wider cells);
    other types are ranked in two rounds.
    ``df`` is read a few times: pass a written table.
    """
    if df.schema[order_cols[0]].dataType.simpleString() not in ("string", "tinyint", "smallint", "int", "bigint"):
        return top_k_per_group(df, group_cols, order_cols, k)
    rows, width = _spelled_order(df, order_cols[0])
    width = 4 if hexadecimal else width
    cap = F.lit(k) if isinstance(k, int) else k
    spark, g = df.sparkSession, list(group_cols)
    state = {tuple(r[c] for c in g): [_common(r["_a"], r["_b"]), int(r["_k"] or 0), int(r["_n"])]
             for r in rows.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.max(cap).alias("_k"), F.min("_code").alias("_a"),
                                          F.max("_code").alias("_b")).collect()}

    schema = T.StructType([df.schema[c] for c in g] + [T.StructField("_prefix", T.StringType()), T.StructField("_need", T.LongType())])

    def met(rows: DataFrame, groups: dict) -> DataFrame:
        """The rows of some groups with their prefix and how many of its rows are wanted."""
        side = spark.createDataFrame([(*key, p, need) for key, (p, need, _) in groups.items()], schema)
        side = F.broadcast(side.select(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(g)), "_prefix", "_need"))
        return rows.join(side, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(g)]).drop(*(f"_g{i}" for i in range(len(g))))
    whole = {key: s for key, s in state.items() if s[2] <= s[1]}
    cut = {key: s for key, s in state.items() if s[2] > s[1] > 0}       # of the others no row is wanted
    wide = {key: s for key, s in cut.items() if s[2] > border_rows}
    while wide:
        cell = F.substring(F.col("_code"), F.length("_prefix") + 1, F.lit(width))
        inside = met(rows, wide).where(F.col("_code").startswith(F.col("_prefix")))
        hist = inside.groupBy(*g, cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"), F.first("_need").alias("_need"))
        before = Window.partitionBy(*g).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        lines = hist.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        # The cell of the last row wanted: one per group.
        for r in lines.where((F.col("_before") < F.col("_need")) & (F.col("_before") + F.col("_n") >= F.col("_need"))).collect():
            s = state[tuple(r[c] for c in g)]
            s[0], s[1], s[2] = s[0] + r["_cell"], s[1] - r["_before"], r["_n"]
            if r["_cell"] == "":        # one order key alone: its rows are ranked by the other columns
                del wide[tuple(r[c] for c in g)]
        wide = {key: s for key, s in wide.items() if s[2] > border_rows}
    if not cut:
        return df if len(whole) == len(state) else met(rows, whole).select(*df.columns)
    out = met(rows, cut).where(F.col("_code") < F.col("_prefix"))
    if whole:
        out = out.unionByName(met(rows, whole))
    order = Window.partitionBy(*g).orderBy(*order_cols)
    border = met(rows, cut).where(F.col("_code").startswith(F.col("_prefix"))).withColumn("_r", F.row_number().over(order))
    return out.unionByName(border.where(F.col("_r") <= F.col("_need")).drop("_r")).select(*df.columns)
