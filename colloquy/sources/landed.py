"""Landed raw comments, bucketed by id.

Every month is written once, dealt into buckets by comment id. Looking up the
parents of a run's replies then shuffles the wanted ids alone: the comment
side is read bucket by bucket where it lies, however many months there are.
Before that, a Bloom filter of the wanted ids, built by an aggregate, drops
most comments that nobody asked for at the scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .io import COMMENT_SCHEMA
from .publish import folders

BUCKETS = 64
BITS_PER_KEY = 4
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 20      # of 64 bits: the filter has 8 MB at most
KEYS_PER_WORD = 8


def write_bucketed(comments: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """One run's comments as Parquet in ``buckets`` buckets by id, each sorted; ``path`` must be a folder of its own."""
    spark = comments.sparkSession
    name = f"landing_{uuid.uuid4().hex}"
    dealt = comments.select(COMMENT_SCHEMA.fieldNames()).repartition(buckets, "id")
    dealt.write.format("parquet").bucketBy(buckets, "id").sortBy("id").option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")         # the catalog's entry alone; the files are the caller's


def open_comments(spark: SparkSession, table_path: str, buckets: int = BUCKETS, runs: list | None = None) -> DataFrame:
    """The published comments of all runs (or some) as one bucketed table of ``COMMENT_SCHEMA``."""
    found = folders(spark, table_path, runs)
    if not found:
        raise FileNotFoundError(f"nothing published of {table_path}")
    return open_folders(spark, found, buckets)


def open_folders(spark: SparkSession, found: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The rows of folders that ``write_bucketed`` wrote, as one bucketed table: each folder is one of its partitions."""
    name = f"comments_{uuid.uuid4().hex}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in COMMENT_SCHEMA)
    base = found[0].rpartition("/")[0]
    spark.sql(f"CREATE TABLE {name} ({columns}, part INT) USING parquet PARTITIONED BY (part) "
              f"CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS LOCATION '{base}/_none'")
    for k, folder in enumerate(found):
        spark.sql(f"ALTER TABLE {name} ADD PARTITION (part = {k}) LOCATION '{folder}'")
    return spark.table(name).select(COMMENT_SCHEMA.fieldNames())


def _word_and_mask(key: Column, words: int) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    mask = F.lit(0).cast("long")
    for k in range(BITS_PER_KEY):
        mask = mask.bitwiseOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(h, 6 * k + 20), F.lit(64)).cast("int")))
    return F.pmod(F.xxhash64(h), F.lit(words)).cast("int"), mask


def bloom_filter(ids: DataFrame, col: str) -> DataFrame:
    """(word, bits): a Bloom filter of a column, each key in one word of 64 bits. At most ``MOST_WORDS`` rows."""
    n = ids.count()
    words = min(MOST_WORDS, max(LEAST_WORDS, 1 << max(0, (n // KEYS_PER_WORD)).bit_length()))
    word, mask = _word_and_mask(F.col(col), words)
    out = ids.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    return materialize(out.withColumn("words", F.lit(words)), "bloom")


def maybe_in(rows: DataFrame, col: str, bloom: DataFrame) -> DataFrame:
    """The rows whose key may be in the filter; all whose key is, and few others. Sent to the scan: its size is bounded."""
    first = bloom.select("words").first()
    if first is None:
        return rows.where("false")
    word, mask = _word_and_mask(F.col(col), first["words"])
    small = F.broadcast(bloom.select(F.col("word").alias("__word"), F.col("bits").alias("__bits")))
    met = rows.join(small, word == F.col("__word"))
    return met.where(F.col("__bits").bitwiseAND(mask) == mask).drop("__word", "__bits")


def parents_of(replies: DataFrame, comments: DataFrame, prefix: str) -> DataFrame:
    """The comments that ``replies`` (parent_id) reply to. The wanted ids are written, filter the comments, then meet them."""
    wanted = replies.where(F.col("parent_id").startswith(prefix)).select(F.expr("substr(parent_id, 4)").alias("id")).distinct()
    wanted = materialize(wanted, "wanted-parents")
    return maybe_in(comments, "id", bloom_filter(wanted, "id")).join(wanted, "id", "left_semi")
