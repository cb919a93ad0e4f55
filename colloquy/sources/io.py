"""Scans and sinks of the corpus tables.

Every table is Parquet, partitioned by ``lang`` (and ``split``), with
explicit schemas; nothing is inferred. Appends are plain Spark appends; the
split sink overwrites only the partitions it writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .publish import read_published

COMMENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("link_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("no_follow", T.BooleanType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("subreddit", T.StringType()),
])

DIALOGUE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                ("lang", "title", "source_body", "target_body", "link_id", "source_id", "target_id")])


def read_comments(spark: SparkSession, paths) -> DataFrame:
    """UTF-8 NDJSON, one object per line, fields used by the corpus only. A malformed line fails the job."""
    return spark.read.schema(COMMENT_SCHEMA).option("mode", "FAILFAST").json(paths)


def read_detailed(spark: SparkSession, path: str, langs=None) -> DataFrame:
    """The zip output; a language list prunes partitions."""
    df = spark.read.parquet(path)
    return df.where(F.col("lang").isin(list(langs))) if langs else df


#: How a null is spelled in CSV, so that an empty string stays one: a private-use character before the word.
NULL_FIELD = "\ue000null"
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "lineSep": "\n",
               "nullValue": NULL_FIELD, "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_dialogues(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3: dialogue or cleaned rows; CSV (header, RFC 4180 quoting, fields may
    span lines) or Parquet. Empty strings and nulls stay what they are; a
    malformed line fails the job."""
    if fmt == "csv":
        return spark.read.schema(DIALOGUE_SCHEMA).option("mode", "FAILFAST").options(**CSV_OPTIONS).csv(path)
    return spark.read.parquet(path)


def write_dialogues_csv(df: DataFrame, path: str) -> None:
    """Dialogue rows as CSV with the quoting ``read_dialogues(fmt="csv")`` reads."""
    df.write.mode("overwrite").options(quoteAll="true", **CSV_OPTIONS).csv(path)


def read_splits(spark: SparkSession, path: str, lang: str | None = None, translated: bool | None = None) -> DataFrame:
    """The split table, optionally one language; ``translated`` takes
    the variant that ``write_splits`` or ``write_translated`` put beside the other.
    Where ``plans.corpus`` published versions, the last one is read."""
    df = read_published(spark, path) if translated is None else spark.read.parquet(variant(path, translated))
    if lang is not None:
        df = df.where(F.col("lang") == lang)
    return df


def variant(path: str, translated: bool) -> str:
    """The folder of the plain or translated rows below ``path``; their columns differ."""
    return f"{path.rstrip('/')}/{'translated' if translated else 'plain'}"


def _not_null(df: DataFrame) -> DataFrame:
    """Without the rows that hold nothing but their partition's label."""
    return df.na.drop(how="all", subset=[c for c in df.columns if c not in ("lang", "split")])


def write_detailed(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append, one folder per language (``mode`` "overwrite" replaces an own folder)."""
    _not_null(df).write.mode(mode).partitionBy("lang").parquet(path)


def write_dialogues(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append dialogue or cleaned rows by language (``mode`` "overwrite" replaces an own folder)."""
    _not_null(df).write.mode(mode).partitionBy("lang").parquet(path)


def write_splits(df: DataFrame, path: str) -> None:
    """Replace the (split, lang) partitions present in ``df``, keep others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("split", "lang").parquet(path))


def write_translated(df: DataFrame, path: str) -> None:
    """Append translated rows, by split (where the rows have one) and language."""
    parts = [c for c in ("split", "lang") if c in df.columns]
    df.write.mode("append").partitionBy(*parts).parquet(variant(path, True))


def write_comments_json(df: DataFrame, path: str, files: int | None = None) -> None:
    """Land comments as NDJSON (the dump format S1 reads)."""
    (df.repartition(files) if files else df).write.mode("overwrite").json(path)
