"""The given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    # The local test session deals its small one-split files to its cores, by the first column: dealt by turns, the
    # rows of a part would depend on the columns read. A cluster leaves this unset.
    cores = spark.conf.get("spark.colloquy.spread", None)
    return df.repartition(int(cores), df.columns[0]) if cores else df
