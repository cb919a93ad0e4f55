"""A training corpus from ``documents``, stage by stage.

Every stage is a function of (spark, docs, sf_dir) over all that the one
before it kept. ``run`` writes each stage's rows as Parquet in the shared
folder of ``spark.checkpoint.dir`` and reads them again, so a lost executor
repeats one stage at most. All stages but the last keep the columns of
``documents``; repeated rows, null texts and empty tables pass through as
the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import decontaminate, jaccard, packing, quality, queries, secrets, tokens
from colloquy.llm.common import materialize, read_table
from colloquy.session import ship_package


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (9) does not reject."""
    ship_package(spark)
    return quality.keep_good(docs, queries.quality_forest(spark, docs, sf_dir))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join (6)."""
    ship_package(spark)
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth of benchmark words or more (8)."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets (2) replaced by a mark."""
    ship_package(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 4096 tokens (1)."""
    ship_package(spark)
    pieces = tokens.pieces(docs, packing.CAPACITY, tokens.public_path(queries.WORD_BPE))
    return packing.pack_documents(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality", keep_quality), ("near_copies", keep_one_of_near_copies), ("decontaminate", drop_contaminated),
          ("secrets", redact_secrets), ("pack", pack)]

#: A forest, MinHash and a tokenizer have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
