"""Reading the given tables, shared-folder tables and Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize, ship_package

__all__ = ["add_columns", "arrow_map", "bucket_fold", "documents", "materialize", "read_table", "text_chunks"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, as it lies there."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The named columns of ``documents`` (doc_id and text if none are named)."""
    return read_table(spark, sf_dir, "documents").select(*(cols or ("doc_id", "text")))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType,
              at_end: Callable[[], None] | None = None) -> DataFrame:
    """``mapInArrow`` with a function of one record batch; a task gives its memory back ``at_end``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None and out.num_rows:
                    yield out
        if at_end:
            at_end()
        pa.default_memory_pool().release_unused()
    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], list], fields: str,
                keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the columns ``fields`` (DDL) that ``fn`` makes of each record batch.

    A column of ``df`` named as one of ``fields`` is replaced.
    """
    new = StructType.fromDDL(fields)
    kept = [f for f in df.schema.fields if f.name not in new.names and (keep is None or f.name in keep)]
    names = [f.name for f in kept] + new.names

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *fn(batch)], names)
    return arrow_map(df, run, StructType(kept + new.fields))


def text_chunks(col: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts of a string column in runs of about ``max_bytes`` (nulls are empty).

    Yields (first row, end row, UTF-8 bytes, row offsets into the bytes). A
    text longer than ``max_bytes`` makes a run of its own; nothing is cut.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    offs = np.frombuffer(col.buffers()[1], np.int64, count=n + 1 + col.offset)[col.offset:]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1))
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def bucket_fold(key: Column, modulus: int) -> Column:
    """The standard zlib CRC-32 of a key's decimal text, modulo ``modulus`` (null key: of the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus
