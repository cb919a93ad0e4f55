"""Resumable zip and generate as Structured Streaming jobs.

The original keeps a JSON offset log and skips processed lines on restart;
a crash between writing rows and the log duplicates rows. Here the stream's
checkpoint records progress and every micro-batch writes to its own
``batch=<id>`` folder with overwrite, so a replayed batch replaces its own
output: exactly-once results. Language identification aggregates per
record, so it runs inside ``foreachBatch`` instead of as streaming state.
A corrupt checkpoint makes the query fail on start (T3).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions import fixed_values as V
from ..operators.bytegrams import ByteModel
from ..operators.corpus import DETAILED_COLUMNS, generate_dialogues, zip_comments
from ..operators.langid import LangModel
from ..session import materialize
from ..sources.io import COMMENT_SCHEMA
from ..sources.landed import parents_of
from ..sources.publish import Files
from ..sources.ranges import SPLIT_BYTES, each_batch


PENDING_SCHEMA = StructType([StructField("lang", StringType()), *COMMENT_SCHEMA.fields, StructField("since", IntegerType())])


def _write_batch(df: DataFrame, out: str, batch_id: int | str) -> None:
    df.write.mode("overwrite").partitionBy("lang").parquet(f"{out.rstrip('/')}/batch={batch_id}")


def zip_stream(spark: SparkSession, src: str, out: str, checkpoint: str,
               model: LangModel | ByteModel, langs=V.LANGS, files_per_batch: int | None = None):
    """NDJSON comment files -> detailed rows, until all present files are done."""
    reader = spark.readStream.schema(COMMENT_SCHEMA).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.json(src)

    def batch(df: DataFrame, batch_id: int) -> None:
        _write_batch(zip_comments(df, model, langs), out, batch_id)

    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def zip_ranges(spark: SparkSession, src: str, out: str, progress: str, model: LangModel | ByteModel, langs=V.LANGS,
               batch_bytes: int = 1 << 30, split_bytes: int = SPLIT_BYTES, most: int | None = None) -> int:
    """T1 inside files: NDJSON dump -> detailed rows, ``batch_bytes`` of the files at a time; returns the batches done.

    Stopped anywhere, it goes on behind the last recorded byte of the file it
    was in. Each batch writes its own ``batch=<n>`` folder with overwrite.
    """
    return each_batch(spark, src, progress, COMMENT_SCHEMA, lambda rows, n: _write_batch(zip_comments(rows, model, langs), out, n),
                      batch_bytes, split_bytes, most)


def generate_stream(spark: SparkSession, detailed_dir: str, out: str, checkpoint: str,
                    comments: DataFrame | Callable[[int], DataFrame], submissions: DataFrame,
                    detector: LangModel | ByteModel, langs=V.LANGS,
                    files_per_batch: int | None = None, pending: str | None = None, keep_batches: int | None = None):
    """New detailed files -> dialogue rows, joined with the comment and
    submission tables inside each micro-batch.

    The parents a batch needs are written first and looked up among the
    comments through a Bloom filter; with bucketed comments
    (``sources.landed``) a batch does not shuffle them.

    ``comments`` may be a function of the batch number, for a table that
    grows. A reply whose parent has not arrived then waits in the table
    ``pending`` and is tried again with every batch; ``settle`` tries once
    more after the last one. Batch n writes ``pending/batch=n`` from its rows
    and the table that batch n - 1 left, so a replayed batch does the same
    again. Without ``pending`` such replies are lost; with ``keep_batches``
    those that waited for more batches are.
    """
    schema = spark.read.parquet(detailed_dir).schema
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "false")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(detailed_dir)

    def batch(df: DataFrame, batch_id: int) -> None:
        now = comments(batch_id) if callable(comments) else comments
        _generate_batch(df, now, submissions, detector, langs, out, str(batch_id), pending, batch_id, keep_batches)

    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _steps(spark: SparkSession, folder: str) -> list[tuple[int, int, str]]:
    """(batch, settling, name) of the folders ``batch=<n>`` and ``batch=<n>s<k>``, in order."""
    found = []
    for name in Files(spark, folder).names(folder):
        m = re.fullmatch(r"batch=(\d+)(?:s(\d+))?", name)
        if m:
            found.append((int(m[1]), int(m[2] or 0), name))
    return sorted(found)


def _waiting(spark: SparkSession, pending: str, before: int) -> DataFrame | None:
    """The replies that the step before batch ``before`` left."""
    steps = [s for s in _steps(spark, pending) if s[0] < before]
    return spark.read.schema(PENDING_SCHEMA).parquet(f"{pending.rstrip('/')}/{steps[-1][2]}") if steps else None


def _generate_batch(df: DataFrame, comments: DataFrame, submissions: DataFrame, detector, langs, out: str, name: str,
                    pending: str | None, batch_id: int, keep_batches: int | None) -> None:
    spark = df.sparkSession
    rows = df.where(F.col("parent_id").startswith(V.REPLY_PREFIX))
    if pending:
        rows = rows.select(*DETAILED_COLUMNS).withColumn("since", F.lit(batch_id))
        before = _waiting(spark, pending, batch_id)
        rows = materialize(rows if before is None else rows.unionByName(before), "batch-replies")
    parents = materialize(parents_of(rows, comments, V.REPLY_PREFIX), "batch-parents")
    _write_batch(generate_dialogues(rows, parents, submissions, detector, langs), out, name)
    if pending:
        there = parents.select(F.concat(F.lit(f"{V.REPLY_PREFIX}_"), "id").alias("parent_id"))
        late = rows.join(there, "parent_id", "left_anti").select(PENDING_SCHEMA.fieldNames())
        if keep_batches is not None:
            late = late.where(F.col("since") >= batch_id - keep_batches)
        late.write.mode("overwrite").parquet(f"{pending.rstrip('/')}/batch={name}")
        for n, _, old in _steps(spark, pending):        # a replay reads the step before its own at most
            if n < batch_id - 1:
                Files(spark, pending).delete(f"{pending.rstrip('/')}/{old}")


def settle(spark: SparkSession, out: str, pending: str, comments: DataFrame, submissions: DataFrame,
           detector: LangModel | ByteModel, langs=V.LANGS) -> int:
    """Try the replies that wait in ``pending`` once more; returns how many still wait.

    For parents that arrive when no new replies do. Run it while the stream is
    stopped; the stream goes on from what it leaves.
    """
    steps = _steps(spark, pending)
    if not steps:
        return 0
    n, k, _ = steps[-1]
    waiting = _waiting(spark, pending, n + 1)
    name = f"{n}s{k + 1}"
    parents = materialize(parents_of(waiting, comments, V.REPLY_PREFIX), "batch-parents")
    _write_batch(generate_dialogues(waiting, parents, submissions, detector, langs), out, name)
    there = parents.select(F.concat(F.lit(f"{V.REPLY_PREFIX}_"), "id").alias("parent_id"))
    late = waiting.join(there, "parent_id", "left_anti").select(PENDING_SCHEMA.fieldNames())
    late.write.mode("overwrite").parquet(f"{pending.rstrip('/')}/batch={name}")
    return spark.read.schema(PENDING_SCHEMA).parquet(f"{pending.rstrip('/')}/batch={name}").count()


def read_output(spark: SparkSession, out: str) -> DataFrame:
    """All batches written so far (partition columns ``batch`` and ``lang``)."""
    return spark.read.parquet(out)
