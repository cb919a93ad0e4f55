"""Spark session and checkpoint-folder helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


COMMON = {
    "spark.ui.enabled": "false",
    "spark.sql.files.maxPartitionBytes": str(64 << 20),   # text explodes ~30x in rows
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_session(app: str = "colloquy", shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session on the cluster that ``spark-submit`` names: its master, memory and addresses stay as given.

    Only what the operators assume is set: AQE, UTC, Arrow, splits of 64 MB and
    no UI. ``spark.checkpoint.dir`` must name a shared folder.
    """
    b = SparkSession.builder.appName(app)
    for k, v in {**COMMON, **({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}), **(extra or {})}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def build_session(master: str | None = None, app: str = "colloquy",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local session (tests, benchmark) with the settings the operators assume.

    AQE re-plans joins at runtime (broadcast conversion, skew-join splits,
    partition coalescing); the UI stays off.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = SparkSession.builder.master(master).appName(app)
    for k, v in COMMON.items():
        b = b.config(k, v)
    b = (b.config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.driver.memory", "20g")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.colloquy.spread", cpus))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``colloquy`` importable in the Python workers.

    UDFs pickle its functions by reference. On a local master the package
    is zipped once per application and added with ``addPyFile``; on a
    cluster ship it with ``spark-submit --py-files`` (nothing is written to a
    machine-local folder there).
    """
    import zipfile
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or not sc.master.startswith("local"):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(root)
    path = os.path.join(tempfile.mkdtemp(prefix="colloquy-pyfiles-", dir="/tmp"), "colloquy.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only a
    local-mode session without that setting (tests) gets a fresh folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        try:
            named = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            named = None
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir() or named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="colloquy-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder for a written table."""
    import uuid
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet below the shared checkpoint folder
    and read it back. One pass (``Dataset.checkpoint`` computes its input
    twice unless cached), columnar, and the scan carries real size statistics."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a query started in here shuffled is deleted at its end, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a table's bytes; very many where it knows nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and nothing reads any more. Files elsewhere are left alone."""
    spark = df.sparkSession
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = fs.makeQualified(base).toString().rstrip("/") + "/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if fs.makeQualified(path).toString().startswith(root):
            fs.delete(path, True)
