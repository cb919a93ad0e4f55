"""Published versions of a corpus: what a run writes is readable all at once, or not at all.

A run writes every table into folders of its own and, at its end, one small
version file that lists the folders of all tables. Readers follow the highest
version; a run that fails before the end leaves folders that no version names
and changes nothing that can be read. The version file is renamed into place,
which fails if another run published that number first.

``<root>/_runs/v<number>.json`` holds, per table, the folder of each run
(a month, say) relative to the table's path.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

RUNS = "_runs"


@dataclass
class Version:
    """One published state: ``tables[table][run]`` is the run's folder below the table's path."""
    number: int = 0
    tables: dict = field(default_factory=dict)
    settings: dict = field(default_factory=dict)

    def with_run(self, table: str, run: str, folder: str) -> "Version":
        """The same with one run of one table replaced."""
        tables = {t: dict(runs) for t, runs in self.tables.items()}
        tables.setdefault(table, {})[run] = folder
        return Version(self.number, tables, dict(self.settings))

    def replacing(self, table: str, folder: str) -> "Version":
        """The same with all of a table in one folder."""
        return Version(self.number, {**self.tables, table: {"all": folder}}, dict(self.settings))


class Files:
    """The file system of a path, whichever store it is in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> None:
        """A whole file under a name that must be free."""
        part = f"{path}.{uuid.uuid4().hex[:8]}.part"
        stream = self.fs.create(self.path(part), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        final = self.fs.makeQualified(self.path(path))
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.conf)
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        context.rename(self.fs.makeQualified(self.path(part)), final, self.gateway.new_array(kind, 0))

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def split_path(table_path: str) -> tuple[str, str]:
    """(root, name) of a table's path."""
    root, _, name = table_path.rstrip("/").rpartition("/")
    return root, name


def current(spark: SparkSession, root: str) -> Version | None:
    """The highest published version below ``root``; None where nothing was published."""
    files = Files(spark, root)
    numbers = sorted(int(n[1:-5]) for n in files.names(f"{root}/{RUNS}") if n.startswith("v") and n.endswith(".json"))
    return Version(numbers[-1], **json.loads(files.read(f"{root}/{RUNS}/v{numbers[-1]:09d}.json"))) if numbers else None


def publish(spark: SparkSession, root: str, version: Version) -> Version:
    """Make ``version`` the next one; fails if its successor exists, so that no run undoes another's."""
    out = Version(version.number + 1, version.tables, version.settings)
    Files(spark, root).write_new(f"{root}/{RUNS}/v{out.number:09d}.json", json.dumps({"tables": out.tables, "settings": out.settings}))
    return out


def folders(spark: SparkSession, table_path: str, runs: list | None = None) -> list[str] | None:
    """The published folders of a table (of some runs); None where its root has no versions."""
    root, name = split_path(table_path)
    version = current(spark, root)
    if version is None:
        return None
    return [f"{table_path.rstrip('/')}/{f}" for run, f in sorted(version.tables.get(name, {}).items()) if runs is None or run in runs]


def read_published(spark: SparkSession, table_path: str, schema=None, runs: list | None = None) -> DataFrame:
    """A table's published rows; a path without versions is read as it lies there."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    found = folders(spark, table_path, runs)
    if found is None:
        return reader.parquet(table_path)
    if not found:
        raise FileNotFoundError(f"nothing published of {table_path}")
    # Each folder is partitioned by itself: its own base path, so that no column comes from the folders' names.
    out = reader.option("basePath", found[0]).parquet(found[0])
    for f in found[1:]:
        out = out.unionByName(reader.option("basePath", f).parquet(f))
    return out


def new_folder(run: str) -> str:
    """A folder name for one attempt of a run."""
    return f"{run}-{uuid.uuid4().hex[:10]}"


def vacuum(spark: SparkSession, root: str, tables: list[str], keep: int = 1) -> list[str]:
    """Delete the folders of ``tables`` that none of the last ``keep`` versions names; call it while no run writes."""
    files = Files(spark, root)
    names = sorted(n for n in files.names(f"{root}/{RUNS}") if n.startswith("v") and n.endswith(".json"))[-keep:]
    live = set()
    for n in names:
        for table, runs in json.loads(files.read(f"{root}/{RUNS}/{n}"))["tables"].items():
            live |= {(table, f) for f in runs.values()}
    gone = []
    for table in tables:
        for f in files.names(f"{root}/{table}"):
            if (table, f) not in live and not f.startswith((".", "_")):
                files.delete(f"{root}/{table}/{f}")
                gone.append(f"{table}/{f}")
    return gone
