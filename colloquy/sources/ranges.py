"""Byte ranges of large line files (T1): a scan that goes on inside a file.

A batch is the next ``batch_bytes`` of the files, in order of their names.
Every split of a batch starts behind the first line end at or after its first
byte (the first split of a file at once) and ends with the line that its last
byte lies in, so each line belongs to one split whatever the borders, and a
batch needs no look at the bytes before it. After a batch is written its end
is recorded; a restart goes on there and reads nothing again but the rest of
one line. A batch that died before that writes the same rows to the same folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ship_package
from .publish import Files

SPLIT_BYTES = 64 << 20
READ_BYTES = 4 << 20
GIVEN_LINES = 4096


def list_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, size) of the files of a folder by name; names that start with a dot or an underscore are left out."""
    files = Files(spark, folder)
    found = [(s.getPath().toString(), s.getLen()) for s in files.fs.listStatus(files.path(folder)) if s.isFile()]
    return sorted((p, n) for p, n in found if n and not p.rpartition("/")[2].startswith((".", "_")))


def next_ranges(files: list[tuple[str, int]], at: tuple[str, int], batch_bytes: int, split_bytes: int) -> tuple[list[tuple], tuple[str, int]]:
    """The splits (path, start, stop) of the next batch after ``at`` (path, byte), and its end."""
    left, out = batch_bytes, []
    for path, size in files:
        if path < at[0] or not left:
            continue
        pos = at[1] if path == at[0] else 0
        stop = min(size, pos + left)
        out += [(path, p, min(p + split_bytes, stop)) for p in range(pos, stop, split_bytes)]
        left -= stop - pos
        if stop > pos:
            at = (path, stop)
    return out, at


def _open(path: str):
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return store.open_input_file(name)


def lines_of(path: str, start: int, stop: int, read_bytes: int = READ_BYTES) -> Iterator[bytes]:
    """The lines of a file that begin in start .. stop - 1 (a line begins behind a line end, or with the file)."""
    with _open(path) as f:
        # From the byte before: if that is a line end, the first line begins at ``start``.
        at = max(start - 1, 0)
        f.seek(at)
        rest, first = b"", start > 0
        begin = at                                  # of ``rest`` in the file
        while True:
            data = f.read(read_bytes)
            if not data:
                break
            *whole, tail = (rest + data).split(b"\n")
            for line in whole:
                if first:
                    first = False
                elif begin < stop:
                    yield line
                begin += len(line) + 1
                if begin >= stop:
                    return
            rest = tail
        if rest and not first and begin < stop:
            yield rest


def read_ranges(spark: SparkSession, ranges: list[tuple], schema: StructType) -> DataFrame:
    """The JSON lines of the splits as rows of ``schema``, a task per split. A malformed line fails the job; empty lines are skipped."""
    ship_package(spark)
    # One row of three values per split of a batch.
    splits = spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "n int, path string, start long, stop long")
    splits = splits.repartitionByRange(max(1, len(ranges)), "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start, stop in zip(*(b.column(c).to_pylist() for c in ("path", "start", "stop"))):
                held = []
                for line in lines_of(path, start, stop):
                    if line.strip():
                        held.append(line)
                    if len(held) == GIVEN_LINES:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).cast(pa.string())], ["value"])
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).cast(pa.string())], ["value"])
    lines = splits.mapInArrow(run, "value string")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def _progress(files: Files, folder: str) -> list[tuple[int, str]]:
    return sorted((int(n[1:-5]), n) for n in files.names(folder) if n.startswith("b") and n.endswith(".json"))


def each_batch(spark: SparkSession, src: str, progress: str, schema: StructType, work: Callable[[DataFrame, int], None],
               batch_bytes: int, split_bytes: int = SPLIT_BYTES, most: int | None = None) -> int:
    """Call ``work(rows, batch)`` for the batches that ``progress`` does not record yet, ``most`` at most; returns how many.

    ``work`` must replace what an earlier try of the same batch wrote. Files
    must arrive in the order of their names and grow no more; a batch recorded
    under other sizes stays as it was. A record that cannot be read fails the
    call (T3).
    """
    files, done = Files(spark, progress), 0
    while most is None or done < most:
        seen = _progress(files, progress)
        number, at = -1, ("", 0)
        if seen:
            number, name = seen[-1]
            r = json.loads(files.read(f"{progress}/{name}"))
            at = (r["path"], int(r["byte"]))
        ranges, end = next_ranges(list_files(spark, src), at, batch_bytes, split_bytes)
        if not ranges:
            break
        work(read_ranges(spark, ranges, schema), number + 1)
        files.write_new(f"{progress}/b{number + 1:09d}.json", json.dumps({"path": end[0], "byte": end[1]}))
        done += 1
    return done
