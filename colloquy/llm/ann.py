"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by fast Hadamard pseudo-rotations; the nearest signed
axis is the bucket. Each table has its own rotations, and a query probes the
axes next in line as well. A bucket is dealt to blocks of bounded size; a
query visits every block of its buckets, so none is capped, and each block
answers with its nearest rows by one matrix product. Equal vectors are
indexed once, with the smallest ids they can contribute.

How many hashes a table joins and how many buckets a query probes follow from
the data: the exact neighbours of some queries, found by one pass, tell which
settings find enough of them, and the one of these that visits the fewest rows
is taken. Where neighbours are near, several hashes leave a query a small share
of the rows; where vectors are nearly unstructured (the nearest ones hardly
nearer than the rest), one hash and more probes do, and the share is large.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import add_columns, arrow_map, materialize

TABLES = 8
HASHES = (1, 2, 3)
PROBES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)
RECALL = 0.97                 # of the sampled queries' neighbours
SAMPLE_QUERIES = 64
BLOCK_ROWS = 4096
SEED = 5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two), scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


def rotations(unit: np.ndarray, count: int, seed: int = SEED):
    """``count`` pseudo-rotations of the rows: three rounds of random signs and a Hadamard transform."""
    d = 1 << max(0, (unit.shape[1] - 1).bit_length())
    x = np.zeros((len(unit), d))
    x[:, :unit.shape[1]] = unit
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (count, 3, d))
    for r in range(count):
        y = x
        for k in range(3):
            y = hadamard(y * signs[r, k])
        yield y


def buckets(unit: np.ndarray, tables: int, hashes: int, probes: int, seed: int = SEED) -> np.ndarray:
    """rows x tables x probes bucket numbers, own bucket first, then by how near the other axes are.

    With several hashes per table a probe changes one of them.
    """
    turned = list(rotations(unit, tables * hashes, seed))
    out = np.zeros((len(unit), tables, probes), np.int64)
    rows = np.arange(len(unit))[:, None]
    for t in range(tables):
        axes, cost = [], []
        for y in turned[t * hashes:(t + 1) * hashes]:
            signed = np.concatenate([y, -y], axis=1)
            top = np.argsort(-signed, axis=1, kind="stable")[:, :probes]
            axes.append(top)
            cost.append(signed[rows, top[:, :1]] - signed[rows, top])
        width = 2 * turned[0].shape[1]
        own = sum(a[:, 0] * width ** k for k, a in enumerate(axes))
        steps = np.concatenate([own[:, None] + (a[:, 1:] - a[:, :1]) * width ** k for k, a in enumerate(axes)], axis=1)
        order = np.argsort(np.concatenate([c[:, 1:] for c in cost], axis=1), axis=1, kind="stable")[:, :probes - 1]
        out[:, t, 0] = own
        out[:, t, 1:1 + order.shape[1]] = steps[rows, order]
        out[:, t, 1 + order.shape[1]:] = own[:, None]
    return out


def _matrix(col: pa.Array) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    # The largest component first, so that neither large nor small vectors lose their length.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _nearest(top: int):
    """Of one block: for each query its ``top`` nearest index rows, ties to the smaller id."""
    def run(block: pa.Table) -> pa.Table:
        query = block.column("query").to_numpy()
        cid = block.column("cid").to_numpy()
        unit = _unit(_matrix(block.column("v")))
        at, of = np.flatnonzero(~query), np.flatnonzero(query)
        at = at[np.argsort(cid[at], kind="stable")]
        qs, cs, ss = [], [], []
        for i in range(0, len(of) if len(at) else 0, 256):
            part = of[i:i + 256]
            sims = unit[part] @ unit[at].T
            k = min(top, len(at))
            least = -np.partition(-sims, k - 1, axis=1)[:, k - 1:k]
            for q, s, m in zip(cid[part], sims, sims >= least):
                hit = np.flatnonzero(m)
                hit = hit[np.argsort(-s[hit], kind="stable")][:k]
                qs.append(np.full(len(hit), q))
                cs.append(cid[at[hit]])
                ss.append(s[hit])
        z = np.zeros(0)
        return pa.table({"qcid": pa.array(np.concatenate([*qs, z]).astype(np.int64)),
                         "cid": pa.array(np.concatenate([*cs, z]).astype(np.int64)),
                         "score": pa.array(np.concatenate([*ss, z]))})
    return run


def _search(index: DataFrame, probes: DataFrame, top: int, block_rows: int) -> DataFrame:
    """Visit the buckets: both frames have (t, bucket, cid, v); returns (qcid, cid, score), best of each pair."""
    sizes = index.groupBy("t", "bucket").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    i = index.join(sizes, ["t", "bucket"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    p = probes.join(sizes, ["t", "bucket"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cols = ["t", "bucket", "block", "cid", "v"]
    rows = i.select(*cols, F.lit(False).alias("query")).union(p.select(*cols, F.lit(True).alias("query")))
    near = rows.groupBy("t", "bucket", "block").applyInArrow(_nearest(top), "qcid long, cid long, score double")
    return near.groupBy("qcid", "cid").agg(F.max("score").alias("score"))


def _answer(near: DataFrame, classes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query from its near classes, itself left out."""
    best = Window.partitionBy("qcid").orderBy(F.col("score").desc(), "cid")
    near = near.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k + 1).drop("rn")
    rows = near.join(classes.select("cid", F.explode("ids").alias("vec_id")), "cid")
    rows = rows.join(queries, "qcid").where(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    rows = rows.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _exact(unit: np.ndarray, top: int):
    """For each of some unit vectors the ``top`` nearest rows of a batch, by one matrix product."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sims = unit @ _unit(_matrix(batch.column("v"))).T
        m = min(top, batch.num_rows)
        at = np.argsort(-sims, axis=1, kind="stable")[:, :m]
        q = np.repeat(np.arange(len(unit)), m)
        return pa.RecordBatch.from_arrays([pa.array(q), pa.array(sims[q, at.ravel()]), batch.column("cid").take(pa.array(at.ravel())),
                                           batch.column("v").take(pa.array(at.ravel()))], ["q", "score", "cid", "v"])
    return run


def settings(classes: DataFrame, queries: DataFrame, k: int = 5, tables: int = TABLES, seed: int = SEED,
             recall: float = RECALL, sample: int = SAMPLE_QUERIES) -> tuple[int, int]:
    """(hashes, probes) that find a share ``recall`` of the k nearest rows of ``sample`` queries at the fewest visits.

    The queries with the smallest hashes are compared with every row; they and
    their neighbours, at most sample * (k + 1) vectors, reach the driver. If no
    setting is good enough the one that finds most is taken.
    """
    some = queries.select("qcid").distinct().orderBy(F.xxhash64("qcid"), "qcid").limit(sample)
    asked = classes.join(F.broadcast(some.withColumnRenamed("qcid", "cid")), "cid").select("cid", "v").orderBy("cid").collect()
    if not asked:
        return HASHES[0], PROBES[-1]
    unit = _unit(np.array([r["v"] for r in asked], np.float64))
    kind = classes.schema["v"].dataType.simpleString()
    near = arrow_map(classes.select("cid", "v"), _exact(unit, k + 1), f"q long, score double, cid long, v {kind}")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "cid")
    rows = near.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k + 1).collect()
    rows = [r for r in rows if r["cid"] != asked[r["q"]]["cid"]]
    if not rows:
        return HASHES[0], PROBES[0]
    q = np.array([r["q"] for r in rows])
    found = _unit(np.array([r["v"] for r in rows], np.float64))
    width = 2 << max(0, (unit.shape[1] - 1).bit_length())
    options = []
    for h in HASHES:
        own = buckets(found, tables, h, 1, seed)[:, :, 0]
        asks = buckets(unit, tables, h, PROBES[-1], seed)
        for p in PROBES:
            met = (asks[q][:, :, :p] == own[:, :, None]).any(2).any(1).mean()
            options.append((p / width ** h, h, p, float(met)))
    enough = [o for o in options if o[3] >= recall]
    _, h, p, _ = min(enough) if enough else max(options, key=lambda o: (o[3], -o[0]))
    return h, p


def search(vectors: DataFrame, is_query, k: int = 5, tables: int = TABLES, hashes: int | None = None,
           probes: int | None = None, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of ``vectors`` (vec_id, embedding) by cosine.

    ``is_query`` is a condition on the rows. Ties go to the smaller vec_id.
    Without ``hashes`` and ``probes``, ``settings`` chooses them. Rows of null id, and vectors that are null, empty, zero, hold null or
    non-finite components, or differ in length from most, take no part.
    Repeated rows count once. A query that its probes leave with fewer than k
    answers is compared with every row, in blocks. An empty table gives no
    rows. Other columns are not read.
    """
    # Single-precision vectors travel as they are; all sums are in double precision.
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<float>" if single else "array<double>").alias("v"), is_query.alias("q"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = v.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    v = materialize(v, "ann-vectors")
    dim = v.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if dim is None:
        return v.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    v = v.where(F.size("v") == dim["d"])

    # Equal vectors form a class; only its k + 1 smallest ids can be among k nearest. Repeated rows count once.
    first = Window.partitionBy("v").orderBy("vec_id")
    few = v.select("v", "vec_id").distinct().withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= k + 1)
    classes = few.groupBy("v").agg(F.min("vec_id").alias("cid"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = materialize(classes, "ann-classes")
    queries = (v.where("q").join(classes.select("v", "cid"), "v")
                .select(F.col("vec_id").alias("query_id"), F.col("cid").alias("qcid")).distinct())
    queries = materialize(queries, "ann-queries")
    if hashes is None or probes is None:
        hashes, probes = settings(classes, queries, k, tables, seed)

    def hashed(n: int):
        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            b = buckets(_unit(_matrix(batch.column("v"))), tables, hashes, n, seed).reshape(batch.num_rows, -1)
            return [pa.ListArray.from_arrays(np.arange(len(b) + 1, dtype=np.int32) * b.shape[1], b.ravel())]
        return run
    rows = add_columns(classes.select("cid", "v"), hashed(1), "b array<long>")
    index = rows.select("cid", "v", F.posexplode("b").alias("t", "bucket"))
    asked = classes.join(queries.select(F.col("qcid").alias("cid")).distinct(), "cid", "left_semi").select("cid", "v")
    visits = add_columns(asked, hashed(probes), "b array<long>")
    visits = (visits.select("cid", "v", F.posexplode("b").alias("i", "bucket"))
                    .select("cid", "v", F.floor(F.col("i") / probes).cast("int").alias("t"), "bucket").distinct())
    near = materialize(_search(index, visits, k + 1, block_rows), "ann-near")
    out = materialize(_answer(near, classes, queries, k), "ann-answer")

    everyone = v.select("vec_id").distinct().limit(k + 1).count() - 1
    done = out.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, everyone))
    short = queries.join(done, "query_id", "left_anti")
    if not short.limit(1).count():
        return out
    short = materialize(short, "ann-short")
    one = (F.lit(-1).alias("t"), F.lit(0).cast("long").alias("bucket"))
    again = classes.join(short.select(F.col("qcid").alias("cid")).distinct(), "cid", "left_semi")
    near = _search(classes.select("cid", "v", *one), again.select("cid", "v", *one), k + 1, block_rows)
    full = _answer(near, classes, short, k)
    return out.join(short.select("query_id"), "query_id", "left_anti").union(full)
