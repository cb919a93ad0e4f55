"""Centroid clustering with geometric drift tightening.

Vectors are integers, so sums, distances and ties are exact. Every vector
carries its cluster, an upper bound of the distance to its own centroid and a
lower bound of the distance to every other one. When the centroids move, the
vectors of cluster i lie in the sphere around its old centroid that their
upper bounds give. Over that sphere |x - c| - |x - c'|, what a centroid's move
from c to c' can cost, depends on two coordinates alone, those along the move
and off its line: it is at most

* move * cos(the least angle at the middle of the move between its direction and the sphere), by the
  asymptotes of the hyperbolas with foci c and c',
* twice the sphere's furthest reach past the middle, by their vertices,
* minus move * cos(the greatest angle at c between the way back and the sphere), where the sphere lies
  behind c: the bound rises,

so lower bounds are loosened by less than the full move. A vector whose upper
bound, first moved by its own centroid's drift, then measured, does not fall
below its lower bound is ambiguous and scanned against all centroids exactly.

Vectors and bounds are a table written once a round in the shared folder (the
round before it is dropped); a round is one pass of it. Centroids, spheres and
loosenings (k x k numbers) are all that the driver holds. New centroids come
from the rows that changed cluster: sums of those that came, less those that
left, added up in the tasks first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_table
from .common import add_columns, arrow_map, materialize

LIMIT = 1 << 27               # components are kept within +-LIMIT, so that squared distances fit 64 bits
LONG_MAX = (1 << 63) - 1
SLACK = 1e-9                  # bounds give way by this share, far more than their rounding
STATE = "cluster int, was int, upper double, lower double, scans int"


@dataclass
class Moves:
    """What a round's tasks need: the centroids, and how the last move changes the bounds of each cluster."""
    centroids: np.ndarray       # k x dimensions, integers
    drift: np.ndarray           # of each centroid
    loosen: np.ndarray          # of the lower bounds of each cluster


def integer_vectors(table: DataFrame, dims: int, scale: int = 256) -> DataFrame:
    """(vec_id, v) of the vectors of ``dims`` components, none null, NaN or infinite; v = floor(scale * x), x as double.

    Other vectors take no part. Values beyond +-2**27 become that bound.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = (F.size("embedding") == dims) & F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    floor = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    return table.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), floor.alias("v"))


def _matrix(col: pa.ListArray, rows: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of matching rows."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest, its squared distance, the second least squared distance) of every row; ties go to the smaller number."""
    best = np.full(len(x), LONG_MAX)
    second = best.copy()
    at = np.zeros(len(x), np.int32)
    for j, c in enumerate(centroids):
        d = squared(x, c[None])
        nearer = d < best
        second = np.where(nearer, best, np.minimum(second, d))
        at[nearer] = j
        best = np.where(nearer, d, best)
    return at, best, second


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For every cluster, the most that a distance from its sphere to another centroid can have shrunk (negative: it grew)."""
    k = len(old)
    out = np.zeros(k)
    c, move = old.astype(np.float64), (new - old).astype(np.float64)
    drift = np.sqrt((move ** 2).sum(1))
    for i in range(k):
        worst = -math.inf
        for j in range(k):
            if j == i:
                continue
            p = drift[j]
            if p == 0:
                worst = max(worst, 0.0)
                continue
            rel = c[i] - c[j]
            along = float(rel @ move[j]) / p
            off = math.sqrt(max(0.0, float(rel @ rel) - along * along))
            worst = max(worst, sphere_loss(along, off, float(radius[i]), float(p)) + SLACK * (1 + p + math.hypot(along, off)))
        out[i] = worst if k > 1 else 0.0
    return out


def sphere_loss(along: float, off: float, radius: float, move: float) -> float:
    """An upper bound of |x - c| - |x - c'| over a sphere whose centre lies ``along`` the move from c and ``off`` its line."""
    ahead = along - move / 2
    far = math.hypot(ahead, off)
    bound = min(move, max(0.0, 2 * (ahead + radius)))
    if far > radius:
        angle = math.atan2(off, ahead) - math.asin(min(1.0, radius / far))
        bound = min(bound, max(0.0, move * math.cos(max(0.0, angle))))
    back = math.hypot(along, off)
    if back > radius:
        angle = math.atan2(off, -along) + math.asin(min(1.0, radius / back))
        if angle < math.pi / 2:
            bound = min(bound, -move * math.cos(angle))
    return bound


def _first(centroids: np.ndarray):
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        at, best, second = scan(_matrix(batch.column("v"), batch.num_rows), centroids)
        n = len(at)
        return [pa.array(at), pa.array(np.full(n, -1, np.int32)), pa.array(np.sqrt(best.astype(np.float64)) * (1 + SLACK)),
                pa.array(np.sqrt(second.astype(np.float64)) * (1 - SLACK)), pa.array(np.ones(n, np.int32))]
    return run


def _again(m: Moves):
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        x = _matrix(batch.column("v"), batch.num_rows)
        was = batch.column("cluster").to_numpy(zero_copy_only=False)
        scans = batch.column("scans").to_numpy(zero_copy_only=False).copy()
        upper = batch.column("upper").to_numpy(zero_copy_only=False) + m.drift[was] * (1 + SLACK)
        lower = np.maximum(batch.column("lower").to_numpy(zero_copy_only=False) - m.loosen[was], 0.0)
        at = was.copy()
        open_ = np.flatnonzero(upper >= lower)
        upper[open_] = np.sqrt(squared(x[open_], m.centroids[was[open_]]).astype(np.float64)) * (1 + SLACK)
        open_ = open_[upper[open_] >= lower[open_]]
        if len(open_):
            near, best, second = scan(x[open_], m.centroids)
            at[open_] = near
            upper[open_] = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
            lower[open_] = np.sqrt(second.astype(np.float64)) * (1 - SLACK)
            scans[open_] += 1
        return [pa.array(at), pa.array(was), pa.array(upper), pa.array(lower), pa.array(scans)]
    return run


def _change(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, component sums) by which the clusters changed with the last assignment; exact, a row per cluster."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column("v"), batch.num_rows)
        n, s = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for name, sign in (("cluster", 1), ("was", -1)):
            c = batch.column(name).to_numpy(zero_copy_only=False)
            here = c >= 0
            n += sign * np.bincount(c[here], minlength=k)
            np.add.at(s, c[here], sign * x[here])
        some = np.flatnonzero((n != 0) | s.any(1))
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]),
                                           pa.array(list(s[some]), pa.list_(pa.int64()))], ["cluster", "n", "s"])
    moved = state.where("cluster <> was").select("v", "cluster", "was")
    parts = arrow_map(moved, run, "cluster int, n long, s array<long>")
    sums = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    count, total = [0] * k, [[0] * dims for _ in range(k)]
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():      # a row per cluster
        count[r["cluster"]] = r["n"]
        total[r["cluster"]] = [int(r[f"s{i}"]) for i in range(dims)]
    return np.array(count, object), np.array(total, object).reshape(k, dims)


def cluster(vectors: DataFrame, centroids: list[list[int]], rounds: int) -> tuple[DataFrame, np.ndarray]:
    """Lloyd's rounds from the given centroids: (rows, final centroids).

    The rows are (vec_id, v, cluster, distance, scans): all ``vectors``
    (vec_id, v: integers of equal dimension), the nearest final centroid (ties:
    the smaller number), the squared distance to it and how often the vector
    was scanned against all centroids. Repeated rows and ids each count. A
    centroid without vectors stays. No centroids: no rows.
    """
    if not centroids:
        return vectors.where("false").selectExpr("vec_id", "v", "0 cluster", "0L distance", "0 scans"), np.zeros((0, 0), np.int64)
    c = np.array(centroids, np.int64)
    k, dims = c.shape
    state = materialize(add_columns(vectors, _first(c), STATE, ["vec_id", "v"]), "clusters")
    count, total = np.zeros(k, object), np.zeros((k, dims), object)
    for _ in range(rounds):
        n, s = _change(state, k, dims)
        count, total = count + n, total + s
        radius = np.zeros(k)
        for r in state.groupBy("cluster").agg(F.max("upper").alias("r")).collect():         # a row per cluster
            radius[r["cluster"]] = r["r"]
        new = np.array([[t // int(count[j]) for t in total[j]] if count[j] else c[j].tolist() for j in range(k)], np.int64)
        drift = np.sqrt(((new - c).astype(np.float64) ** 2).sum(1))
        moves = Moves(new, drift, loosening(c, new, radius))
        old, state, c = state, materialize(add_columns(state, _again(moves), STATE, ["vec_id", "v"]), "clusters"), new
        drop_table(old)

    def measure(batch: pa.RecordBatch) -> list[pa.Array]:
        own = batch.column("cluster").to_numpy(zero_copy_only=False)
        return [pa.array(squared(_matrix(batch.column("v"), batch.num_rows), c[own]))]
    return add_columns(state, measure, "distance long", ["vec_id", "v", "cluster", "scans"]), c


def first_by_hash(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``salt`` and the vec_id (null: empty), ties by components; k rows reach the driver."""
    h = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [list(r["v"]) for r in vectors.select("v", h.alias("h")).orderBy("h", "v").limit(k).collect()]


def with_inertia(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``rows`` with cluster_inertia, inertia (sums of distance, at most 2**63 - 1) and centroid_sha256."""
    spark = rows.sparkSession
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("t")).collect()     # a row per cluster
    per = {r["cluster"]: int(r["t"]) for r in sums}
    values = [(j, min(t, LONG_MAX), min(sum(per.values()), LONG_MAX), ",".join(map(str, centroids[j].tolist()))) for j, t in per.items()]
    side = spark.createDataFrame(values, "cluster int, cluster_inertia long, inertia long, spelled string")
    return (rows.join(F.broadcast(side), "cluster")
                .withColumn("centroid_sha256", F.sha2(F.col("spelled").cast("binary"), 256)).drop("spelled"))
