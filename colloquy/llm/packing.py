"""Best-fit packing with certified bin counts.

Pieces are dealt to parts of bounded size; each part is packed by best-fit
decreasing. Dual-feasible functions bound from below the bins that a part's
lengths need: a part whose bin count equals its bound is certified and stays.
The other parts, and the emptiest sequence of every part, give their
documents into an exchange, are dealt anew and packed again, as long as that
saves sequences.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

CAPACITY = 4096
PART_PIECES = 60_000
ROUNDS = 3


def lower_bound(length: np.ndarray, count: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that ``count`` items of each ``length`` need at least, by two families of dual-feasible functions.

    u_t (t up to capacity / 2): lengths above capacity - t weigh a whole bin,
    lengths below t nothing, others their own length. f_k: length x weighs
    x (k + 1) / capacity rounded down, in units of capacity / k, or its own
    length where that is whole. With f the weights, the sum over capacity is
    a bound; the identity is u_0.
    """
    if not len(length):
        return 0
    by = np.zeros(capacity + 1, np.int64)
    np.add.at(by, length, count)
    x = np.arange(capacity + 1)
    number, mass = np.cumsum(by), np.cumsum(by * x)
    t = np.arange(0, capacity // 2 + 1)
    below = np.where(t > 0, mass[np.maximum(t - 1, 0)], 0)
    whole = (number[-1] - number[capacity - t]) * capacity + (mass[capacity - t] - below)
    best = int(-(-whole.max() // capacity))
    for k in range(1, 32):
        scaled = x * (k + 1)
        f = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)   # in units of 1 / k
        best = max(best, int(-(-int((by * f).sum()) // (capacity * k))))
    return best


def best_fit_decreasing(length: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, longest first (ties in order given) into the fullest bin that has room."""
    bin_of, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]      # bins by free space
    free = 0                                                        # bit f set: some bin has f free
    bins = 0
    for i in np.argsort(-length, kind="stable").tolist():
        x = int(length[i])
        fit = free >> x
        if fit:
            f = x + (fit & -fit).bit_length() - 1
            b = room[f].pop()
            if not room[f]:
                free ^= 1 << f
        else:
            f, b = capacity, bins
            bins += 1
        bin_of[i], offset[i] = b, capacity - f
        left = f - x
        if left:
            room[left].append(b)
            free |= 1 << left
    return bin_of, offset, bins


def _pack_part(capacity: int, shift: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("uid", kind="stable")
        length = part["length"].to_numpy(np.int64)
        b, off, bins = best_fit_decreasing(length, capacity)
        load = np.bincount(b, length, bins).astype(np.int64)
        distinct, count = np.unique(length, return_counts=True)
        p = int(part["part"].iloc[0])
        return pd.DataFrame({"uid": part["uid"], "length": length, "part": p, "sequence_id": (p << 32) + shift + b,
                             "offset": off, "load": load[b], "emptiest": b == int(load.argmin()), "bins": bins,
                             "bound": lower_bound(distinct, count, capacity)})
    return run


_SCHEMA = ("uid long, length long, part long, sequence_id long, offset long, load long, emptiest boolean, "
           "bins long, bound long")


def _deal(items: DataFrame, n_items: int, part_pieces: int, base: int, capacity: int, salt: int) -> tuple[DataFrame, int]:
    parts = max(1, -(-n_items // part_pieces))
    dealt = items.select("uid", "length", (F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(parts)) + base).alias("part"))
    return dealt.groupBy("part").applyInPandas(_pack_part(capacity, 0), _SCHEMA), parts


def pack(items: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """(uid, sequence_id, offset) for rows of (uid, length), 1 <= length <= capacity.

    A sequence holds at most ``capacity`` and its pieces lie gapless from 0.
    uid must be unique (number repeated rows first). No rows give no rows.
    ``certificate`` tells how far the count lies above its bound.
    """
    n = items.count()
    packed, parts = _deal(items, n, part_pieces, 0, capacity, 0)
    packed = materialize(packed, "packed")
    base = parts
    done: list[DataFrame] = []
    for r in range(1, rounds):
        # One row per part, from which the gaps and the exchanged sequences follow.
        gap = (F.col("bins") > F.col("bound")) & (F.col("load") < capacity)
        leave = gap | (F.col("emptiest") & (F.col("load") < capacity))
        stat = packed.where(leave).agg(F.count(F.lit(1)), F.countDistinct("sequence_id")).first()
        if parts < 2 or not stat[0]:
            break
        again, parts = _deal(packed.where(leave), stat[0], part_pieces, base, capacity, r)
        again = materialize(again, "packed")
        now = again.agg(F.countDistinct("sequence_id")).first()[0]
        if now >= stat[1]:
            break
        done.append(packed.where(~leave))
        packed, base = again, base + parts
    for d in done:
        packed = packed.union(d)
    return packed.select("uid", "sequence_id", "offset")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(n_sequences, lower_bound) of rows with sequence_id and length; lengths are at most ``capacity`` distinct numbers."""
    spark = packed.sparkSession
    by = packed.groupBy("length").agg(F.count(F.lit(1)).alias("k")).toPandas()
    bound = lower_bound(by["length"].to_numpy(np.int64), by["k"].to_numpy(np.int64), capacity)
    n = packed.agg(F.countDistinct("sequence_id")).first()[0]
    return spark.createDataFrame([(n, bound)], "n_sequences long, lower_bound long")


def pack_documents(pieces: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    """``pieces`` (with a column length) with sequence_id and offset; columns of these names are replaced.

    The pieces are written once and numbered, so repeated rows and repeated or
    null ids keep a place of their own.
    """
    own = "__piece"
    numbered = materialize(pieces.drop("sequence_id", "offset").withColumn(own, F.monotonically_increasing_id()), "pieces")
    placed = pack(numbered.select(F.col(own).alias("uid"), "length"), capacity, **options)
    return numbered.join(placed.withColumnRenamed("uid", own), own).drop(own)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces that carry their ids: at most one capacity of ids per group."""
    return (packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
                  .select("sequence_id", F.flatten(F.col("p.ids")).alias("ids")))
