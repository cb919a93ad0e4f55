"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, its bigrams and its
skip-grams (one word left out). The learner sees the features of a bounded sample
of the labelled rows, one text after another, with per-coordinate rates and L1; with several
shards each learns on its own rows and their weights are averaged. L1 leaves a
sparse vector of at most 2**bits weights, which bounds what the scoring tasks get.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import add_columns, arrow_map, text_chunks

BITS = 20
GRAMS = ((0,), (0, 1), (0, 2))
SAMPLE_ROWS = 16_000
SHARDS = 1


@dataclass(frozen=True)
class Settings:
    """FTRL-proximal: rate alpha / (beta + sqrt(sum of squared gradients)), penalties l1 and l2."""
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.1
    epochs: int = 6


def features(texts: pa.Array, bits: int = BITS,
             only: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row, feature) in runs: the distinct features of each text, in row order.

    ``only`` marks the features to give; the others need no sorting.
    """
    for i, j, data, offs in text_chunks(texts):
        w = W.split_words(data, offs)
        g = [W.ngrams(w, o) for o in GRAMS]
        f = np.concatenate([(h + W.U64(k)) >> W.U64(64 - bits) for k, (h, _) in enumerate(g)]).astype(np.int64)
        row = np.concatenate([r for _, r in g])
        if only is not None:
            row, f = row[only[f]], f[only[f]]
        key = np.unique((row << bits) | f)
        yield i, j, key >> bits, key & ((1 << bits) - 1)


def _learn(bits: int, s: Settings):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["order", "label"], kind="stable")
        y = part["label"].to_numpy(np.float64)
        docs = [np.asarray(x, np.int32) for x in part["x"]]
        z = np.zeros(1 << bits)
        n = np.zeros(1 << bits)
        z0 = n0 = 0.0
        for _ in range(s.epochs):
            for x, t in zip(docs, y):
                zi, ni = z[x], n[x]
                w = np.where(np.abs(zi) <= s.l1, 0.0,
                             -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2))
                w0 = -z0 / ((s.beta + n0 ** 0.5) / s.alpha + s.l2)
                g = 1 / (1 + np.exp(-np.clip(w.sum() + w0, -35, 35))) - t
                sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / s.alpha
                z[x] = zi + g - sigma * w
                n[x] = ni + g * g
                z0 += g - ((n0 + g * g) ** 0.5 - n0 ** 0.5) / s.alpha * w0
                n0 += g * g
        w = np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))
        at = np.flatnonzero(w)
        w0 = -z0 / ((s.beta + n0 ** 0.5) / s.alpha + s.l2)
        return pd.DataFrame({"feature": np.append(at, -1), "weight": np.append(w[at], w0)})
    return run


@dataclass
class Model:
    """Sorted features with their weights, and the bias. No feature at all scores by the bias."""
    feature: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS


def bounded_sample(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows of (doc_id, label) whose doc_id hashes lowest: the same ones on every run."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(n)


def training_rows(docs: DataFrame, labels: DataFrame, bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``sample_rows`` rows (order, label, x) to learn from, x the features of a text, made in the map tasks.

    Ids that repeat in ``docs`` or ``labels`` multiply in the join; of its rows
    those with the smallest hashes stay.
    """
    picked = bounded_sample(labels.where("doc_id is not null and label is not null"), sample_rows)
    # At most sample_rows rows of two numbers: bounded, so the texts need not move for the join.
    data = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    data = data.select(F.col("label").cast("double").alias("label"), F.coalesce("text", F.lit("")).alias("text"),
                       F.xxhash64("doc_id", "text").alias("order"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for i, j, row, f in features(batch.column("text"), bits):
            ends.append(ends[-1][-1] + np.searchsorted(row, np.arange(1, j - i + 1)))
            values.append(f.astype(np.int32))
        x = pa.ListArray.from_arrays(np.concatenate(ends).astype(np.int32), np.concatenate(values))
        return pa.RecordBatch.from_arrays([batch.column("order"), batch.column("label"), x], ["order", "label", "x"])
    return arrow_map(data, run, "order long, label double, x array<int>").orderBy("order", "label").limit(sample_rows)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), bits: int = BITS,
          sample_rows: int = SAMPLE_ROWS, shards: int = SHARDS) -> Model:
    """Learn from ``labels`` (doc_id, label 0 or 1) on the texts of ``docs``, from ``sample_rows`` rows at most.

    Rows of null id or label are left out; null texts are empty. Without any
    labelled row the model is all zero and scores 0.5 everywhere.
    """
    data = training_rows(docs, labels, bits, sample_rows)
    learned = (data.withColumn("shard", F.pmod("order", F.lit(shards)))
                   .groupBy("shard").applyInPandas(_learn(bits, settings), "feature long, weight double"))
    rows = learned.groupBy("feature").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("k")).toPandas()
    got = rows.loc[rows["feature"] == -1, "k"].sum()
    if not got:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0, bits)
    rows["weight"] /= got
    bias = float(rows.loc[rows["feature"] == -1, "weight"].sum())
    rows = rows[rows["feature"] >= 0].sort_values("feature")
    return Model(rows["feature"].to_numpy(np.int64), rows["weight"].to_numpy(), bias, bits)


def score_texts(texts: pa.Array, m: Model) -> np.ndarray:
    dense = np.zeros(1 << m.bits)
    dense[m.feature] = m.weight
    out = np.zeros(len(texts))
    for i, j, row, f in features(texts, m.bits, dense != 0):
        out[i:j] = np.bincount(row, dense[f], j - i)
    return 1 / (1 + np.exp(-np.clip(out + m.bias, -35, 35)))


def score(docs: DataFrame, model: Model, name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``name``: the chance of label 1 of each text; null and empty ones too.

    An empty table stays empty; a column called ``name`` is replaced.
    """
    return add_columns(docs, lambda b: [pa.array(score_texts(b.column("text"), model))], f"`{name}` double", keep)
