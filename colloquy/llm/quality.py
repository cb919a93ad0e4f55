"""Quality: histogram gradient-boosted trees over document statistics.

The statistics of a text come from its bytes and words in numpy. Trees are
grown level by level on binned statistics of a bounded labelled sample, and
flattened into complete arrays (feature, threshold, leaf) that score a batch
by index arithmetic, one step per level for all rows and trees.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import add_columns, arrow_map, text_chunks
from .toxicity import bounded_sample

SAMPLE_ROWS = 12_000
_KINDS = np.zeros(256, np.uint8)          # 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 stop mark, 6 symbol, 7 newline
for _lo, _hi, _k in ((0x21, 0x7F, 6), (0x61, 0x7B, 1), (0x41, 0x5B, 2), (0x30, 0x3A, 3), (0x80, 0x100, 0)):
    _KINDS[_lo:_hi] = _k
for _c, _k in ((" ", 4), ("\t", 4), ("\n", 7), (".", 5), (",", 5), (";", 5), (":", 5), ("?", 5)):
    _KINDS[ord(_c)] = _k

STATISTICS = ("log_bytes", "lower", "upper", "digit", "stop_mark", "symbol", "other", "log_words", "mean_word",
              "sd_word", "distinct_words", "top_word", "repeat_bigram", "repeat_5gram", "short_words", "long_words",
              "log_lines", "repeat_lines", "words_per_line", "double_symbol", "symbol_words", "words_per_stop",
              "log_sum_repeat", "log_symbols")


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: its distinct hashes, and the count of the most frequent one."""
    if not len(row):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (x[1:] != x[:-1])]))
    top = np.zeros(n)
    np.maximum.at(top, r[new], np.diff(np.append(new, len(r))))
    return np.bincount(r[new], minlength=n).astype(float), top


def _chunk_statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    n = len(offs) - 1
    size = np.diff(offs).astype(float)
    row_of = np.repeat(np.arange(n), np.diff(offs))
    kind = _KINDS[data]
    by_kind = np.bincount(row_of * 8 + kind, minlength=8 * n).reshape(n, 8).astype(float)
    w = W.split_words(data, offs)
    count = np.diff(w.first).astype(float)
    width = (w.end - w.start).astype(float)
    some = np.maximum(count, 1)
    mean = np.bincount(w.row, width, n) / some
    sd = np.sqrt(np.maximum(np.bincount(w.row, width * width, n) / some - mean * mean, 0))
    distinct, top = _distinct(w.row, w.hashes, n)
    repeats = []
    for k in (2, 5):
        g, r = W.ngrams(w, tuple(range(k)))
        total = np.bincount(r, minlength=n)
        repeats.append((total - _distinct(r, g, n)[0]) / np.maximum(total, 1))
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    start = edge[:-1].copy()
    start[1:] |= data[:-1] == 10
    begin = np.flatnonzero(start)
    end = np.append(begin[1:], len(data))
    line_row = np.searchsorted(offs, begin, "right") - 1
    lines = np.bincount(line_row, minlength=n).astype(float)
    line_distinct, _ = _distinct(line_row, W.span_hash(data.astype(np.uint64) + W.U64(7), begin, end), n)
    symbol = kind == 6
    pair = symbol.copy()
    pair[1:] &= symbol[:-1]
    pair[:1] = False
    pair[offs[:-1][offs[:-1] < len(data)]] = False
    pairs = np.bincount(row_of[pair], minlength=n)
    touch = np.zeros(len(w.end), bool)
    inside = w.end < len(data)
    touch[inside] = symbol[w.end[inside]] & ~edge[w.end[inside]]
    full = np.maximum(size, 1)
    stops = by_kind[:, 5]
    return np.column_stack([
        np.log1p(size), *(by_kind[:, k] / full for k in (1, 2, 3, 5, 6, 0)), np.log1p(count), mean, sd,
        distinct / some, top / some, *repeats, np.bincount(w.row, width <= 2, n) / some,
        np.bincount(w.row, width >= 14, n) / some, np.log1p(lines), (lines - line_distinct) / np.maximum(lines, 1),
        count / np.maximum(lines, 1), pairs / full, np.bincount(w.row, touch, n) / some,
        count / np.maximum(stops, 1), np.log1p(count - distinct), np.log1p(by_kind[:, 6])])


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per whole text; a null or empty text has zeros."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for i, j, data, offs in text_chunks(texts):
        if len(data):
            out[i:j] = _chunk_statistics(data, offs)
    return out


@dataclass
class Forest:
    """Complete trees of one depth as arrays: inner nodes in level order (feature, threshold), then leaves."""
    depth: int
    base: float
    feature: np.ndarray         # trees x (2**depth - 1)
    threshold: np.ndarray       # goes right where the statistic is larger
    leaf: np.ndarray            # trees x 2**depth

    def margin(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        return self.base + self.leaf[trees, node - (2 ** self.depth - 1)].sum(1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2,
         l2: float = 1.0, least: float = 1.0) -> Forest:
    """Boost logistic loss on binned columns; ``least`` is the smallest sum of second derivatives in a child."""
    n, d = x.shape
    if n == 0:
        return Forest(depth, 0.0, np.zeros((0, 2 ** depth - 1), np.int64), np.zeros((0, 2 ** depth - 1)), np.zeros((0, 2 ** depth)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(d)]
    binned = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p0 / (1 - p0)))
    margin = np.full(n, base)
    inner = 2 ** depth - 1
    feature, threshold, leaf = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.zeros(width)
            for f in range(d):
                at = (node - first) * bins + binned[:, f]
                gl = np.bincount(at, g, width * bins).reshape(width, bins).cumsum(1)
                hl = np.bincount(at, h, width * bins).reshape(width, bins).cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
                gain[(hl < least) | (ht - hl < least)] = 0
                gain = gain[:, :len(cuts[f])]
                if gain.shape[1] == 0:
                    continue
                k = gain.argmax(1)
                better = gain[np.arange(width), k] > best + 1e-9
                best = np.where(better, gain[np.arange(width), k], best)
                feature[t, first:first + width][better] = f
                threshold[t, first:first + width][better] = cuts[f][k[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        end = node - inner
        leaf[t] = -rate * np.bincount(end, g, inner + 1) / (np.bincount(end, h, inner + 1) + l2)
        margin += leaf[t, end]
    return Forest(depth, base, feature, threshold, leaf)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> Forest:
    """Grow a forest on at most ``sample_rows`` rows of ``labels`` (doc_id, label), with the texts of ``docs``.

    Only their statistics reach the driver (``sample_rows`` x 24 numbers at
    most if doc_id is unique in ``docs``). Rows of null id or label are left
    out; without any, every score is 0.5.
    """
    picked = bounded_sample(labels.where("doc_id is not null and label is not null"), sample_rows)
    data = (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
                .select("text", F.col("label").cast("double").alias("label"), F.xxhash64("doc_id", "text").alias("order")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = statistics(batch.column("text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("order"), batch.column("label"), pa.ListArray.from_arrays(
                np.arange(len(s) + 1, dtype=np.int32) * s.shape[1], s.ravel())], ["order", "label", "x"])
    got = arrow_map(data, run, "order long, label double, x array<double>") \
        .orderBy("order", "label").limit(sample_rows).toPandas()
    x = np.array(got["x"].tolist()).reshape(len(got), len(STATISTICS))
    return grow(x, got["label"].to_numpy(np.float64), **options)


def score(docs: DataFrame, forest: Forest, name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``name``: the chance of label 1 of each text; null and empty ones too.

    An empty table stays empty; a column called ``name`` is replaced.
    """
    return add_columns(docs, lambda b: [pa.array(forest.predict(statistics(b.column("text"))))], f"`{name}` double", keep)


def keep_good(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, all columns kept."""
    own = "__quality_score"
    return score(docs, forest, own).where(F.col(own) >= threshold).drop(own)
