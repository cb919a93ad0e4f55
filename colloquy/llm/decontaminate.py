"""Benchmark decontamination: Wu-Manber multi-pattern search with words as the alphabet.

The patterns are the 13-word windows of the benchmark items (an item of fewer
words is one window). A block is two consecutive words; the shift table holds,
for every block of a pattern, how far it lies before the pattern's end, and
all other blocks allow the full shift. A block of shift 0 selects, by its
suffix hash, the bucket of the windows that end in it; those of the same
hash over all words are then compared word for word. All cursors of a batch advance together in numpy, one cursor for every
stretch of 256 end positions. (With bytes as the alphabet a few thousand
windows leave no block of two or three letters absent, so nothing would be
skipped.)

The benchmark is searched in pattern blocks. A block's tables take about
``TABLE_SHARE`` bytes per byte of text (a window is kept as its place in the
text), ``TABLE_BYTES`` in all; that bounds what the driver builds and what
reaches a task, and more blocks mean more passes. Items stay whole: only a
single item of more bytes makes a larger block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import add_columns, materialize, text_chunks

WINDOW = 13
SHARE = 20                    # contaminated: at least 1 of 20 words is hit
TABLE_BYTES = 128 << 20
TABLE_SHARE = 18              # words of one letter and a space take 17 bytes of tables per byte, longer ones less
PASSES = 3                    # pattern blocks searched in one stage; each has a Python worker of its own
STRETCH = 256

HITS = "array<struct<start:long,stop:long>>"


@dataclass
class Patterns:
    """The different windows of one length, and the tables that find them. Window k is ``length`` words from word ``at[k]`` on."""
    length: int
    data: np.ndarray            # the lower-cased texts
    start: np.ndarray           # of each word of them
    end: np.ndarray
    blocks: np.ndarray          # sorted hash of each block
    shift: np.ndarray           # of each block
    bucket: np.ndarray          # bucket[b]:bucket[b + 1] are the windows that end in block b
    keys: np.ndarray            # hash of each window over all words, ascending within its bucket
    at: np.ndarray
    first_item: np.ndarray      # first_item[k]:first_item[k + 1] are the items of window k
    items: np.ndarray

    def spelled(self, k: int) -> list[bytes]:
        """The words of window k."""
        w = range(int(self.at[k]), int(self.at[k]) + self.length)
        return [self.data[self.start[i]:self.end[i]].tobytes() for i in w]


def table_bytes(groups: list[Patterns]) -> int:
    """The size of the tables of a block; its texts and their words are shared by all lengths."""
    return sum({id(x): x.nbytes for p in groups for x in vars(p).values() if isinstance(x, np.ndarray)}.values())


def _block_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return W.mix(left * W.U64(3) + right)


def _window_hash(h: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash over the ``length`` words from each place on."""
    acc = np.zeros(len(at), np.uint64)
    for k in range(length):
        acc = W.mix(acc * W.U64(5) + h[at + k])
    return acc


def build_patterns(items: list[tuple[int | None, str | None]], window: int = WINDOW) -> list[Patterns]:
    """The patterns of (item_id, text) rows, one group per window length. An item without words has none."""
    raw = [(text or "").encode() for _, text in items]
    data = np.frombuffer(b"".join(raw).lower(), np.uint8)      # bytes.lower touches A-Z only
    w = W.split_words(data, np.cumsum([0, *map(len, raw)]))
    start, end = w.start.astype(np.int32), w.end.astype(np.int32)
    count = np.diff(w.first)
    owner = np.array([-1 if i is None else i for i, _ in items], np.int64)
    known = np.array([i is not None for i, _ in items], bool)
    out = []
    for m in np.unique(np.minimum(count[count > 0], window)).tolist():
        mine = np.flatnonzero(np.minimum(count, window) == m)
        n = count[mine] - m + 1
        at = np.repeat(w.first[mine], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = np.repeat(mine, n)
        last = w.hashes[at] if m == 1 else _block_hash(w.hashes[at + m - 2], w.hashes[at + m - 1])
        key = _window_hash(w.hashes, at, m)
        order = np.lexsort((at, key, last))
        at, item, key, last = at[order], item[order], key[order], last[order]
        new = np.ones(len(at), bool)
        new[1:] = (key[1:] != key[:-1]) | (last[1:] != last[:-1])
        head = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
        for k in range(m):      # words that differ under one hash make windows of their own
            new |= w.hashes[at + k] != w.hashes[head + k]
        group = np.cumsum(new) - 1
        if m == 1:
            blocks = np.unique(last)
            shift = np.zeros(len(blocks), np.uint8)
        else:
            heads = at[new]
            best: tuple[np.ndarray, np.ndarray] | None = None
            for k in range(m - 1):          # the least distance from the end wins: later blocks replace earlier ones
                b = np.unique(_block_hash(w.hashes[heads + k], w.hashes[heads + k + 1]))
                s = np.full(len(b), m - 2 - k, np.uint8)
                if best is not None:
                    old = ~np.isin(best[0], b)
                    b, s = np.concatenate([best[0][old], b]), np.concatenate([best[1][old], s])
                by = np.argsort(b)
                best = b[by], s[by]
            blocks, shift = best
        pair = np.unique(np.stack([group[known[item]], owner[item[known[item]]]], 1), axis=0)
        out.append(Patterns(m, data, start, end, blocks, shift, np.searchsorted(last[new], np.append(blocks, W.U64(0xFFFFFFFFFFFFFFFF))).astype(np.int32),
                            key[new], at[new].astype(np.int32), np.searchsorted(pair[:, 0], np.arange(int(new.sum()) + 1)).astype(np.int32), pair[:, 1]))
        out[-1].bucket[-1] = int(new.sum())
    return out


def _find(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each x in ``sorted_keys``, -1 where it is absent."""
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == x, at, -1)


def _in_bucket(keys: np.ndarray, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the first key not below each x in its own range lo .. hi of ``keys``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        busy = np.flatnonzero(lo < hi)
        if not len(busy):
            return lo
        mid = (lo[busy] + hi[busy]) // 2
        low = keys[mid] < x[busy]
        lo[busy[low]] = mid[low] + 1
        hi[busy[~low]] = mid[~low]


def search(w: W.Words, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of the places in ``w`` whose words hash like a window's, found by shifting cursors."""
    m, full = p.length, max(1, p.length - 1)
    count = np.diff(w.first)
    long_enough = np.flatnonzero(count >= m)
    # End positions m - 1 .. count - 1 of each text, in stretches with a cursor each.
    ends = count[long_enough] - m + 1
    n_str = -(-ends // STRETCH)
    base = np.repeat(w.first[long_enough] + m - 1, n_str)
    nth = np.arange(n_str.sum()) - np.repeat(np.cumsum(n_str) - n_str, n_str)
    cursor = base + nth * STRETCH
    limit = np.minimum(cursor + STRETCH, np.repeat(w.first[long_enough + 1], n_str))
    places, windows = [], []
    while len(cursor):
        h = w.hashes[cursor] if m == 1 else _block_hash(w.hashes[cursor - 1], w.hashes[cursor])
        at = _find(p.blocks, h)
        step = np.where(at >= 0, p.shift[at].astype(np.int64), full)
        stop = np.flatnonzero(step == 0)
        if len(stop):
            begin = cursor[stop] - m + 1
            key = _window_hash(w.hashes, begin, m)
            lo, hi = p.bucket[at[stop]].astype(np.int64), p.bucket[at[stop] + 1].astype(np.int64)
            k = _in_bucket(p.keys, key, lo, hi)
            hit = (k < hi) & (p.keys[np.minimum(k, len(p.keys) - 1)] == key)
            places.append(begin[hit])
            windows.append(k[hit])
        cursor = cursor + np.maximum(step, 1)
        live = cursor < limit
        cursor, limit = cursor[live], limit[live]
    z = np.zeros(0, np.int64)
    return np.concatenate([*places, z]), np.concatenate([*windows, z])


def _scan(groups: list[Patterns], again: bool):
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        n_words, hits, items = [], [], []
        before = batch.column("hits").to_pylist() if again else None
        known = batch.column("items").to_pylist() if again else None
        for i, j, data, offs in text_chunks(batch.column("text")):
            w = W.split_words(data, offs)
            spans: dict[int, list] = {}
            seen: dict[int, set] = {}
            for p in groups:
                place, window = search(w, p)
                order = np.argsort(place, kind="stable")
                for at, k in zip(place[order].tolist(), window[order].tolist()):
                    # Direct comparison of the words themselves, with every window of the same hash.
                    here = [data[x:y].tobytes().lower() for x, y in zip(w.start[at:at + p.length], w.end[at:at + p.length])]
                    same = k
                    while same < len(p.keys) and p.keys[same] == p.keys[k] and p.spelled(same) != here:
                        same += 1
                    if same == len(p.keys) or p.keys[same] != p.keys[k]:
                        continue
                    r = int(w.row[at])
                    first = at - int(w.first[r])
                    spans.setdefault(r, []).append((first, first + p.length))
                    seen.setdefault(r, set()).update(p.items[p.first_item[same]:p.first_item[same + 1]].tolist())
            for r in range(j - i):
                s = spans.get(r, [])
                if before is not None:
                    s = s + [(x["start"], x["stop"]) for x in before[i + r]]
                joined: list[list[int]] = []
                for a, b in sorted(s):
                    if joined and a <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], b)
                    else:
                        joined.append([a, b])
                n_words.append(int(w.first[r + 1] - w.first[r]))
                hits.append([{"start": a, "stop": b} for a, b in joined])
                items.append(sorted(seen.get(r, set()) | set(known[i + r] if known else ())))
        return [pa.array(n_words, pa.int64()),
                pa.array(hits, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                pa.array(items, pa.list_(pa.int64()))]
    return run


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = TABLE_BYTES // TABLE_SHARE,
               keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words, hits and items of each text.

    ``hits`` are the merged word intervals [start, stop) that lie in an
    occurrence of a window, ``items`` the distinct ids of the items with an
    occurring window. Null or wordless texts have 0 words and no hits; items
    of null id count as hits but have no id to list; repeated items, items of
    equal text and repeated documents each count in their own row. An empty
    benchmark hits nothing. Columns of ``docs`` called n_words, hits or items
    are replaced; other columns of ``benchmark`` are not read.
    """
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_bytes))
    out = docs
    for b in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == b)
        groups = build_patterns([(r["item_id"], r["text"]) for r in part.collect()], window)
        cols = None if keep is None else [*keep, *(["text"] if b < blocks - 1 else [])]
        if b and b % PASSES == 0:
            out = materialize(out, "decontaminate")
        out = add_columns(out, _scan(groups, b > 0), f"n_words long, hits {HITS}, items array<long>", cols)
    return out


def judge(found: DataFrame, share: int = SHARE) -> DataFrame:
    """``find_items`` rows with n_hit, n_items, items_sha256 and contaminated in place of hits and items."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return (found.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long"),
                               "items_sha256": F.sha2(ids.cast("binary"), 256)})
                 .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
                 .drop("hits", "items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept."""
    own = F.struct(*docs.columns).alias("__row")
    found = judge(find_items(docs.select(own, F.col("text")), benchmark, keep=["__row"], **options))
    return found.where(~F.col("contaminated")).select("__row.*")
