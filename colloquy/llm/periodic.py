"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q and a length
of at least max(6, 4 q) that no neighbouring word extends.

Periods below ``SHORT`` are scanned lag by lag: stretches of i with
word[i] = word[i + q]. For every scale W = SHORT / 2, SHORT, 2 SHORT, ...
periods 2 W <= q < 4 W are seeded by minimizers of W-grams:

* Only W-grams that occur again in their text matter. Of equal ones closer
  than W the first alone stays, so a window of W positions holds no ties.
* The least hash of every window of W positions is its minimizer. Inside a
  run that choice depends on 4 W - 3 words, so it repeats at distance q.
* Equal minimizers at a distance of 2 W to 4 W - 1, at most two of the same
  value between them, are seeds. Each is extended, word by word, to the
  longest stretch of its lag.

Nothing is missed: a run of 4 q words leaves q + 4 places whose own and whose
partner's choice depend on the run alone. One of them is a critical position
of the period (the repetition centred there is q long), so no equal W-gram
lies less than W before it, and the least hash of those positions is the
minimizer of each of its windows. Stretches whose lag is a multiple of a
shorter period coincide with the shorter one's run and are left out.

Words are compared as numbers that are equal exactly for equal bytes; grams
are seeds by a 64-bit hash, their stretches are compared word by word. A text
is read whole, in one task; texts do not meet, so nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import add_columns, text_chunks

SHORT = 16
LEAST = 6                     # words of a run, and
REPEATS = 4                   # periods of a run, at least
SLICE = 4 << 20
RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the words ``[^\\x20\\x09-\\x0D]+``; ``first[i]:first[i + 1]`` are those of text i."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    stop[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(start, offsets)


def _slices(start: np.ndarray, end: np.ndarray):
    """Consecutive words of about ``SLICE`` bytes together."""
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SLICE, "right")))
        yield i, j
        i = j


def word_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word, equal exactly where the bytes are equal."""
    if not len(start):
        return np.zeros(0, np.int64)
    hashes = np.concatenate([W.span_hash(W._LETTER[data[start[i]:end[j - 1]]], start[i:j] - start[i], end[i:j] - start[i])
                             for i, j in _slices(start, end)])
    codes = pd.factorize(hashes)[0].astype(np.int64)
    newest = np.maximum.accumulate(codes)
    like = np.flatnonzero(np.diff(newest, prepend=-1) > 0)[codes]      # the first word of the same hash
    size = end - start
    same = bool((size == size[like]).all())
    for i, j in _slices(start, end) if same else ():
        n = size[i:j]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        same = same and bool((data[np.repeat(start[i:j], n) + within] == data[np.repeat(start[like[i:j]], n) + within]).all())
    if same:
        return codes
    known: dict[bytes, int] = {}        # two words share a hash: number them by their bytes
    return np.array([known.setdefault(data[s:e].tobytes(), len(known)) for s, e in zip(start, end)], np.int64)


def _stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) of the stretches of consecutive numbers in ``at``."""
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) != 1) + 1
    s, e = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]])
    return at[s], e - s


def _slide(x: np.ndarray, width: int, fold, back: bool) -> np.ndarray:
    """``fold`` of each ``width`` (a power of 2) neighbours from a place on, or up to it."""
    step = 1
    while step < width:
        y = x.copy()
        if back:
            fold(x[step:], x[:-step], out=y[step:])
        else:
            fold(x[:-step], x[step:], out=y[:-step])
        x, step = y, step * 2
    return x


def repeated(h: np.ndarray) -> np.ndarray:
    """The places whose value occurs again, and by chance a few others."""
    bits = len(h).bit_length() + 2
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    return np.flatnonzero((np.bincount(slot, minlength=1 << bits) > 1)[slot])


def minimizers(h: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of the minimizers among the places ``at`` of ``h``, by value and place."""
    at = at[np.argsort(h[at], kind="stable")]
    v = h[at]
    near = np.zeros(len(at), bool)
    near[1:] = (v[1:] == v[:-1]) & (np.diff(at) < width)
    at, v = at[~near], v[~near]
    if not len(at):
        return at, v
    dense = np.full(len(h), _TOP)
    dense[at] = v
    least = _slide(dense, width, np.minimum, False)
    chosen = _slide(least, width, np.maximum, True)[at] == v
    return at[chosen], v[chosen]


def _seeds(h: np.ndarray, among: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the equal minimizers 2 to 4 widths apart."""
    at, v = minimizers(h, among, width)
    places, lags = [], []
    for j in (1, 2, 3):
        d = at[j:] - at[:-j]
        ok = (v[j:] == v[:-j]) & (d >= 2 * width) & (d < 4 * width)
        places.append(at[:-j][ok])
        lags.append(d[ok])
    return np.concatenate(places), np.concatenate(lags)


def _agree(a: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on (``step`` 1) or before it (-1) equal those a lag later."""
    n, size = 0, 64
    while True:
        if step > 0:
            lo, hi = at + n, min(at + n + size, len(a) - lag)
            bad = np.flatnonzero(a[lo:hi] != a[lo + lag:hi + lag]) if hi > lo else ()
        else:
            lo, hi = max(at - n - size, 0), at - n
            bad = np.flatnonzero((a[lo:hi] != a[lo + lag:hi + lag])[::-1])
        if len(bad):
            return n + int(bad[0])
        n += max(hi - lo, 0)
        if hi - lo < size:
            return n
        size *= 2


def _extend(a: np.ndarray, at: np.ndarray, lag: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, lag) of the stretches of REPEATS lags or more around the seeds."""
    # A stretch of 3 lags reaches 1.5 lags from the seed on one side: probes there rule out most others.
    front, behind = np.ones(len(at), bool), np.ones(len(at), bool)
    for k in range(1, 7):
        x = at + k * lag // 4
        front &= (x + lag < len(a)) & (a[np.minimum(x, len(a) - 1)] == a[np.minimum(x + lag, len(a) - 1)])
        x = at - k * lag // 4
        behind &= (x >= 0) & (a[np.maximum(x, 0)] == a[np.maximum(x, 0) + lag])
    at, lag = at[front | behind], lag[front | behind]
    out, now, done = [], 0, 0
    for i in np.lexsort((at, lag)):
        m, d = int(at[i]), int(lag[i])
        if d == now and m < done:
            continue
        lo, done, now = m - _agree(a, m, d, -1), m + _agree(a, m, d, 1), d
        if done - lo >= (REPEATS - 1) * d:
            out.append((lo, done - lo + d, d))
    return out


def find_runs(numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run, by text, start and period; ``first`` as of ``spaced_words``."""
    n = len(first) - 1
    count = np.diff(first)
    # One array of all texts, a number of its own after each.
    text = np.repeat(np.arange(n), count + 1)
    base = first[:-1] + np.arange(n)
    a = np.empty(len(numbers) + n, np.int64)
    a[np.arange(len(numbers)) + np.repeat(np.arange(n), count)] = numbers
    a[base + count] = -1 - np.arange(n)
    found = []
    for q in range(1, min(SHORT, len(a))):
        s, m = _stretches(np.flatnonzero(a[:-q] == a[q:]))
        ok = m >= max(LEAST, REPEATS * q) - q
        found.append(np.stack([s[ok], m[ok] + q, np.full(int(ok.sum()), q)], 1))
    place = np.arange(len(a))
    width, h = 1, W.mix(a.astype(W.U64) * W.U64(W._BASE) + W.mix(text.astype(W.U64) + W.U64(1)))
    while True:
        # Texts that are too short for the next periods, or hold no gram twice, are left behind.
        keep = count[text] >= REPEATS * 4 * width
        if width >= SHORT // 2:
            among = repeated(h)
            at, lag = _seeds(h, among, width)
            one = place[np.minimum(at + lag, len(place) - 1)] - place[at] == lag      # both in one text
            found += [np.array(x) for x in [_extend(a, place[at[one]], lag[one])] if x]
            twice = np.zeros(n, bool)
            twice[text[among]] = True
            keep &= twice[text]
        text, place, h = text[keep], place[keep], h[keep]
        if not len(h):
            break
        behind = np.concatenate([h[width:], W.mix(np.arange(min(width, len(h)), dtype=W.U64) + W.U64(width))])
        h, width = W.mix(h * W.U64(3) + behind), width * 2
    runs = np.concatenate([*found, np.zeros((0, 3), np.int64)]).astype(np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[new]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    doc = np.searchsorted(base, runs[:, 0], "right") - 1
    return doc, runs[:, 0] - base[doc], runs[:, 1], runs[:, 2]


def _scan(batch: pa.RecordBatch) -> list[pa.Array]:
    n_words, runs, kept = [], [], []
    for i, j, data, offs in text_chunks(batch.column("text")):
        start, end, first = spaced_words(data, offs)
        doc, at, length, period = find_runs(word_numbers(data, start, end), first)
        cuts = np.searchsorted(doc, np.arange(j - i + 1))
        for r in range(j - i):
            words = data[offs[r]:offs[r + 1]].tobytes().split()
            n_words.append(len(words))
            mine = slice(cuts[r], cuts[r + 1])
            rows = list(zip(at[mine].tolist(), length[mine].tolist(), period[mine].tolist()))
            if rows:
                turn = np.zeros(len(words) + 1, np.int64)
                for s, n, q in rows:
                    turn[s + q] += 1
                    turn[s + n] -= 1
                words = [words[k] for k in np.flatnonzero(np.cumsum(turn[:-1]) == 0).tolist()]
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in rows])
            kept.append(b" ".join(words))
    return [pa.array(n_words, pa.int64()), pa.array(runs, _RUN_TYPE), pa.array(kept, pa.binary()).cast(pa.string())]


def periodic_runs(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words, runs and collapsed of each text.

    ``runs`` are all periodic runs (start word, length, period) by start, then
    period; ``collapsed`` holds the words that no run contains after its first
    period, joined by single spaces. Null, empty and blank texts have 0 words,
    no runs and an empty ``collapsed``; repeated rows and ids each count in
    their own row; columns named n_words, runs or collapsed are replaced.
    """
    return add_columns(docs, _scan, f"n_words long, runs {RUNS}, collapsed string", keep)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly (ties: the first); null without runs."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, lambda best, x: F.when(
        best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): by the contract of op13, a tenth of the texts repeat a stretch of their own words to the end.

    h is the CRC-32 of the doc_id as text (null: of the empty text). Texts of
    other remainders and texts without words stay as they are.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    out = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    out = out.withColumn("n", F.when(F.size("w") > 0, F.size("w").cast("long")))
    out = out.withColumn("a", F.pmod("g", "n"))
    out = out.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.pmod("g", F.lit(8)))))
    word = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
                       lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int")))
    return out.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(word, " ")).otherwise(F.col("text")).alias("text"))
