"""Secret scans: fixed patterns, and a randomness test battery for strings they miss.

A candidate is a run of 20 or more characters of the usual encodings that no
pattern covers, cut at an inner "=" (a name before its value). Its encoding is
the smallest known alphabet that holds it; a run that none holds (a key behind
a path) is split at the characters outside each alphabet.
The battery asks whether its symbols look uniformly drawn: chi-squared of the
symbol counts, runs about the middle symbol, and lag-1 serial correlation. A
candidate that fails is ordinary text. For one that passes, the evidence is
the likelihood ratio of uniform symbols to the corpus' own letter pairs: an
e-value under the hypothesis "text", which grows with length by itself. The
e-value form of the Benjamini-Hochberg rule, over all candidates of the
corpus, sets the least evidence at a false-discovery rate of ``rate``.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, arrow_map, materialize, text_chunks

# The base patterns, their least lengths, and the kinds in order.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "random")

LEAST = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
INNER = re.compile(r"[^=]{%d,}" % LEAST)
ALPHABETS = ("0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz",
             "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")
_INDEX = [{c: i for i, c in enumerate(a)} for a in ALPHABETS]
_SETS = [frozenset(a) for a in ALPHABETS]
_PARTS = [re.compile(f"[{re.escape(a)}]{{{LEAST},}}") for a in ALPHABETS]
LEAST_P = 0.001
RATE = 0.01
_STEP = 20                    # histogram cells per unit of log evidence

SPANS = "array<struct<start:int,kind:int,stop:int>>"
CANDS = "array<struct<start:int,stop:int,evidence:double>>"


def _tail(z: float) -> float:
    """Two-sided normal p-value."""
    return math.erfc(abs(z) / math.sqrt(2))


def battery(symbols: np.ndarray, size: int) -> float:
    """Bonferroni p-value of "uniform, independent symbols 0 .. size - 1" over the three tests."""
    n = len(symbols)
    if n < 2:
        return 1.0
    expected = n / size
    chi = float(((np.bincount(symbols, minlength=size) - expected) ** 2).sum() / expected)
    # A gamma variable of the statistic's exact mean and variance for n draws of equal chances, by its cube root.
    spread = 2 * (n - 1) / (9 * n * (size - 1))
    p_chi = 0.5 * math.erfc(((chi / (size - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(2 * spread))
    high = symbols >= size // 2
    n1, n2 = int(high.sum()), int(n - high.sum())
    p_runs = 1.0
    if n1 and n2:
        mean = 2 * n1 * n2 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        if var > 0:
            p_runs = _tail((1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var))
    else:
        p_runs = 2.0 ** (1 - n)
    x = symbols - symbols.mean()
    spread = float((x * x).sum())
    p_serial = 0.0 if spread == 0 else _tail((float((x[1:] * x[:-1]).sum()) / spread + 1 / n) * math.sqrt(n))
    return min(1.0, 3 * min(p_chi, p_runs, p_serial))


@dataclass
class TextModel:
    """Log chance of an ASCII character after another (row 0: at the start of a run), from counts of pairs."""
    logp: np.ndarray            # 128 x 128

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> "TextModel":
        inside = np.zeros(128, bool)
        inside[[ord(c) for c in sorted(set("".join(ALPHABETS)) | {"="})]] = True
        c = counts.astype(float)
        c[0] = c[~inside].sum(0) if (~inside).any() else 0
        c = (c + 1) * inside[None, :]
        return cls(np.log(np.where(inside[None, :], c / c.sum(1, keepdims=True), 1)))


def pair_counts(docs: DataFrame) -> np.ndarray:
    """128 x 128 counts of neighbouring ASCII characters over all texts; at most 16,384 sums reach the driver."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(128 * 128, np.int64)
        for _, _, data, offs in text_chunks(batch.column("text")):
            d = np.minimum(data, 127).astype(np.int32)
            one = np.ones(max(len(d) - 1, 0), bool)
            edge = offs[1:-1] - 1                   # the last byte of a text has no neighbour
            one[edge[(edge >= 0) & (edge < len(one))]] = False
            total += np.bincount((d[:-1] * 128 + d[1:])[one], minlength=128 * 128)
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "k"])
    rows = arrow_map(docs.select("text"), run, "pair long, k long").groupBy("pair").agg(F.sum("k").alias("k")).toPandas()
    out = np.zeros(128 * 128, np.int64)
    out[rows["pair"].to_numpy(np.int64)] = rows["k"].to_numpy(np.int64)
    return out.reshape(128, 128)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) in code points of the patterns' matches, leftmost and not overlapping within a kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def parts(run: str) -> list[tuple[int, int, int, int]]:
    """(start, end of the symbols, stop, encoding) of what is tested of a run of ``CANDIDATE`` characters.

    An inner "=" ends a name, so the run is cut there; trailing ones are
    padding. What no alphabet holds as a whole is split at the characters
    outside each alphabet in turn, so parts of two alphabets can overlap.
    """
    out = set()
    end = len(run.rstrip("="))
    for m in INNER.finditer(run, 0, end):
        pieces = [m.span()] if _encoding(m[0]) is not None else \
            [x.span() for p in _PARTS for x in p.finditer(run, m.start(), m.end())]
        for s, e in pieces:
            out.add((s, e, len(run) if e == end else e, _encoding(run[s:e])))
    return sorted(out)


def _encoding(symbols: str) -> int | None:
    held = set(symbols)
    return next((k for k, a in enumerate(_SETS) if held <= a), None)


def _uncovered(s: int, e: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What the patterns' spans leave of s .. e."""
    out = []
    for a, _, b in base:
        if a < e and s < b:
            if s < a:
                out.append((s, a))
            s = max(s, b)
    if s < e:
        out.append((s, e))
    return out


def candidates(text: str, base: list[tuple[int, int, int]], model: TextModel) -> list[tuple[int, int, float]]:
    """(start, stop, log evidence) of the uncovered candidates that pass the battery."""
    out = []
    for m in CANDIDATE.finditer(text):
        for at, to in _uncovered(m.start(), m.end(), base):
            if to - at < LEAST:
                continue
            for s, end, e, enc in parts(text[at:to]):
                size = len(ALPHABETS[enc])
                index = _INDEX[enc]
                run = text[at + s:at + end]
                if battery(np.array([index[c] for c in run]), size) < LEAST_P:
                    continue
                code = np.frombuffer(run.encode(), np.uint8)
                # A part inside the run follows its real neighbour, a whole run the row of starts.
                first = ord(text[at + s - 1]) if at + s > m.start() else 0
                before = np.concatenate([[first], code[:-1]])
                out.append((at + s, at + e, float(-len(run) * math.log(size) - model.logp[before, code].sum())))
    return out


def scan(docs: DataFrame, model: TextModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``base`` and ``cands`` of every whole text (null: none)."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        base, cands = [], []
        for t in batch.column("text").to_pylist():
            b = base_spans(t or "")
            base.append([{"start": x, "kind": k, "stop": y} for x, k, y in b])
            cands.append([{"start": x, "stop": y, "evidence": v} for x, y, v in candidates(t or "", b, model)])
        i = pa.int32()
        return [pa.array(base, pa.list_(pa.struct([("start", i), ("kind", i), ("stop", i)]))),
                pa.array(cands, pa.list_(pa.struct([("start", i), ("stop", i), ("evidence", pa.float64())])))]
    return add_columns(docs, run, f"base {SPANS}, cands {CANDS}", keep)


def least_evidence(scanned: DataFrame, rate: float = RATE) -> float:
    """Log evidence a candidate needs: e-BH over all candidates, on a histogram of at most some thousand cells.

    With m candidates, k of which reach t, those are reported for the lowest
    t with e**t >= m / (rate * k). No candidate at all: infinity.
    """
    cell = F.floor(F.least(F.greatest(F.col("c.evidence"), F.lit(-50.0)), F.lit(200.0)) * _STEP)
    rows = (scanned.select(F.explode("cands").alias("c")).groupBy(cell.alias("cell"))
                   .agg(F.count(F.lit(1)).alias("k")).collect())
    cells = sorted(((r["cell"], r["k"]) for r in rows), reverse=True)
    m = sum(k for _, k in cells)
    above, best = 0, math.inf
    for c, k in cells:
        above += k
        if c / _STEP >= math.log(m / (rate * above)):
            best = c / _STEP
    return best


def all_spans(least: float):
    """Column: the base spans and the candidates of enough evidence, by start, then kind."""
    added = F.transform(F.filter("cands", lambda c: c["evidence"] >= F.lit(least)),
                        lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"),
                                           c["stop"].alias("stop")))
    return F.array_sort(F.concat("base", added))


def spelled(spans):
    """Column: kind:start:end, comma-joined."""
    kind = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s["kind"]), s["start"].cast("string"),
                                                                 s["stop"].cast("string"))), ",")


def find_secrets(docs: DataFrame, rate: float = RATE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` with ``base`` and ``spans`` (start, kind, stop) of each text.

    Null and empty texts have none. Repeated rows are scanned each; other
    columns are not read. An empty table gives no rows.
    """
    scanned = materialize(scan(docs, TextModel.of_counts(pair_counts(docs)), list(keep)), "secrets")
    return scanned.withColumn("spans", all_spans(least_evidence(scanned, rate))).drop("cands")


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind and spelled spans of ``find_secrets`` rows."""
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.withColumns({"n_assign": n(0), "n_access": n(1), "n_hex": n(2),
                              "base_sha256": F.sha2(spelled(F.col("base")).cast("binary"), 256),
                              "spans": spelled(F.col("spans"))}).drop("base")


def cut_spans(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with each merged run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rate: float = RATE, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; all rows and columns stay, null texts too.

    An ``n_chars`` column is set to the length of the new text.
    """
    model = TextModel.of_counts(pair_counts(docs))
    least = least_evidence(scan(docs.select("text"), model, []), rate)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for t in batch.column("text").to_pylist():
            if t:
                b = base_spans(t)
                spans = [(s, e) for s, _, e in b] + [(s, e) for s, e, v in candidates(t, b, model) if v >= least]
                t = cut_spans(t, spans, mark) if spans else t
            out.append(t)
        return [pa.array(out, pa.string())]
    cols = docs.columns
    out = add_columns(docs, run, "text string")
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*cols)

