"""Language identification by selected byte n-grams.

Features are byte strings of 1 to 4 bytes. For a gram g, ``score(g, l)`` is
the information (in nats) that its presence in a document gives about whether
the document is of language l, less what it gives about the document's source:
grams that tell subjects or sites apart are not features. The best
``per_lang`` grams of every language make a model of fixed size, a
multinomial naive Bayes table with add-one smoothing.

Documents are cut into grams inside Arrow batches, and counts are added up in
the task before they are shuffled. A text is labelled in the map task that
scans it: the model travels with the task, and no gram becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .positional import top_k_per_group

ORDERS = (1, 2, 3, 4)
PER_LANG = 300
CHUNK_BYTES = 1 << 20
HELD_ROWS = 1_000_000
GIVEN_ROWS = 100_000
CELLS = 8_000_000
TABLE_CELLS = 1 << 26       # bytes of a table of texts by grams
CODE = (1 << 36) - 1


@dataclass
class ByteModel:
    """Weights of ``grams`` (their codes in order) for each language; ``prior`` by language."""
    langs: list
    prior: np.ndarray
    grams: np.ndarray
    weights: np.ndarray         # grams x languages


def text_bytes(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts; a null text is empty, a long one a run of its own."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    offs = np.frombuffer(col.buffers()[1], np.int64, count=n + 1 + col.offset)[col.offset:]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + CHUNK_BYTES, "right")) - 1))
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def gram_codes(data: np.ndarray, row: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, row) of every gram of ``order`` bytes that lies in one text; a code is the order and the bytes as one number."""
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.full(n, order, np.int64)
    code <<= 32
    for k in range(order):
        code += data[k:n + k].astype(np.int64) << (8 * (order - 1 - k))
    one = row[:n] == row[order - 1:]
    return code[one], row[:n][one]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, uniques = pd.factorize(keys)
    return uniques, np.bincount(codes, weights=counts, minlength=len(uniques)).astype(np.int64)


def _documents_of(code: np.ndarray, row: np.ndarray, label: np.ndarray, cells: int = TABLE_CELLS) -> tuple[np.ndarray, np.ndarray]:
    """(label and gram as one number, texts that hold it) of the grams at all places; ``label`` by text, a gram of a text counts once.

    The texts that hold a gram are marked in a table of texts by grams; many short texts, whose table has more
    than ``cells`` cells, are hashed.
    """
    ids, grams = pd.factorize(code)
    width = max(1, len(grams))
    if len(label) * width > cells:
        pair = pd.unique((row << 36) + code)
        return _summed((label[pair >> 36] << 36) + (pair & CODE), np.ones(len(pair)))
    there = np.zeros(len(label) * width, bool)
    there[row * width + ids] = True
    names, of = np.unique(label, return_inverse=True)
    at = np.flatnonzero(there)
    n = np.bincount(of[at // width] * width + at % width, minlength=len(names) * width)
    some = np.flatnonzero(n)
    return (names[some // width] << 36) + grams[some % width], n[some]


def _occurrences(at: np.ndarray, row: np.ndarray, label: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(label and gram as one number, places) of the places of ``grams[at]``; ``label`` by text."""
    names, of = np.unique(label, return_inverse=True)
    if len(names) * len(grams) > CELLS:
        return _summed((label[row] << 36) + grams[at], np.ones(len(at)))
    n = np.bincount(of[row] * len(grams) + at, minlength=len(names) * len(grams))
    some = np.flatnonzero(n)
    return (names[some // max(1, len(grams))] << 36) + grams[some % max(1, len(grams))], n[some]


def _counted(corpus: DataFrame, labels: list[str], orders: tuple, per_document: bool, wanted: np.ndarray | None = None,
             held_rows: int = HELD_ROWS) -> DataFrame:
    """(labels..., code, n) of ``corpus`` (labels..., text): occurrences of grams, or documents that hold them.

    Counts are added up in the task, and handed on before they grow past ``held_rows``.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in labels]
                          + [T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, int] = {}
        table = None if wanted is None else GramTable(wanted)
        keys, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

        def give(k: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            names = [pa.array([x[c] for x in known], pa.string()) for c in range(len(labels))]
            for i in range(0, len(k), GIVEN_ROWS):
                some, at = k[i:i + GIVEN_ROWS], pa.array(k[i:i + GIVEN_ROWS] >> 36)
                yield pa.RecordBatch.from_arrays([*(x.take(at) for x in names), pa.array(some & CODE), pa.array(n[i:i + GIVEN_ROWS])],
                                                 schema.fieldNames())
        for b in batches:
            label = [known.setdefault(x, len(known)) for x in zip(*(b.column(c).to_pylist() for c in labels))]
            for i, j, data, offs in text_bytes(b.column("text")):
                row = np.repeat(np.arange(j - i), np.diff(offs))
                mine = np.array(label[i:j], np.int64)
                for order in orders if table is None else (None,):
                    if table is None:
                        code, r = gram_codes(data, row, order)
                        k, n = _documents_of(code, r, mine) if per_document else _summed((mine[r] << 36) + code, np.ones(len(code)))
                    else:
                        r, at = table.find(data, row)
                        k, n = _documents_of(wanted[at], r, mine) if per_document else _occurrences(at, r, mine, wanted)
                    keys.append(k)
                    counts.append(n)
                    held += len(k)
                if held > held_rows:
                    k, n = _summed(np.concatenate(keys), np.concatenate(counts))
                    if len(k) > held_rows // 2:
                        yield from give(k, n)
                        k, n = k[:0], n[:0]
                    keys, counts, held = [k], [n], len(k)
        k, n = _summed(np.concatenate(keys), np.concatenate(counts))
        yield from give(k, n)
        pa.default_memory_pool().release_unused()
    got = corpus.select(*labels, "text").mapInArrow(run, schema)
    return got.groupBy(*labels, "code").agg(F.sum("n").alias("n"))


def gram_hex(code: str) -> Column:
    """A gram's bytes as hexadecimal digits."""
    order = F.shiftright(F.col(code), 32).cast("int")
    digits = F.lower(F.hex(F.col(code).bitwiseAND(F.lit((1 << 32) - 1))))
    return F.lpad(digits, order * 2, F.lit("0"))


def _labelled(corpus: DataFrame, source: str | None) -> DataFrame:
    s = F.coalesce(F.col(source).cast("string"), F.lit("")) if source else F.lit("")
    return corpus.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), s.alias("source"), "text")


def select_features(corpus: DataFrame, per_lang: int = PER_LANG, orders: tuple = ORDERS, source: str | None = "source") -> DataFrame:
    """(lang, code, gram, score): the ``per_lang`` best grams of each language of ``corpus`` (lang, text, source).

    Scores are rounded to 9 digits, ties go to the smaller gram. Only grams
    that a language's documents hold are its candidates. Null sources are one
    source; rows without label or text take no part. An empty corpus gives no
    rows.
    """
    docs = _labelled(corpus, source)
    sizes = materialize(docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs")), "gram-documents")
    total = sizes.agg(F.sum("docs")).first()[0] or 0
    held = materialize(_counted(docs, ["lang", "source"], orders, True), "gram-counts")
    big_n = F.lit(float(total))

    def cell(n: Column, r: Column, c: Column) -> Column:
        """n ln(n N / (r c)) of a cell of the table with row sum r and column sum c."""
        return F.when(n > 0, n * F.ln(n * big_n / (r * c))).otherwise(F.lit(0.0))
    by_lang = held.groupBy("code", "lang").agg(F.sum("n").alias("n"))
    by_source = held.groupBy("code", "source").agg(F.sum("n").alias("n"))
    have = held.groupBy("code").agg(F.sum("n").cast("double").alias("have"))
    n_source = sizes.groupBy("source").agg(F.sum("docs").cast("double").alias("of"))
    n_lang = sizes.groupBy("lang").agg(F.sum("docs").cast("double").alias("of"))
    n, of, a = F.col("n").cast("double"), F.col("of"), F.col("have")
    s = by_source.join(have, "code").join(n_source, "source").groupBy("code", "have").agg(
        F.sum(cell(n, a, of) + cell(of - n, big_n - a, of)).alias("t"), F.sum("of").alias("met"))
    # Sources without the gram: their documents all lie in the column of those that lack it.
    s = s.withColumn("t", F.col("t") + F.when(a < big_n, (big_n - F.col("met")) * F.ln(big_n / (big_n - a))).otherwise(F.lit(0.0)))
    both = by_lang.join(s, "code").join(n_lang, "lang")
    gain = (cell(n, a, of) + cell(a - n, a, big_n - of) + cell(of - n, big_n - a, of) + cell(big_n - a - of + n, big_n - a, big_n - of))
    scored = both.select("lang", "code", gram_hex("code").alias("gram"), (-F.round((gain - F.col("t")) / big_n, 9)).alias("cost"))
    best = top_k_per_group(scored, ["lang"], ["cost", "gram"], per_lang)
    return best.select("lang", "code", "gram", (-F.col("cost")).alias("score"))


def train_bytes(corpus: DataFrame, per_lang: int = PER_LANG, orders: tuple = ORDERS, source: str | None = "source") -> ByteModel:
    """The model over the selected grams, at most ``per_lang`` grams times languages, a bounded table on the driver."""
    chosen = materialize(select_features(corpus, per_lang, orders, source), "gram-features")
    grams = np.array(sorted(r["code"] for r in chosen.select("code").distinct().collect()), np.int64)
    docs = _labelled(corpus, source)
    priors = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(priors)
    seen = np.zeros((len(grams), len(langs)))
    if len(grams):
        for r in _counted(docs, ["lang"], orders, False, grams).collect():
            seen[np.searchsorted(grams, r["code"]), langs.index(r["lang"])] = r["n"]
    weights = np.log((seen + 1) / (seen.sum(0) + len(grams))) if len(grams) else seen
    return ByteModel(langs, np.log(np.array([priors[x] for x in langs], float) / max(1, sum(priors.values()))), grams, weights)


class GramTable:
    """Finds a model's grams in bytes: two-byte prefixes rule out most places of the longer ones."""

    def __init__(self, grams: np.ndarray):
        self.parts = {}
        for order in np.unique(grams >> 32).tolist():
            at = np.flatnonzero(grams >> 32 == order)
            low = grams[at] & ((1 << 32) - 1)
            if order <= 2:
                table = np.full(1 << (8 * order), -1, np.int64)
                table[low] = at
                self.parts[order] = (table, None, None)
            else:
                starts = np.zeros(1 << 16, bool)
                starts[low >> (8 * (order - 2))] = True
                self.parts[order] = (starts, low, at)

    def find(self, data: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, gram) of every occurrence."""
        rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        pair = (data[:-1].astype(np.int64) << 8) + data[1:] if len(data) > 1 else np.zeros(0, np.int64)
        for order, (table, low, at) in self.parts.items():
            n = len(data) - order + 1
            if n <= 0:
                continue
            if low is None:
                hit = table[data if order == 1 else pair]
                place = np.flatnonzero(hit >= 0)
                hit = hit[place]
            else:
                place = np.flatnonzero(table[pair[:n]])
                code = pair[place]
                for k in range(2, order):
                    code = (code << 8) + data[place + k]
                near = np.minimum(np.searchsorted(low, code), len(low) - 1)
                same = low[near] == code
                place, hit = place[same], at[near[same]]
            one = row[place] == row[place + order - 1]
            rows.append(row[place[one]])
            found.append(hit[one])
        return np.concatenate(rows), np.concatenate(found)


def classify_bytes(texts: DataFrame, text_col: str, model: ByteModel, lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``texts`` (or its columns ``keep``) with the best language and its normalised probability ``prob``.

    One map over the scan, no exchange. A text without any of the model's
    grams, null and empty ones too, gives no row; ties go to the alphabetically
    first language; columns called ``lang`` or prob are replaced.
    """
    kept = [f for f in texts.schema.fields if f.name not in (lang, "prob") and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, T.StructField(lang, T.StringType()), T.StructField("prob", T.DoubleType())])
    source = texts.select(*(f.name for f in kept), F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n_grams = GramTable(model.grams), len(model.grams)
        group = max(1, CELLS // max(1, n_grams))
        for b in batches:
            for i, j, data, offs in text_bytes(b.column("__text")):
                row, gram = table.find(data, np.repeat(np.arange(j - i), np.diff(offs)))
                order = np.argsort(row, kind="stable")
                row, gram = row[order], gram[order]
                for g in range(0, j - i, group):        # counts of some texts at once, as one matrix
                    m = min(group, j - i - g)
                    lo, hi = np.searchsorted(row, [g, g + m])
                    counts = np.bincount((row[lo:hi] - g) * n_grams + gram[lo:hi], minlength=m * n_grams).reshape(m, n_grams)
                    some = np.flatnonzero(counts.any(1))
                    if not len(some):
                        continue
                    score = counts[some] @ model.weights + model.prior
                    best = score.argmax(1)
                    prob = 1.0 / np.exp(score - score.max(1, keepdims=True)).sum(1)
                    rows = pa.array(some + i + g)
                    yield pa.RecordBatch.from_arrays([*(b.column(f.name).take(rows) for f in kept),
                                                      pa.array([model.langs[k] for k in best], pa.string()), pa.array(prob)], schema.fieldNames())
    if not model.langs or not len(model.grams):
        return source.where("false").select(*(f.name for f in kept), F.lit("").alias(lang), F.lit(0.0).alias("prob"))
    return source.mapInArrow(run, schema)

