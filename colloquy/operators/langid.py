"""Language identification as table jobs.

The corpus tool calls two pretrained per-row libraries. Their models are not
available, so a multinomial naive Bayes model over character trigrams is
trained from labelled text (N3) and applied with an explode + join +
aggregate (N1, N2).

Model, for a gram g and language L with count c(g, L), per-language gram
total N_L and vocabulary size V (add-one smoothing):

    lp(g, L) = ln((c + 1) / (N_L + V)) = w(g, L) + u_L
    w(g, L)  = ln(c + 1)        (0 when g never occurs in L)
    u_L      = -ln(N_L + V)

so the score of a text over its grams found in the vocabulary is

    score(L) = prior_L + n_vocab * u_L + sum of w(g, L) over its grams

Only seen (g, L) pairs are stored, one row each; ``head`` marks one row per
gram so that n_vocab is counted once per gram occurrence.

Texts are cut into grams inside Arrow batches and counted there. A model of at
most ``HELD_CELLS`` grams times languages travels with the tasks and scores a
text where it is scanned; a larger one is joined to the grams as rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

GRAM_ORDER = 3
DETECT_ORDER = 2    # the second detector (N2) looks at other features than the first
HELD_CELLS = 4_000_000
RUN_CHARS = 1 << 20
POINT_BITS = 21     # a code point's; three make a number of 63


@dataclass
class LangModel:
    grams: DataFrame            # gram string, k int, w double, head boolean
    langs: list                 # [(k, lang, prior, u)] sorted by lang, k = position
    order: int = GRAM_ORDER
    _held: list = field(default_factory=list, repr=False)

    def held(self) -> "HeldGrams | None":
        """The grams as arrays, read once; None where they are too many or too long."""
        if not self._held:
            fits = self.order * POINT_BITS < 64 and len(self.langs) > 0 and (
                self.grams.where("head").count() * len(self.langs) <= HELD_CELLS)
            self._held.append(HeldGrams.read(self) if fits else None)
        return self._held[0]

    def table(self) -> DataFrame:
        """(gram, lang, w) view of the model."""
        names = F.array(*[F.lit(l) for _, l, _, _ in self.langs])
        return self.grams.select("gram", F.element_at(names, F.col("k") + 1).alias("lang"), "w")


@dataclass
class HeldGrams:
    """Weights of ``codes`` (grams as numbers, sorted), one column a language."""
    codes: np.ndarray
    weights: np.ndarray
    prior: np.ndarray
    u: np.ndarray
    langs: list
    order: int

    @classmethod
    def read(cls, model: LangModel) -> "HeldGrams":
        rows = model.grams.select("gram", "k", "w").toArrow()
        points = text_points(rows.column("gram").to_pylist()).reshape(-1, model.order)
        code, at = np.unique(point_codes(points.ravel(), model.order)[::model.order], return_inverse=True)
        weights = np.zeros((len(code), len(model.langs)))
        weights[at, rows.column("k").to_numpy()] = rows.column("w").to_numpy()
        return cls(code, weights, np.array([x[2] for x in model.langs]), np.array([x[3] for x in model.langs]),
                   [x[1] for x in model.langs], model.order)

    def sums(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Per lower-cased text: its grams in the vocabulary, and the sum of their weights by language."""
        points, row = text_points(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        n = np.zeros(len(texts), np.int64)
        w = np.zeros((len(texts), len(self.langs)))
        if len(points) < self.order or not len(self.codes):
            return n, w
        last = self.order - 1
        one = row[:len(row) - last] == row[last:]
        code, of = point_codes(points, self.order)[one], row[:len(row) - last][one]
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        met = self.codes[at] == code
        at, of = at[met], of[met]
        for k in range(len(self.langs)):
            w[:, k] = np.bincount(of, weights=self.weights[at, k], minlength=len(texts))
        return np.bincount(of, minlength=len(texts)), w


def text_points(texts: list) -> np.ndarray:
    """The code points of all texts, one after the other."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)


def point_codes(points: np.ndarray, order: int) -> np.ndarray:
    """The gram at every place as one number."""
    n = max(0, len(points) - order + 1)
    code = np.zeros(n, np.int64)
    for j in range(order):
        code = (code << POINT_BITS) + points[j:n + j]
    return code


def _text_runs(col: pa.Array) -> Iterator[tuple[int, list]]:
    """(first row, texts) of runs of whole texts of together about ``RUN_CHARS`` characters; a null text is empty."""
    texts, first, held = [], 0, 0
    for i, t in enumerate(pc.fill_null(col, "").to_pylist()):
        if texts and held + len(t) > RUN_CHARS:
            yield first, texts
            texts, first, held = [], i, 0
        texts.append(t)
        held += len(t)
    if texts:
        yield first, texts


def gram_counts(corpus: DataFrame, order: int) -> DataFrame:
    """(gram, lang, c) of (lang, text) rows, counted per run of texts and then together."""
    schema = "gram string, lang string, c bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = b.column("lang").dictionary_encode()
            labels = np.asarray(label.indices).astype(np.int64)
            for i, texts in _text_runs(b.column("_low")):
                points, row = text_points(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
                if len(points) < order:
                    continue
                one = row[:len(row) - order + 1] == row[order - 1:]
                code, of = point_codes(points, order)[one], labels[i + row[:len(row) - order + 1][one]]
                for k in np.unique(of).tolist():
                    got, n = np.unique(code[of == k], return_counts=True)
                    cut = np.stack([(got >> (POINT_BITS * (order - 1 - j))) & ((1 << POINT_BITS) - 1) for j in range(order)], 1)
                    whole = cut.astype(np.uint32).tobytes().decode("utf-32-le")
                    grams = [whole[x:x + order] for x in range(0, len(whole), order)]
                    yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array([label.dictionary[k].as_py()] * len(got), pa.string()),
                                                      pa.array(n)], ["gram", "lang", "c"])
    parts = corpus.select("lang", F.lower("text").alias("_low")).mapInArrow(run, schema)
    return parts.groupBy("gram", "lang").agg(F.sum("c").alias("c"))


def text_grams(df: DataFrame, keys: list, text_col: str, order: int = GRAM_ORDER) -> DataFrame:
    """One row per gram occurrence of the lower-cased whole text.

    The text is cut into code points once; each position's gram is a
    slice + join of that array (generated code, O(1) per gram).
    """
    chars = F.split(F.lower(F.col(text_col)), "")
    c = df.select(*keys, chars.alias("_c"))
    cols = [F.col(n) for n in c.columns if n != "_c"]
    e = c.select(*cols, F.posexplode("_c").alias("_pos", "_ch"), "_c")
    gram = F.array_join(F.slice("_c", F.col("_pos") + 1, order), "")
    return e.where(F.col("_pos") + order <= F.size("_c")).select(*cols, gram.alias("gram"))


def train_model(corpus: DataFrame, order: int = GRAM_ORDER, lang_col: str = "lang",
                text_col: str = "text") -> LangModel:
    """Learn the model from (lang, text) rows; the result is checkpointed."""
    labelled = corpus.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if order * POINT_BITS < 64:
        counts = gram_counts(labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")), order)
    else:
        grams = text_grams(labelled, [F.col(lang_col).alias("lang")], text_col, order)
        counts = grams.groupBy("gram", "lang").agg(F.count(F.lit(1)).alias("c"))
    # A gram has at most one row per language, so this window is bounded.
    first = F.min("lang").over(Window.partitionBy("gram"))
    counts = materialize(counts.withColumn("head", F.col("lang") == first), "lang-counts")

    totals = counts.groupBy("lang").agg(F.sum("c").alias("n"))
    docs = labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("ndocs"))
    vocab = counts.where("head").select(F.count(F.lit(1)).alias("v"))
    stats = docs.join(totals, "lang", "left")
    v = vocab.first()["v"]
    # One row per language, the labels' vocabulary; a language of texts shorter than a gram has no total.
    every = stats.collect()
    all_docs = sum(r["ndocs"] for r in every)        # every labelled document, as the prior's total
    rows = sorted((r for r in every if r["n"] is not None), key=lambda r: r["lang"])
    langs = [(k, r["lang"], math.log(r["ndocs"] / all_docs), -math.log(r["n"] + v))
             for k, r in enumerate(rows)]
    index = F.array(*[F.lit(l) for _, l, _, _ in langs])
    model = counts.select("gram", (F.array_position(index, F.col("lang")) - 1).cast("int").alias("k"),
                          F.log1p(F.col("c").cast("double")).alias("w"), "head")
    # Written, so Spark knows its bytes and broadcasts it only where they are few.
    return LangModel(materialize(model, "lang-model"), langs, order)


def classify(texts: DataFrame, keys, text_col: str, model: LangModel) -> DataFrame:
    """Best language and its normalised probability per text.

    Returns (keys..., lang, prob). A text none of whose grams is in the
    vocabulary gets no row (the per-row library raises there; the row is
    dropped). Ties go to the alphabetically first language.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    held = model.held()
    if held is not None:
        # The sums of a text are of its row; those of one key add up.
        s = _row_sums(texts.select(*keys, F.lower(text_col).alias("_low")), keys, held)
        cols = range(len(model.langs))
        s = s.groupBy(*keys).agg(F.sum("nv").alias("nv"), *[F.sum(F.col("w")[k]).alias(f"_w{k}") for k in cols])
        s = s.select(*keys, "nv", F.map_from_arrays(F.array(*map(F.lit, cols)), F.array(*[f"_w{k}" for k in cols])).alias("sums"))
    else:
        hits = text_grams(texts, keys, text_col, model.order).join(model.grams, "gram")
        # One sum per (text, language), whatever the number of languages; then one row per text.
        s = hits.groupBy(*keys, "k").agg(F.sum("w").alias("w"), F.count_if("head").alias("head"))
        s = s.groupBy(*keys).agg(F.sum("head").alias("nv"), F.map_from_entries(F.collect_list(F.struct("k", "w"))).alias("sums"))
    langs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(lang).alias("lang"), F.lit(prior).alias("prior"), F.lit(u).alias("u"))
                      for k, lang, prior, u in model.langs])
    scored = F.transform(langs, lambda g: F.struct(
        (-(g["prior"] + F.col("nv") * g["u"] + F.coalesce(F.element_at("sums", g["k"]), F.lit(0.0)))).alias("cost"), g["lang"].alias("lang")))
    s = s.withColumn("scored", F.array_sort(scored)).withColumn("best", F.col("scored")[0])
    denom = F.aggregate("scored", F.lit(0.0), lambda a, x: a + F.exp(F.col("best.cost") - x["cost"]))
    return s.select(*keys, F.col("best.lang").alias("lang"), (F.lit(1.0) / denom).alias("prob"))


def _row_sums(texts: DataFrame, keys: list, held: HeldGrams) -> DataFrame:
    """(keys..., nv, w) of every row with a gram in the vocabulary; the texts are ``_low``."""
    schema = T.StructType([*(texts.schema[k] for k in keys), T.StructField("nv", T.LongType()),
                           T.StructField("w", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, part in _text_runs(b.column("_low")):
                n, w = held.sums(part)
                some = np.flatnonzero(n)
                keep = pa.array(some + i)
                sums = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * w.shape[1]), pa.array(w[some].ravel()))
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(keep) for k in keys), pa.array(n[some]), sums], schema.fieldNames())
    return texts.mapInArrow(run, schema)


def label_rows(rows: DataFrame, text_col: str, held: HeldGrams, lang: str = "lang") -> DataFrame:
    """``rows`` with the best language and its normalised probability ``prob``, one map over the scan.

    A text none of whose grams is in the vocabulary gives no row; ties go to the alphabetically first language.
    Columns called ``lang`` or prob are replaced.
    """
    kept = [f for f in rows.schema.fields if f.name not in (lang, "prob")]
    schema = T.StructType([*kept, T.StructField(lang, T.StringType()), T.StructField("prob", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, part in _text_runs(b.column("_low")):
                n, w = held.sums(part)
                some = np.flatnonzero(n)
                score = held.prior + n[some, None] * held.u + w[some]
                best = score.argmax(1)
                prob = 1.0 / np.exp(score - score.max(1, keepdims=True)).sum(1)
                keep = pa.array(some + i)
                yield pa.RecordBatch.from_arrays([*(b.column(f.name).take(keep) for f in kept),
                                                  pa.array([held.langs[k] for k in best], pa.string()), pa.array(prob)], schema.fieldNames())
    return rows.select(*(f.name for f in kept), F.lower(text_col).alias("_low")).mapInArrow(run, schema)
