"""Language detection by random trials (N2), a second detector that shares nothing with the first (N1) but the idea of grams.

Texts are lower-cased and every run of characters that are no letters or
marks becomes one space, with one before and behind. A gram is 1 to 3
characters of that, without a space alone or in its middle. Training counts
the grams in the tasks and keeps, per language and length, the
``PER_ORDER`` most frequent with their share p(gram | language).

A text is first held against the script that most of its letters have: only
languages with ``SCRIPT_SHARE`` of their own letters in it stay. Then
``TRIALS`` trials each start from even odds and draw grams of the text at
random; a gram multiplies every language's odds by its share plus a small
constant that differs per trial, until one language is certain or
``DRAWS`` grams were met. The result is the mean of the trials. Draws hang on
the seed and the text alone, so equal texts get equal answers.

The whole text is drawn from, and a draw looks at one place: the cost of a
text is that of its draws, not of its length.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import fixed_values as V
from ..functions.draws import text_key, uniform
from ..session import drop_table, materialize

# --- fixed values: the trials of the detection library that the corpus tool calls ---
TRIALS = 7
ALPHA = 0.5
ALPHA_WIDTH = 0.05
BASE = 10000
DRAWS = 1000
CERTAIN = 0.99999
LEAST = 0.1

ORDERS = (1, 2, 3)
PER_ORDER = 3000         # grams kept per language and length
SCRIPT_SHARE = 0.05
CHECK = 5                # grams between two looks at the odds
MISSES = 64              # unknown grams in a row after which a text's known grams are listed
PIECE = 1 << 20          # characters counted at once
BATCH = 512              # texts whose trials run together
BITS = 21                # of a code point


def letters(text) -> Column:
    """Lower-cased words between single spaces; a null text has none."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(c, F.lit(""))), F.lit(" ")), r"[^\p{L}\p{M}]+", " ")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)


def _grams(points: np.ndarray, starts: int) -> np.ndarray:
    """The grams of every length that start at the first ``starts`` places, as numbers: the first character lowest."""
    out = []
    for n in ORDERS:
        m = max(min(starts, len(points) - n + 1), 0)
        key = np.zeros(m, dtype=np.int64)
        ok = np.ones(m, dtype=bool)
        for j in range(n):
            c = points[j:j + m]
            key |= c << (BITS * j)
            if n == 1 or (n == 3 and j == 1):
                ok &= c != 32
        if n == 2:
            ok &= (points[:m] != 32) | (points[1:m + 1] != 32)
        out.append(key[ok])
    return np.concatenate(out)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, gram, c) of a task's texts, added up per language until 500,000 grams are held."""
    held: dict = {}

    def flush():
        frames = [pd.DataFrame({"lang": lang, "gram": g, "c": c}) for lang, (g, c) in held.items()]
        held.clear()
        return pd.concat(frames) if frames else pd.DataFrame({"lang": pd.Series(dtype=object), "gram": pd.Series(dtype="int64"), "c": pd.Series(dtype="int64")})

    def add(lang, points):
        gram, c = np.unique(_grams(points, PIECE), return_counts=True)
        if lang in held:
            gram, at = np.unique(np.concatenate([held[lang][0], gram]), return_inverse=True)
            c = np.bincount(at, np.concatenate([held[lang][1], c])).astype(np.int64)
        held[lang] = (gram, c)

    for b in batches:
        for lang, rows in b.groupby("lang")["t"]:
            waiting, size = [], 0
            for t in rows:
                points = code_points(t)
                if size + len(points) > PIECE and waiting:
                    add(lang, np.concatenate(waiting))
                    waiting, size = [], 0
                if len(points) > PIECE:
                    for i in range(0, len(points), PIECE):
                        add(lang, points[i:i + PIECE + max(ORDERS) - 1])
                    continue
                # Texts begin and end with a space, so that no gram lies across two of them.
                waiting.append(points)
                size += len(points)
            if waiting:
                add(lang, np.concatenate(waiting))
            if sum(len(g) for g, _ in held.values()) > 500_000:
                yield flush()
    yield flush()


@lru_cache(maxsize=1 << 16)
def script(ch: str) -> str:
    """The first word of a character's Unicode name, which names its script."""
    return unicodedata.name(ch, "UNNAMED").split(" ")[0].split("-")[0]


@F.pandas_udf(StringType())
def _script_udf(gram: pd.Series) -> pd.Series:
    return gram.map(lambda g: script(chr(g)))


@dataclass
class TrialModel:
    langs: list              # sorted
    grams: np.ndarray        # sorted numbers
    share: np.ndarray        # grams x languages
    scripts: dict            # script -> languages as booleans


def gram_counts(corpus: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, c) over the whole texts of labelled rows."""
    rows = corpus.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), letters(text_col).alias("t"))
    return rows.mapInPandas(_count, "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def train_trials(corpus: DataFrame, lang_col: str = "lang", text_col: str = "text", per_order: int = PER_ORDER) -> TrialModel:
    """Learn the shares of (lang, text) rows; at most ``per_order`` grams of each length per language reach the driver."""
    counts = materialize(gram_counts(corpus, lang_col, text_col), "trial-grams")
    order = F.when(F.col("gram") < 1 << BITS, 1).when(F.col("gram") < 1 << 2 * BITS, 2).otherwise(3)
    counts_by = counts.withColumn("order", order)
    totals = {(r["lang"], r["order"]): r["n"] for r in counts_by.groupBy("lang", "order").agg(F.sum("c").alias("n")).collect()}
    w = Window.partitionBy("lang", "order").orderBy(F.desc("c"), "gram")
    kept = counts_by.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_order).toArrow().to_pandas()
    # One row per language and script, of all its letters.
    by_script = counts_by.where("order = 1").groupBy("lang", _script_udf("gram").alias("script")).agg(F.sum("c").alias("c")).collect()
    drop_table(counts)
    langs = sorted({lang for lang, _ in totals})
    grams = np.unique(kept["gram"].to_numpy(dtype=np.int64))
    share = np.zeros((len(grams), len(langs)))
    lang_at = kept["lang"].map({lang: k for k, lang in enumerate(langs)}).to_numpy(dtype=np.int64)
    of = np.array([totals[k] for k in zip(kept["lang"], kept["order"])], dtype=float)
    share[np.searchsorted(grams, kept["gram"].to_numpy(dtype=np.int64)), lang_at] = kept["c"].to_numpy(dtype=float) / of
    scripts: dict = {}
    for r in by_script:
        if r["c"] >= SCRIPT_SHARE * totals[r["lang"], 1]:
            scripts.setdefault(r["script"], np.zeros(len(langs), dtype=bool))[langs.index(r["lang"])] = True
    return TrialModel(langs, grams, share, scripts)


def main_script(text: str):
    """The script of most letters, ties by name; None without letters."""
    seen: Counter = Counter()
    for ch, c in Counter(text).items():
        if ch != " ":
            seen[script(ch)] += c
    return min(seen, key=lambda s: (-seen[s], s)) if seen else None


def _slot(points, base, size, u):
    """The gram of one drawn (length, place) per row: ``size`` places of length 1, one less per further character."""
    places = 3 * size - 3
    at = np.minimum((u * places).astype(np.int64), places - 1)
    n = 1 + (at >= size) + (at >= 2 * size - 1)
    at = base + at - np.where(n == 1, 0, np.where(n == 2, size, 2 * size - 1))
    gram = points[at]
    two, three = n >= 2, n == 3
    gram[two] |= points[at[two] + 1] << BITS
    gram[three] |= points[at[three] + 2] << 2 * BITS
    return gram


def _lookup(model: TrialModel, gram: np.ndarray):
    at = np.minimum(np.searchsorted(model.grams, gram), len(model.grams) - 1)
    return at, model.grams[at] == gram


def _run(model: TrialModel, keys: np.ndarray, odds: np.ndarray, draw) -> tuple:
    """Mean odds per text, and the texts given up for ``MISSES`` unknown grams in a row. ``draw(texts, u)`` gives (row, known)."""
    n, width = odds.shape
    result = np.zeros((n, TRIALS, width))
    lost = np.zeros(n, dtype=bool)
    text = np.repeat(np.arange(n), TRIALS)
    trial = np.tile(np.arange(TRIALS), n)
    key = keys[text] + trial.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    normal = np.sqrt(-2.0 * np.log1p(-uniform(key, 0))) * np.cos(2.0 * math.pi * uniform(key, 1))
    floor = ((ALPHA + ALPHA_WIDTH * normal) / BASE)[:, None]
    odds = odds[text].copy()
    met, missed = np.zeros(len(text), dtype=np.int64), np.zeros(len(text), dtype=np.int64)
    step = 2
    while len(text):
        at, known = draw(text, uniform(key, step))
        step += 1
        odds[known] *= floor[known] + model.share[at[known]]
        met[known] += 1
        missed = np.where(known, 0, missed + 1)
        look = known & (met % CHECK == 0)
        odds[look] /= odds[look].sum(axis=1, keepdims=True)
        done = look & ((odds.max(axis=1) > CERTAIN) | (met >= DRAWS))
        result[text[done], trial[done]] = odds[done]
        lost[text[missed >= MISSES]] = True
        going = ~done & ~lost[text]
        if not going.all():
            text, trial, key, floor, odds, met, missed = (x[going] for x in (text, trial, key, floor, odds, met, missed))
    return result.mean(axis=1), lost


def detect_batch(model: TrialModel, texts: list, seed: int = V.SEED) -> list:
    """(lang, prob) of each text that ``letters`` gave; (None, None) where no letter or gram of it is known."""
    found: list = [(None, None)] * len(texts)
    if not len(model.grams):
        return found
    scripts = [main_script(t) for t in texts]
    asked = [i for i, s in enumerate(scripts) if s in model.scripts]
    if not asked:
        return found
    points = [code_points(texts[i]) for i in asked]
    size = np.array([len(p) for p in points], dtype=np.int64)       # 3 at least: a letter between two spaces
    base = np.concatenate([[0], np.cumsum(size)[:-1]])
    every = np.concatenate(points)
    odds = np.array([model.scripts[scripts[i]] for i in asked], dtype=float)
    odds /= odds.sum(axis=1, keepdims=True)
    keys = np.array([text_key(texts[i], seed) for i in asked], dtype=np.uint64)
    mean, lost = _run(model, keys, odds, lambda text, u: _lookup(model, _slot(every, base[text], size[text], u)))
    rows = np.flatnonzero(lost)
    if len(rows):       # few of their grams are known: these are listed and drawn from
        listed = [_known(model, points[r]) for r in rows]
        rows, listed = rows[[len(x) > 0 for x in listed]], [x for x in listed if len(x)]
    if len(rows):
        many = np.array([len(x) for x in listed], dtype=np.int64)
        first, flat = np.concatenate([[0], np.cumsum(many)[:-1]]), np.concatenate(listed)
        mean[rows], _ = _run(model, keys[rows], odds[rows], lambda text, u: (
            flat[first[text] + np.minimum((u * many[text]).astype(np.int64), many[text] - 1)], np.ones(len(text), dtype=bool)))
    best = mean.argmax(axis=1)
    for r, i in enumerate(asked):
        if mean[r, best[r]] >= LEAST:
            found[i] = (model.langs[best[r]], float(mean[r, best[r]]))
    return found


def _known(model: TrialModel, points: np.ndarray) -> np.ndarray:
    """The rows of a text's known grams, in pieces."""
    out = []
    for i in range(0, len(points), PIECE):
        at, known = _lookup(model, _grams(points[i:i + PIECE + max(ORDERS) - 1], PIECE))
        out.append(at[known])
    return np.concatenate(out)


def detect_trials(texts: DataFrame, text_col: str, model: TrialModel, keep: list, seed: int = V.SEED) -> DataFrame:
    """(keep..., lang, prob); a text without known grams gets no row (the library raises there). No shuffle."""
    @F.pandas_udf("lang string, prob double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            t = b.tolist()
            got = [x for i in range(0, len(t), BATCH) for x in detect_batch(model, t[i:i + BATCH], seed)]
            yield pd.DataFrame(got, columns=["lang", "prob"]).astype({"prob": float})
    out = texts.select(*keep, udf(letters(text_col)).alias("_d"))
    return out.where(F.col("_d.lang").isNotNull()).select(*out.columns[:-1], "_d.lang", "_d.prob")
