"""Language detection by random trials, against a plain loop per text and trial."""

import math
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as V
from colloquy.functions.draws import text_key, uniform
from colloquy.operators import trials as T
from colloquy.session import ship_package
from colloquy.sources import fixtures as X

from .conftest import SF001

SAY = {"en": "the house of this man and that woman is with them", "de": "das Haus von diesem Mann und jener Frau ist mit ihnen",
       "ru": "этот дом и та женщина с ними", "ja": "これは家です 東京", "bg": "този дом и тази жена с тях"}


def some_corpus(n=200, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(sorted(SAY))
        rows.append((lang, "  ".join(rnd.choices(SAY[lang].split(), k=rnd.randint(1, 9))) + rnd.choice(["", "!", " 12 %", "\n"])))
    return rows + [("en", ""), ("en", None), (None, "the house"), ("de", "12 !")]


def plain_letters(text):
    keep = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    return re.sub(" +", " ", f" {keep} ")


def plain_grams(text):
    t = plain_letters(text)
    for n in (1, 2, 3):
        for i in range(len(t) - n + 1):
            g = t[i:i + n]
            if g != " " and not (n == 3 and g[1] == " "):
                yield g


def number(gram):
    return sum(ord(c) << (21 * j) for j, c in enumerate(gram))


def plain_counts(rows):
    counts = Counter()
    for lang, text in rows:
        if lang is not None:
            counts.update((lang, number(g)) for g in plain_grams(text))
    return counts


@pytest.fixture(scope="module")
def learned(spark):
    ship_package(spark)
    df = spark.createDataFrame(some_corpus(), "lang string, text string")
    return df, T.train_trials(df.repartition(3))


def test_counts_equal_plain_counts(spark, learned, monkeypatch):
    df, _ = learned
    want = dict(plain_counts(some_corpus()))
    for parts in (1, 5):
        got = T.gram_counts(df.repartition(parts).withColumn("t", F.lit(1)))
        assert {(r["lang"], r["gram"]): r["c"] for r in got.collect()} == want


@pytest.mark.parametrize("piece", [1 << 16, 70_000])
def test_counts_of_long_texts_are_whole(monkeypatch, piece):
    """Texts beyond a piece, about a piece, and many that fill it together."""
    import pandas as pd
    monkeypatch.setattr(T, "PIECE", piece)
    rnd = random.Random(1)
    texts = [" ".join(rnd.choices(SAY["de"].split(), k=k)) for k in (1, 30000, 16000, 3, 0, 13000, 13000, 9, 40000)] + ["x" * 200_001]
    batches = [pd.DataFrame({"lang": "de", "t": [plain_letters(t) for t in texts[i:i + 4]]}) for i in (0, 4, 8)]
    got = Counter()
    for frame in T._count(iter(batches)):
        for lang, gram, c in frame.itertuples(index=False):
            got[lang, gram] += c
    assert got == plain_counts([("de", t) for t in texts])


def test_model_keeps_the_most_frequent(learned, spark):
    df, model = learned
    counts = plain_counts(some_corpus())
    order = lambda g: 1 if g < 1 << 21 else 2 if g < 1 << 42 else 3
    for model, k in ((model, T.PER_ORDER), (T.train_trials(df, per_order=4), 4)):
        assert model.langs == sorted(SAY)
        want = {}
        for lang in SAY:
            for n in (1, 2, 3):
                of = {g: c for (l, g), c in counts.items() if l == lang and order(g) == n}
                for g in sorted(of, key=lambda g: (-of[g], g))[:k]:
                    want[lang, g] = of[g] / sum(of.values())
        got = {(lang, int(g)): model.share[i, j] for i, g in enumerate(model.grams) for j, lang in enumerate(model.langs) if model.share[i, j]}
        assert got.keys() == want.keys() and all(math.isclose(got[x], want[x]) for x in want)
    assert {s: [l for l, b in zip(model.langs, m) if b] for s, m in model.scripts.items()} == {
        "LATIN": ["de", "en"], "CYRILLIC": ["bg", "ru"], "HIRAGANA": ["ja"], "CJK": ["ja"]}


def plain_detect(model, text, seed):
    t = plain_letters(text)
    seen = Counter(T.script(c) for c in t if c != " ")
    if not seen:
        return None, None
    allowed = model.scripts.get(min(seen, key=lambda s: (-seen[s], s)))
    if allowed is None:
        return None, None
    shares = {int(g): model.share[i] for i, g in enumerate(model.grams)}
    places = [t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)]
    known = [shares[number(g)] for g in places if number(g) in shares]
    for slots in ([shares.get(number(g)) for g in places], known):
        if not slots:
            return None, None
        means = []
        for trial in range(7):
            key = np.array([text_key(t, seed)], dtype=np.uint64) + np.uint64(trial) * np.array([0xD1342543DE82EF95], dtype=np.uint64)
            u = lambda n: float(uniform(key, n)[0])
            alpha = 0.5 + 0.05 * math.sqrt(-2 * math.log1p(-u(0))) * math.cos(2 * math.pi * u(1))
            odds = allowed / allowed.sum()
            met = missed = 0
            step = 2
            while missed < 64:
                share = slots[int(u(step) * len(slots))]
                step += 1
                if share is None:
                    missed += 1
                    continue
                odds, met, missed = odds * (alpha / 10000 + share), met + 1, 0
                if met % 5 == 0:
                    odds = odds / odds.sum()
                    if odds.max() > 0.99999 or met >= 1000:
                        break
            if missed >= 64:
                break
            means.append(odds)
        if len(means) == 7:
            mean = np.mean(means, axis=0)
            return (model.langs[int(mean.argmax())], float(mean.max())) if mean.max() >= 0.1 else (None, None)


TEXTS = [t for _, t in some_corpus(60, 9)] + ["a", "и", "Ω", "ξένος", "house", "qqqq " * 400 + "the", "ქართული", "家", "этот дом the house of", "xyzzy",
                                            None, "", " ", "1 2 3", "the " * 50_000, "das the", "этот тази"] + ["the house", "the house"]


def test_trials_equal_a_plain_loop(learned):
    _, model = learned
    for seed in (66, 1):
        got = T.detect_batch(model, [plain_letters(t) for t in TEXTS], seed)
        for t, g in zip(TEXTS, got):
            lang, prob = plain_detect(model, t, seed)
            assert g[0] == lang and (prob is None) == (g[1] is None)
            assert prob is None or math.isclose(g[1], prob, rel_tol=1e-9), t
    assert got[-1] == got[-2]
    found = dict(zip(TEXTS, got))
    assert found["qqqq " * 400 + "the"][0] in ("de", "en") and found["Ω"] == (None, None) and found["家"][0] == "ja"


def test_detection_does_not_depend_on_partitions(spark, learned):
    df, model = learned
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "id long, body string, lang string")
    one, many = (sorted(map(tuple, T.detect_trials(rows.repartition(n, F.rand(n)), "body", model, ["id"]).collect())) for n in (1, 6))
    assert one == many
    want = {i: g for i, g in enumerate(T.detect_batch(model, [plain_letters(t) for t in TEXTS])) if g[0]}
    assert {r[0]: (r[1], r[2]) for r in one} == want
    assert "Exchange" not in T.detect_trials(rows, "body", model, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert T.detect_trials(rows.where("false"), "body", model, ["id"]).count() == 0
    empty = T.train_trials(df.where("false"))
    assert T.detect_trials(rows, "body", empty, ["id"]).count() == 0


def test_held_out_documents_are_told_apart(spark):
    docs = X.table(spark, SF001, "documents").where("text is not null and lang is not null")
    model = T.train_trials(docs.where("doc_id % 4 <> 0"))
    found = T.detect_trials(docs.where("doc_id % 4 = 0 and length(text) > 40"), "text", model, ["doc_id", docs["lang"].alias("label")])
    right = [r["lang"] == r["label"] for r in found.collect()]
    assert len(right) > 30 and sum(right) / len(right) > 0.97
