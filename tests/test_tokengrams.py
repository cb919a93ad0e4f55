"""n-grams counted inside the tasks: equal to plain Python, and no n-gram is a row before it is counted."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from colloquy.operators import metrics as M
from colloquy.operators import tokengrams as G
from colloquy.session import ship_package

ROW = "k long, lang string, p array<string>, r array<string>"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def py_match(rows, max_order=4):
    out = Counter()
    sides = {}
    for k, lang, p, r in rows:
        for s, t in ((0, p or []), (1, r or [])):
            for n in range(1, max_order + 1):
                sides.setdefault((k, lang, n), (Counter(), Counter()))[s].update(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
    for (_, lang, n), (a, b) in sides.items():
        out[lang, f"m{n}"] += sum((a & b).values())
        out[lang, f"t{n}"] += sum(a.values())
        out[lang, f"r{n}"] += sum(b.values())
    return out


def some_rows(keys):
    r = random.Random(5)
    text = lambda: [r.choice("abcde") for _ in range(r.randint(0, 12))]
    rows = [(k, r.choice(["x", "y", None]), text(), text()) for k in keys]
    return rows + [(keys[-1] if keys[-1] is None else 10 ** 6, "x", None, ["a"]), (10 ** 6 + 1, "z", [], None)]


@pytest.mark.parametrize("keys", [list(range(200)), [i // 3 for i in range(150)] + [None] * 5])
def test_match_counts_of_single_and_repeated_keys(spark, keys, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(G, "RUN_TOKENS", 64)
    rows = some_rows(keys)
    df = spark.createDataFrame(rows, ROW).repartition(3)
    got = M.match_counts(df, "p", "r", ["lang"], key="k").collect()
    want = py_match(rows)
    langs = {l for (l, c), v in want.items() if v}
    assert {r["lang"] for r in got} == langs
    for r in got:
        for n in range(1, 5):
            assert (r[f"m{n}"], r[f"t{n}"], r[f"r{n}"]) == tuple(want[r["lang"], f"{c}{n}"] for c in "mtr")


def test_single_keys_make_no_rows_of_ngrams(spark):
    df = spark.createDataFrame(some_rows(list(range(20))), ROW)
    assert "Generate" not in plan_of(M.match_counts(df, "p", "r", key="k"))
    assert "Generate" not in plan_of(M.gram_counts(df, "p"))


def test_gram_counts_against_plain_python(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(G, "RUN_TOKENS", 40)
    rows = some_rows(list(range(120)))
    df = spark.createDataFrame(rows, ROW).repartition(2)
    got = M.gram_counts(df, "p", by=["lang"]).groupBy("lang", "n").agg(
        F.sum("d").alias("nd"), F.sum("c").alias("t"), F.sum(F.col("c") * F.col("c")).alias("squares"))
    got = {(r["lang"], r["n"]): (r["nd"], r["t"], r["squares"]) for r in got.collect()}
    want = {}
    for lang in ("x", "y", "z", None):
        for n in (1, 2, 4):
            seen, counts = set(), Counter()
            for t in (p for _, l, p, _ in rows if l == lang and p is not None):
                grams = [tuple(t[i:i + n]) for i in range(len(t) - n + 1)]
                seen |= set(grams) if len(t) >= n else {(x,) for x in t}
                counts.update(grams if len(t) >= n else [tuple(t)])
            if counts:
                want[lang, n] = (len(seen), sum(counts.values()), sum(v * v for v in counts.values()))
    assert got == want


def test_ngrams_travel_as_packed_blocks(spark):
    ship_package(spark)
    r = random.Random(3)
    rows = [(k, r.choice(["x", None]), [str(r.randrange(3000)) for _ in range(200)], []) for k in range(200)]
    blocks = G.gram_blocks(spark.createDataFrame(rows, ROW).coalesce(1), "p", (1, 2, 4), ["lang"], 3)
    held = blocks.select(F.sum(F.length("low")), F.sum(F.length("step") + F.length("low") + F.length("c")), F.count(F.lit(1))).first()
    assert held[1] / (held[0] / 8) < 12 and held[2] <= 2 * 3 * 8
    sums = lambda b, bits: sorted(map(tuple, M.block_sums(b, ["lang"], bits).collect()), key=str)     # noqa: E731
    got = {(lang, n): (nd, t) for lang, n, nd, t, _ in sums(blocks, 3)}
    for lang in ("x", None):
        for n in (1, 2, 4):
            grams = [tuple(t[i:i + n]) for _, l, t, _ in rows if l == lang for i in range(len(t) - n + 1)]
            assert got[lang, n] == (len(set(grams)), len(grams))
    assert [s[:4] for s in sums(G.deal_blocks(blocks, ["lang"], 6), 6)] == [s[:4] for s in sums(blocks, 3)]


def test_ngrams_of_one_sort_key_are_told_apart():
    import numpy as np
    import pyarrow as pa
    schema = G.T.StructType([G.T.StructField(c, G.T.LongType()) for c in ("part", "n", "d", "base", "step", "low", "c")])
    keep = pa.table({"n": pa.array([1], pa.int8()), "d": pa.array([1], pa.int8())})
    top, low = np.array([1, 2, 1, 2, 1]), np.array([7, 7, 7, 7, -7])
    block = G._blocks(0, keep, np.zeros(5, np.int64), top, low, np.array([1, 1, 300, 1, 1]), schema)
    _, _, _, t, l, c = G.added(pa.Table.from_batches([block, block]), [])
    assert sorted(zip(t.tolist(), l.tolist(), c.tolist())) == [(1, -7, 2), (1, 7, 602), (2, 7, 4)]


def test_texts_of_large_inputs_are_not_dealt(spark, monkeypatch):
    df = spark.range(10).select(F.col("id").alias("pair_id"), F.lit("a b").alias("pred"))
    assert "Repartition" in plan_of(M.by_pair(df))
    monkeypatch.setattr(M, "SPREAD_BYTES", 0)
    assert "Repartition" not in plan_of(M.by_pair(df))


def test_bigram_queries_group_strings(spark):
    from colloquy.plans import registry as R
    df = spark.createDataFrame([("x", ["a", "b", "a", "b"]), ("y", ["a"]), ("y", []), (None, ["b", "a"]), ("x", None)], "lang string, t array<string>")
    rows = R._bigrams(df)
    assert rows.schema["gram"].dataType.simpleString() == "string"
    assert Counter(map(tuple, rows.collect())) == {("x", "a b"): 2, ("x", "b a"): 1, (None, "b a"): 1}


def test_subword_batches_are_held_compactly():
    import numpy as np
    from pyspark.sql import types as T
    from colloquy.operators import subword
    from colloquy.plans import registry as R
    tok = subword.piece_factory(subword.public_path(R.PIECES))()
    a, b = tok.tokenize("over the hills"), tok.tokenize("the hills are over")
    assert a and all(x is y for x in a for y in b if x == y)
    ids = subword._compact(tok.ids, T.IntegerType())
    assert ids("over the hills").dtype == np.int32 and ids("over the hills").tolist() == tok.ids("over the hills")
    assert ids(None).tolist() == ids("").tolist() == []
