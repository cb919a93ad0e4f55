"""The gram model scored inside the tasks equals the join of its rows."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators import corpus as C
from colloquy.operators import langid
from colloquy.session import ship_package
from colloquy.sources import fixtures as X

from .conftest import SF001

ODD = [("a", "", "x"), ("b", None, "x"), ("c", "ab", "x"), ("d", "ÀÉ ßİ the and 中文字 \U0001F600\U0001F600", "y"), ("e", "中文字符 the", "y"),
       (None, "the the and", "y"), ("f", "the the and", "y"), ("f", "the the and", "y"), ("f", "und nicht das", "y")]


@pytest.mark.parametrize("order", [2, 3])
def test_held_model_equals_join(spark, order):
    ship_package(spark)
    odd = spark.createDataFrame(ODD, "id string, body string, subreddit string")
    corpus = X.documents_corpus(spark, SF001).unionByName(odd.select(F.lit("zz").alias("lang"), F.col("body").alias("text")))
    m = langid.train_model(corpus, order)
    t = corpus.where("text is not null")
    want = langid.text_grams(t, ["lang"], "text", order).groupBy("gram", "lang").agg(F.log1p(F.count(F.lit(1)).cast("double")).alias("w"))
    assert {(r["gram"], r["lang"]): r["w"] for r in m.table().collect()} == pytest.approx({(r["gram"], r["lang"]): r["w"] for r in want.collect()})
    joined = langid.LangModel(m.grams, m.langs, order, _held=[None])
    rows = X.comments(spark, SF001).select("id", "body", "subreddit").unionByName(odd)
    for fn in (lambda x: langid.classify(rows, "id", "body", x).select("id", "lang", F.round("prob", 6)),
               lambda x: C.with_language(rows, x).select("id", "body", "subreddit", "lang", F.round("prob", 6))):
        got, want = (sorted(map(tuple, fn(x).collect()), key=str) for x in (m, joined))
        assert [r[:-1] for r in got] == [r[:-1] for r in want]
        assert [r[-1] for r in got] == pytest.approx([r[-1] for r in want], abs=2e-6)


def test_rows_are_labelled_without_exchange(spark):
    m = langid.train_model(X.documents_corpus(spark, SF001))
    plan = C.with_language(spark.createDataFrame(ODD, "id string, body string, subreddit string"), m)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
