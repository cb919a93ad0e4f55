"""Positional operators against pandas, with groups forced across partitions."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from colloquy.operators import split as S
from colloquy.operators.positional import rank_within, top_k_per_group
from colloquy.sources import fixtures as X

from .conftest import SF01


def docs(spark):
    return X.table(spark, SF01, "documents").select("doc_id", "lang")


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_rank_within_matches_pandas(spark, parts):
    got = rank_within(docs(spark), ["lang"], ["doc_id"], num_partitions=parts).toPandas()
    want = docs(spark).toPandas()
    want["rn"] = want.groupby("lang")["doc_id"].rank(method="first").astype(int)
    want["n"] = want.groupby("lang")["doc_id"].transform("count")
    m = got.merge(want, on=["doc_id", "lang"], suffixes=("", "_w"))
    assert len(m) == len(want) == len(got)
    assert (m["rn"] == m["rn_w"]).all() and (m["n"] == m["n_w"]).all()


def test_top_k_exact(spark):
    d = docs(spark).withColumn("o", S.seeded_order("doc_id"))
    got = top_k_per_group(d, ["lang"], ["o"], 7, salt_buckets=5).toPandas()
    p = d.toPandas().sort_values("o")
    want = p.groupby("lang").head(7)
    assert sorted(got["doc_id"]) == sorted(want["doc_id"])


def test_tail_split_disjoint_complete(spark):
    s = S.split_tail(docs(spark), "doc_id", 10, 1.1).toPandas()
    assert len(s) == docs(spark).count() and s["doc_id"].is_unique
    for lang, g in s.groupby("lang"):
        g = g.sort_values("doc_id")
        n = len(g)
        train = int((n - 10) / 1.1)
        assert list(g["split"]) == ["train"] * train + ["eval"] * (n - 10 - train) + ["test"] * 10


def test_tail_split_of_a_small_language_is_all_test(spark):
    s = S.split_tail(docs(spark), "doc_id", 10_000).toPandas()
    assert len(s) == docs(spark).count() and set(s["split"]) == {"test"}


def test_ratio_split_caps(spark):
    s = S.split_ratio(docs(spark), "doc_id", (0.85, 0.93), (50, 5, 5)).toPandas()
    for (lang, split), g in s.groupby(["lang", "split"]):
        assert len(g) <= {"train": 50, "eval": 5, "test": 5}[split]
    uncapped = S.split_ratio(docs(spark), "doc_id", (0.85, 0.93), None).toPandas()
    for lang, g in uncapped.groupby("lang"):
        n = len(g)
        assert (g["split"] == "train").sum() == int(n * 0.85)
        assert (g["split"] == "eval").sum() == int(n * 0.93) - int(n * 0.85)


def test_percent_split_validation():
    with pytest.raises(ValueError):
        S.split_percent(None, "k", [90, 80])
    with pytest.raises(ValueError):
        S.split_percent(None, "k", [10, 100])


def test_select_split(spark):
    s = S.split_tail(docs(spark), "doc_id", 10)
    assert S.select_split(s, "val").select("split").distinct().first()["split"] == "eval"
    with pytest.raises(ValueError):
        S.select_split(s, "dev")


def test_sizes(spark):
    s = S.split_percent(docs(spark), "doc_id", [80, 95])
    n = {k: S.select_split(s, k).groupBy("lang").count().toPandas().set_index("lang")["count"] for k in ("train", "val", "test")}
    for name, small, full, cap in (("train", True, 50, 50), ("val", True, 50, 5), ("test", 7, 50, 7), ("test", None, 50, 10 ** 9)):
        got = S.sized_split(s, name, "doc_id", small, full).groupBy("lang").count().toPandas().set_index("lang")["count"]
        assert got.to_dict() == n[name].clip(upper=cap).to_dict()
    assert S.sized_split(s, "val", "doc_id", 5, 50).count() == 0



def test_input_order_does_not_change_splits(spark):
    d = docs(spark)
    a = sorted(tuple(r) for r in S.split_ratio(d, "doc_id", (0.85, 0.93), (50, 5, 5)).collect())
    shuffled = d.repartition(7).orderBy(F.md5(F.col("doc_id").cast("string")))
    b = sorted(tuple(r) for r in S.split_ratio(shuffled, "doc_id", (0.85, 0.93), (50, 5, 5)).collect())
    assert a == b


def test_rank_within_stable_when_range_bounds_are_sampled(spark):
    # 10000 rows, round-robined: more rows per partition than the range
    # partitioner samples, so a re-sampled second read would differ.
    d = X.table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "lang")
    want = d.toPandas()
    want["rn"] = want.groupby("lang")["doc_id"].rank(method="first").astype(int)
    for _ in range(3):
        got = rank_within(d.repartition(8), ["lang"], ["doc_id"], num_partitions=8).toPandas()
        m = got.merge(want, on=["doc_id", "lang"], suffixes=("", "_w"))
        assert len(got) == len(want) == len(m)
        assert (m["rn"] == m["rn_w"]).all()
