"""Operator 4: hashes and probes follow from the data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import ann
from colloquy.session import ship_package


def frame(spark, x):
    ship_package(spark)
    return spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)


def classes_of(df):
    return df.selectExpr("vec_id cid", "embedding v"), df.where("vec_id % 50 = 0").selectExpr("vec_id query_id", "vec_id qcid")


def visits(x, queries, hashes, probes):
    """Share of the rows that a query meets."""
    u = ann._unit(x)
    own = ann.buckets(u, ann.TABLES, hashes, 1)[:, :, 0]
    ask = ann.buckets(u[queries], ann.TABLES, hashes, probes)
    return np.mean([(own[:, :, None] == a[None]).any(2).any(1).mean() for a in ask])


def test_near_neighbours_are_found_among_few_rows(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(200, 32))
    x = centres[rng.integers(0, 200, 4000)] + 0.25 * rng.normal(size=(4000, 32))
    df = frame(spark, x)
    hashes, probes = ann.settings(*classes_of(df))
    queries = np.arange(0, 4000, 50)
    assert hashes > 1 and visits(x, queries, hashes, probes) < 0.1
    u = ann._unit(x)
    sims = u[queries] @ u.T
    sims[np.arange(len(queries)), queries] = -9
    want = np.argsort(-sims, axis=1, kind="stable")[:, :5]
    got = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(got[q] & set(w.tolist())) for q, w in zip(queries.tolist(), want))
    assert hits >= 0.9 * want.size and all(len(v) == 5 for v in got.values())


def test_unstructured_vectors_take_one_hash_and_more_probes(spark):
    df = frame(spark, np.random.default_rng(1).normal(size=(1500, 32)))
    hashes, probes = ann.settings(*classes_of(df))
    assert hashes == 1 and probes >= 6


@pytest.mark.parametrize("rows", [[], [[1.0, 0.0]], [[1.0, 0.0]] * 3])
def test_settings_of_next_to_nothing(spark, rows):
    df = frame(spark, np.array(rows).reshape(len(rows), 2))
    v = df.dropDuplicates(["embedding"])
    hashes, probes = ann.settings(*classes_of(v))
    assert hashes in ann.HASHES and probes in ann.PROBES
    assert ann.search(df, F.lit(True), k=1).count() == (len(rows) if len(rows) > 1 else 0)
