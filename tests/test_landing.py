"""Byte-gram language id, bucketed months, published versions, late parents."""

import collections
import math
import re

import pytest
from pyspark.sql import functions as F

from colloquy.operators import bytegrams as B
from colloquy.operators import corpus as C
from colloquy.plans import corpus as P
from colloquy.plans import registry as R
from colloquy.session import scratch_path, ship_package
from colloquy.sources import fixtures as X
from colloquy.sources import io, landed, publish
from colloquy.streaming import incremental as S

from .conftest import SF001

CORPUS = [("en", "the cat sat on the mat", "a"), ("en", "the dog and the cat", "b"), ("en", "a hat on the dog", "b"), ("de", "der hund und die katze", "a"),
          ("de", "die katze saß auf der matte", "b"), ("fr", "le chat et le chien", "a"), ("fr", "été à la plage", None), ("fr", "", "b"),
          ("en", None, "a"), (None, "no label", "a")]


def grams(text, orders=B.ORDERS):
    raw = text.encode()
    return [raw[i:i + n].hex() for n in orders for i in range(len(raw) - n + 1)]


def brute_features(rows, per_lang):
    docs = [(la, s or "", set(grams(t))) for la, t, s in rows if la is not None and t is not None]
    n = len(docs)

    def info(labels, has):
        total = 0.0
        for label in set(labels):
            for value in (True, False):
                both = sum(a == label and b == value for a, b in zip(labels, has))
                if both:
                    total += both / n * math.log(both * n / (labels.count(label) * has.count(value)))
        return total
    out = {}
    for lang in {d[0] for d in docs}:
        cand = set().union(*(d[2] for d in docs if d[0] == lang))
        scored = []
        for g in cand:
            has = [g in d[2] for d in docs]
            scored.append((-round(info([d[0] == lang for d in docs], has) - info([d[1] for d in docs], has), 9), g))
        out[lang] = [(g, -s) for s, g in sorted(scored)[:per_lang]]
    return out


def corpus(spark):
    ship_package(spark)
    return spark.createDataFrame([(*r, "x", 7) for r in CORPUS], "lang string, text string, source string, code string, n int").repartition(3)


def test_selected_grams_equal_brute_force(spark):
    got = collections.defaultdict(list)
    for r in B.select_features(corpus(spark), 25).collect():
        got[r["lang"]].append((r["gram"], r["score"]))
    want = brute_features(CORPUS, 25)
    assert set(got) == set(want)
    for lang in want:
        assert sorted(g for g, _ in got[lang]) == sorted(g for g, _ in want[lang])
        assert dict(got[lang]) == pytest.approx(dict(want[lang]), abs=2e-9)


def test_byte_model_and_labels_equal_plain_python(spark):
    model = B.train_bytes(corpus(spark), 25)
    want = brute_features(CORPUS, 25)
    feats = sorted({g for rows in want.values() for g, _ in rows})
    docs = [(la, t) for la, t, _ in CORPUS if la is not None and t is not None]
    langs = sorted({la for la, _ in docs})
    weight, prior = {}, {}
    for la in langs:
        c = collections.Counter(g for x, t in docs if x == la for g in grams(t))
        total = sum(c[g] for g in feats) + len(feats)
        weight[la] = {g: math.log((c[g] + 1) / total) for g in feats}
        prior[la] = math.log(sum(x == la for x, _ in docs) / len(docs))
    texts = ["the hat", "die", "le chien et la plage", "", None, "中文", "the hat", "x" * 20_000 + " und der", "é"]
    df = spark.createDataFrame([(i, t, "old", 0.5) for i, t in enumerate(texts)], "id long, body string, lang string, prob double")
    got = {r["id"]: (r["lang"], r["prob"]) for r in B.classify_bytes(df, "body", model).collect()}
    for i, t in enumerate(texts):
        hits = [g for g in grams(t or "") if g in weight[langs[0]]]
        if not hits:
            assert i not in got
            continue
        score = {la: prior[la] + sum(weight[la][g] for g in hits) for la in langs}
        best = min(langs, key=lambda la: (-score[la], la))
        assert got[i][0] == best and got[i][1] == pytest.approx(1 / sum(math.exp(s - score[best]) for s in score.values()))
    plan = B.classify_bytes(df, "body", model)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan
    nothing = B.train_bytes(corpus(spark).where("false"))
    assert B.classify_bytes(df, "body", nothing).count() == 0


@pytest.mark.parametrize("held", [10, B.HELD_ROWS])
def test_counts_handed_on_early_are_the_same(spark, held):
    got = sorted(map(tuple, B._counted(B._labelled(corpus(spark), "source"), ["lang"], B.ORDERS, True, held_rows=held).collect()))
    assert got == sorted((la, c, n) for (la, c), n in collections.Counter(
        (la, (len(g) // 2 << 32) + int(g, 16)) for la, t, _ in CORPUS if la and t is not None for g in set(grams(t))).items())


def test_zip_by_bytes_is_one_map(spark):
    ship_package(spark)
    model = R.byte_model(spark, SF001)
    c = spark.createDataFrame([("a", "u", "the (cat) and the dog", "l", "t1_b", True, "p", "s"), ("b", None, None, None, None, None, None, None)], io.COMMENT_SCHEMA)
    plan = C.zip_comments(c, model, R.QUERY_LANGS)._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_months_are_looked_up_without_moving_them(spark):
    base = scratch_path(spark, "t-buckets")
    c = X.comments(spark, SF001)
    first = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    landed.write_bucketed(c.where(first), f"{base}/a", 4)
    landed.write_bucketed(c.where(~first), f"{base}/b", 4)
    table = landed.open_folders(spark, [f"{base}/a", f"{base}/b"], 4)
    assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, c.select(table.columns).collect()), key=str)
    replies = c.where("subreddit = 'topic1'")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = landed.parents_of(replies, table, "t1")
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = sorted(r["id"] for r in found.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = {r["parent_id"][3:] for r in replies.collect() if r["parent_id"].startswith("t1")} & {r["id"] for r in c.collect()}
    assert got == sorted(want) and want
    # The one shuffle is that of the wanted ids; the comments are read by bucket.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Bucketed: true" in found._jdf.queryExecution().explainString(
        spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    side = plan[plan.index("FileScan"):] if "FileScan" in plan else ""
    assert "SortMergeJoin" in plan and side


def test_bloom_filter_keeps_all_wanted_and_few_others(spark):
    ids = spark.range(0, 60_000, 2).selectExpr("cast(id as string) id")
    got = landed.maybe_in(spark.range(60_000).selectExpr("cast(id as string) id", "id as bits", "id as words"), "id", landed.bloom_filter(ids, "id"))
    kept = {int(r["id"]) for r in got.collect()}
    assert kept >= set(range(0, 60_000, 2)) and len(kept) < 33_000
    assert landed.maybe_in(ids, "id", landed.bloom_filter(ids.where("false"), "id")).count() == 0
    assert landed.bloom_filter(ids, "id").count() <= landed.MOST_WORDS


def build(spark, base, dump, run, **more):
    m = R.lang_model(spark, SF001)
    return P.build_corpus(spark, f"{base}/{dump}", X.submissions(spark, SF001), m, P.CorpusPaths.under(f"{base}/corpus"), R.QUERY_LANGS,
                          caps=None, run=run, buckets=4, **more)


def test_a_failed_run_changes_nothing_readable(spark, monkeypatch):
    ship_package(spark)
    base = scratch_path(spark, "t-crash")
    c = X.comments(spark, SF001)
    io.write_comments_json(c, f"{base}/m1")
    io.write_comments_json(c.withColumn("id", F.concat("id", F.lit("z"))), f"{base}/m2")
    build(spark, base, "m1", "m1")
    out = P.CorpusPaths.under(f"{base}/corpus")
    tables = (out.raw, out.detailed, out.dialogues, out.cleaned, out.splits)
    before = {t: sorted(map(str, publish.read_published(spark, t).collect())) for t in tables}
    assert before[out.splits]

    def broken(*args, **kw):
        raise RuntimeError("lost")
    for module, name in ((P.C, "zip_comments"), (P.C, "generate_dialogues"), (P.C, "clean_dialogues"), (P.S, "split_ratio"), (P.publish, "publish")):
        for run in ("m1", "m2"):
            with monkeypatch.context() as m:
                m.setattr(module, name, broken)
                with pytest.raises(RuntimeError):
                    build(spark, base, run, run)
        assert publish.current(spark, f"{base}/corpus").number == 1
    assert {t: sorted(map(str, publish.read_published(spark, t).collect())) for t in tables} == before
    assert io.read_splits(spark, out.splits).count() == len(before[out.splits])
    gone = publish.vacuum(spark, f"{base}/corpus", [publish.split_path(t)[1] for t in tables])
    assert len(gone) > 10
    assert {t: sorted(map(str, publish.read_published(spark, t).collect())) for t in tables} == before
    build(spark, base, "m2", "m2")
    assert publish.current(spark, f"{base}/corpus").number == 2
    assert publish.read_published(spark, out.raw).count() == 2 * len(before[out.raw])
    assert publish.read_published(spark, out.raw, runs=["m1"]).count() == len(before[out.raw])


def test_two_writers_of_one_number(spark):
    root = scratch_path(spark, "t-versions")
    assert publish.current(spark, root) is None
    v = publish.publish(spark, root, publish.Version().with_run("t", "a", "f1"))
    assert publish.current(spark, root) == v and v.number == 1
    one, two = v.with_run("t", "b", "f2"), v.with_run("t", "c", "f3")
    publish.publish(spark, root, one)
    with pytest.raises(Exception):
        publish.publish(spark, root, two)
    assert publish.current(spark, root).tables == {"t": {"a": "f1", "b": "f2"}}
    assert publish.folders(spark, f"{root}/none") == []
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, f"{root}/none")


def test_late_parents_wait(spark):
    ship_package(spark)
    m, det, com, sub = R.lang_model(spark, SF001), R.detailed(spark, SF001), X.comments(spark, SF001), X.submissions(spark, SF001)
    want = sorted(tuple(r) for r in C.generate_dialogues(det, com, sub, m, R.QUERY_LANGS).collect())
    base = scratch_path(spark, "t-late")
    io.write_detailed(det.repartition(1), f"{base}/detailed")
    some = com.where(F.pmod(F.xxhash64("id"), F.lit(3)) == 0)

    def read():
        return sorted(tuple(r) for r in S.read_output(spark, f"{base}/out").select(*C.DIALOGUE_COLUMNS).collect())

    def stream(**more):
        S.generate_stream(spark, f"{base}/detailed", f"{base}/out", f"{base}/ck", lambda n: some, sub, m, R.QUERY_LANGS, files_per_batch=2,
                          pending=f"{base}/pending", **more)
    stream()
    early = read()
    assert 0 < len(early) < len(want) and set(early) < set(want)
    assert S.settle(spark, f"{base}/out", f"{base}/pending", some, sub, m, R.QUERY_LANGS) > 0
    assert read() == early
    left = S.settle(spark, f"{base}/out", f"{base}/pending", com, sub, m, R.QUERY_LANGS)
    assert left == det.where("parent_id like 't1%'").join(com.select(F.concat(F.lit("t1_"), "id").alias("parent_id")), "parent_id", "left_anti").count()
    assert read() == want
    # New replies after that find what waits; nothing is lost or doubled.
    extra = det.where("parent_id like 't1%'").withColumn("id", F.concat("id", F.lit("again")))
    io.write_detailed(extra.repartition(1), f"{base}/detailed")
    stream()
    assert S.settle(spark, f"{base}/out", f"{base}/pending", com, sub, m, R.QUERY_LANGS) == 2 * left
    assert len(read()) == 2 * len(want) and S.settle(spark, f"{base}/none", f"{base}/none", com, sub, m) == 0


def test_replies_wait_for_a_number_of_batches(spark):
    ship_package(spark)
    m, det, com, sub = R.lang_model(spark, SF001), R.detailed(spark, SF001), X.comments(spark, SF001), X.submissions(spark, SF001)
    base = scratch_path(spark, "t-wait")
    io.write_detailed(det.repartition(3), f"{base}/detailed")
    S.generate_stream(spark, f"{base}/detailed", f"{base}/out", f"{base}/ck", lambda n: com.where("false"), sub, m, R.QUERY_LANGS,
                      files_per_batch=2, pending=f"{base}/pending", keep_batches=1)
    n, _, name = S._steps(spark, f"{base}/pending")[-1]
    since = {r["since"] for r in spark.read.schema(S.PENDING_SCHEMA).parquet(f"{base}/pending/{name}").collect()}
    assert n >= 2 and since and min(since) >= n - 1 and len(S._steps(spark, f"{base}/pending")) <= 2
