"""Language id, corpus building, encoding, streaming, entry points."""

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from colloquy.operators import encode as EN
from colloquy.operators import langid
from colloquy.operators.corpus import DETAILED_COLUMNS, zip_comments
from colloquy.plans import registry as R
from colloquy.session import scratch_path
from colloquy.sources import fixtures as X
from colloquy.sources.io import write_comments_json
from colloquy.streaming.incremental import read_output, zip_stream

from .conftest import SF001, SF01


def test_classifier_on_held_out_documents(spark):
    m = R.lang_model(spark, SF01)
    held = X.table(spark, SF001, "documents").select("doc_id", "text", F.col("lang").alias("truth"))
    got = langid.classify(held.select("doc_id", "text"), "doc_id", "text", m).join(held, "doc_id")
    rows = got.collect()
    assert len(rows) == held.count()
    right = sum(r["lang"] == r["truth"] for r in rows)
    assert right / len(rows) > 0.95
    assert all(0.0 < r["prob"] <= 1.0 for r in rows)


def test_corpus_chain_counts(spark):
    assert R.q_zip_comments(spark, SF01).count() == 418
    assert R.q_generate_dialogues(spark, SF01).count() == 318
    d = R.q_dialogue_corpus(spark, SF01)
    assert d.count() == 121
    assert d.where(F.col("source_body").contains("\n") | F.col("target_body").contains("\n")).count() == 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["lang", "title", "source_body", "target_body", "link_id", "source_id", "target_id"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_encode_shapes(spark):
    v = R.vocab(spark, SF001)
    e = EN.encode_fixed(X.turn_pairs(spark, SF001), "pair_id", v).collect()
    assert all(len(r["input_ids"]) == 50 and len(r["labels"]) == 50 for r in e)
    for r in e:
        n = sum(r["attention_mask"])
        assert r["input_ids"][n - 1] == 1 and all(x == 0 for x in r["input_ids"][n:])
    p = EN.pack_pairs(X.turn_pairs(spark, SF001), "pair_id", v).collect()
    assert all(r["input_ids"] == r["labels"] and r["input_ids"][-1] == 1 for r in p)


def test_decode_round_trip(spark):
    v = R.vocab(spark, SF001)
    t = X.turn_pairs(spark, SF001)
    enc = EN.encode_fixed(t, "pair_id", v)
    dec = EN.decode(enc, "pair_id", "labels", v).join(t, "pair_id").collect()
    for r in dec:
        assert r["text"] == " ".join(r["target_body"].split()[:49])


def test_stream_equals_batch_and_restart_adds_none(spark):
    m = R.lang_model(spark, SF001)
    langs = R.QUERY_LANGS
    base = scratch_path(spark, "t-stream")
    write_comments_json(X.comments(spark, SF001), f"{base}/in", files=2)
    zip_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", m, langs, files_per_batch=1)
    out = read_output(spark, f"{base}/out")
    assert out.select("batch").distinct().count() == 2
    batch = zip_comments(X.comments(spark, SF001), m, langs)
    a = sorted(tuple(r) for r in out.select(*DETAILED_COLUMNS).collect())
    b = sorted(tuple(r) for r in batch.collect())
    assert a == b and len(a) > 0
    zip_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", m, langs, files_per_batch=1)
    assert read_output(spark, f"{base}/out").count() == len(a)


def test_corrupt_checkpoint_fails(spark):
    import glob
    m = R.lang_model(spark, SF001)
    base = scratch_path(spark, "t-corrupt")
    write_comments_json(X.comments(spark, SF001), f"{base}/in", files=1)
    zip_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", m, R.QUERY_LANGS)
    for f in glob.glob(f"{base.replace('file:', '')}/ck/offsets/*"):
        with open(f, "w") as fh:
            fh.write("not an offset log")
    with pytest.raises(Exception):
        zip_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", m, R.QUERY_LANGS)


def test_split_sink_overwrites_only_written_partitions(spark):
    from colloquy.operators import split as S
    from colloquy.sources.io import read_splits, write_splits
    docs = X.table(spark, SF001, "documents").select("doc_id", "lang")
    path = scratch_path(spark, "t-splits")
    write_splits(S.split_tail(docs, "doc_id", 2), path)
    before = read_splits(spark, path)
    n_all, n_en = before.count(), before.where("lang = 'en'").count()
    # rewrite the English partitions only, with every English row marked test
    en = docs.where("lang = 'en'").withColumn("split", F.lit("test"))
    write_splits(en, path)
    after = read_splits(spark, path)
    assert after.where("lang <> 'en'").count() == n_all - n_en
    assert read_splits(spark, path, lang="en").where("split = 'test'").count() == n_en


def test_generate_stream_equals_batch(spark):
    from colloquy.operators.corpus import DIALOGUE_COLUMNS, generate_dialogues
    from colloquy.sources.io import write_detailed
    from colloquy.streaming.incremental import generate_stream
    m = R.lang_model(spark, SF001)
    langs = R.QUERY_LANGS
    det = R.detailed(spark, SF001)
    base = scratch_path(spark, "t-gen-stream")
    write_detailed(det.repartition(3), f"{base}/detailed")
    com, sub = X.comments(spark, SF001), X.submissions(spark, SF001)
    generate_stream(spark, f"{base}/detailed", f"{base}/out", f"{base}/ck", com, sub, m, langs, files_per_batch=1)
    got = sorted(tuple(r) for r in read_output(spark, f"{base}/out").select(*DIALOGUE_COLUMNS).collect())
    want = sorted(tuple(r) for r in generate_dialogues(det, com, sub, m, langs).collect())
    assert got == want and len(got) > 0


def test_build_corpus_matches_registered_chain(spark):
    from colloquy.functions import fixed_values as V
    from colloquy.operators import infer as I
    from colloquy.plans.corpus import CorpusPaths, build_corpus, evaluate_corpus
    m = R.lang_model(spark, SF01)
    base = scratch_path(spark, "t-build")
    write_comments_json(X.comments(spark, SF01), f"{base}/dump", files=3)
    out = build_corpus(spark, f"{base}/dump", X.submissions(spark, SF01), m, CorpusPaths.under(base),
                       R.QUERY_LANGS, caps=None)
    assert out["detailed"].count() == 418
    assert out["dialogues"].count() == 318
    cleaned = sorted(tuple(r) for r in out["cleaned"].collect())
    assert cleaned == sorted(tuple(r) for r in R.q_dialogue_corpus(spark, SF01).collect())
    splits = out["splits"]
    assert splits.count() == len(cleaned)
    metrics = evaluate_corpus(spark, CorpusPaths.under(base).splits, I.echo_model, metric="bleu")
    assert metrics.select("lang").distinct().count() >= 1


def test_two_months_equal_one_dump_and_reruns_replace(spark):
    from colloquy.plans.corpus import CorpusPaths, build_corpus
    m = R.lang_model(spark, SF01)
    base = scratch_path(spark, "t-months")
    c = X.comments(spark, SF01)
    first = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    write_comments_json(c, f"{base}/all")
    write_comments_json(c.where(first), f"{base}/m1")
    write_comments_json(c.where(~first), f"{base}/m2")
    build = lambda dump, to, run: build_corpus(spark, f"{base}/{dump}", X.submissions(spark, SF01), m,
                                               CorpusPaths.under(f"{base}/{to}"), R.QUERY_LANGS, caps=None, run=run)
    whole = build("all", "one", "all")
    before = sorted(map(tuple, whole["splits"].collect()))
    whole = build("all", "one", "all")
    assert sorted(map(tuple, whole["splits"].collect())) == before
    build("m1", "two", "m1")
    build("m2", "two", "m2")
    two = build("m1", "two", "m1")          # the first month once more, now that all parents are landed
    rows = [r["target_id"] for r in two["cleaned"].collect()]
    assert len(rows) == len(set(rows))
    assert sorted(rows) == sorted(r["target_id"] for r in whole["cleaned"].collect())


def test_repeated_ids_are_classified_by_their_own_body(spark):
    m = R.lang_model(spark, SF01)
    d = X.documents_corpus(spark, SF01).where("lang in ('en', 'fr')").selectExpr("lang", "substr(text, 1, 300) body")
    en, fr = (d.where(F.col("lang") == x).first()["body"] for x in ("en", "fr"))
    from colloquy.operators.corpus import with_language
    rows = spark.createDataFrame([("a", en), ("a", en), ("a", fr), ("b", en)], "id string, body string")
    got = with_language(rows, m).collect()
    assert sorted((r["id"], r["lang"]) for r in got) == [("a", "en"), ("a", "en"), ("a", "fr"), ("b", "en")]
    assert len({round(r["prob"], 9) for r in got if r["body"] == en}) == 1


def test_detected_codes_that_a_language_accepts(spark):
    from colloquy.functions.text import accepts
    rows = [("zh", "zh-cn"), ("zh", "zh-tw"), ("zh", "zh"), ("zh", "zh-hk"), ("fi", "fi"), ("fi", "fil")]
    got = spark.createDataFrame(rows, "l string, c string").select(accepts("l", "c").alias("x")).collect()
    assert [r["x"] for r in got] == [True, True, False, False, True, False]


def test_a_malformed_line_fails_the_job(spark, tmp_path):
    from colloquy.sources.io import read_comments
    (tmp_path / "x.json").write_text('{"id": "a", "body": "b"}\n{"id": "c", \n')
    with pytest.raises(Exception):
        read_comments(spark, str(tmp_path)).collect()


def test_python_white_space_and_digits(spark):
    from colloquy.functions.text import strip_ws, whitelist_filter, whitespace_tokens
    t = "\u3000a\u001fb\u00a0c \u0664\u0665\u2003"
    r = spark.createDataFrame([(t,)], "t string").select(whitespace_tokens("t").alias("w"), strip_ws("t").alias("s"),
                                                        whitelist_filter("t").alias("f")).first()
    assert r["w"] == t.split() and r["s"] == t.strip() and "\u0664\u0665" in r["f"]


def test_empty_sides_and_zero_vectors_score_nothing(spark):
    from colloquy.operators.metrics import greedy_match_pairs
    rows = [(1, "pred", [1.0, 0.0]), (1, "ref", [1.0, 0.0]), (2, "ref", [1.0, 0.0]), (3, "pred", [0.0, 0.0]), (3, "ref", [0.0, 1.0])]
    v = spark.createDataFrame([(p, s, 0, x) for p, s, x in rows], "pair_id long, side string, pos long, vec array<double>")
    got = {r["pair_id"]: r["f1"] for r in greedy_match_pairs(v).collect()}
    assert got == {1: 1.0, 2: 0.0, 3: 0.0}


def test_encoding_keeps_every_row(spark):
    from colloquy.operators import encode as EN
    rows = [("a", "x y", "z"), ("a", "x y", "z"), ("a", "y", None), ("b", None, None), ("c", "", "x")]
    df = spark.createDataFrame(rows, "pair_id string, source_body string, target_body string")
    v = EN.build_vocab(df, ["source_body", "target_body"])
    e = EN.encode_fixed(df, "pair_id", v)
    text = {r["token"]: r["id"] for r in v.table.collect()}
    first = sorted((r["pair_id"], r["input_ids"][0], r["labels"][0]) for r in e.collect())
    assert first == sorted([("a", text["x"], text["z"])] * 2 + [("a", text["y"], 1), ("b", 1, 1), ("c", 1, text["x"])])
    d = sorted((r["pair_id"], r["text"]) for r in EN.decode(e, "pair_id", "input_ids", v).collect())
    assert d == [("a", "x y"), ("a", "x y"), ("a", "y"), ("b", ""), ("c", "")]


def test_model_is_loaded_once_per_worker():
    from colloquy.operators import infer as I
    calls = []
    for _ in range(3):
        I._loaded("m", lambda: calls.append(1) or "model")
    assert calls == [1]
    for i in range(I.MODELS_KEPT):
        assert I._loaded(f"other{i}", lambda: i) == i
    assert "m" not in I._MODELS and len(I._MODELS) == I.MODELS_KEPT
