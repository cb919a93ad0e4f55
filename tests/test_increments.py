"""Cuts by histogram, byte ranges, subword tokens, monthly counts."""

import json
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from colloquy.operators import metrics as M
from colloquy.operators import subword
from colloquy.operators.corpus import DETAILED_COLUMNS, clean_dialogues, zip_comments
from colloquy.operators.positional import first_k_per_group
from colloquy.plans import monthly
from colloquy.plans import registry as R
from colloquy.session import scratch_path, ship_package
from colloquy.sources import fixtures as X
from colloquy.sources import publish, ranges
from colloquy.sources.io import COMMENT_SCHEMA, write_comments_json
from colloquy.streaming.incremental import read_output, zip_ranges

from .conftest import SF001


# --- the first k of every group ---

@pytest.mark.parametrize("kind, border", [("string", 7), ("long", 1), ("md5", 7), ("wide", 1), ("double", 7), ("long", 100_000)])
def test_first_rows_equal_brute_force(spark, kind, border):
    rnd = random.Random(kind + str(border))
    values = {"string": lambda: rnd.choice([None, "", "a", "t3_0001", "t3_0002", "t3_0002é", "t3_0010", "中", "\U0001F600"]) or str(rnd.randint(0, 300)),
              "long": lambda: rnd.choice([None, -(1 << 63), (1 << 63) - 1, 0, rnd.randint(0, 50), rnd.randint(-10**12, 10**12)]),
              "md5": lambda: f"{rnd.getrandbits(64):016x}", "wide": lambda: rnd.randint(0, 3), "double": rnd.random}[kind]
    rows = [(rnd.choice(["en", "en", "en", "de", None, "fr"]), values(), i) for i in range(400)] + [("one", values(), 1000)]
    kind_of = {"string": "string", "md5": "string", "double": "double"}.get(kind, "long")
    df = spark.createDataFrame(rows, f"lang string, o {kind_of}, key long").repartition(4)
    for k in (0, 5, 60):
        want = []
        groups = defaultdict(list)
        for r in rows:
            groups[r[0]].append(r)
        for g in groups.values():
            want += sorted(g, key=lambda r: ((r[1] is not None, r[1] if r[1] is not None else 0) if kind_of != "string"
                                             else (r[1] is not None, (r[1] or "").encode()), r[2]))[:k]
        got = first_k_per_group(df, ["lang"], ["o", "key"], k, border, hexadecimal=kind == "md5")
        assert got.columns == df.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    caps = F.when(F.col("lang") == "en", 20).otherwise(3)
    got = Counter(r["lang"] for r in first_k_per_group(df, ["lang"], ["o", "key"], caps, border).collect())
    assert got["en"] == 20 and got["de"] == got["fr"] == got[None] == 3 and got["one"] == 1
    assert first_k_per_group(df.where("false"), ["lang"], ["o", "key"], 5, border).count() == 0


# --- byte ranges ---

LINES = [b'{"id": "a"}', b"", b'{"id": "b", "body": "x y"}', "{\"id\": \"é\"}".encode(), b'{"id": "' + b"z" * 300 + b'"}', b"   ", b'{"id": "last"}']


@pytest.mark.parametrize("end", [b"", b"\n", b"\n\n"])
def test_every_border_gives_each_line_once(tmp_path, end):
    data = b"\n".join(LINES) + end
    path = tmp_path / "f.json"
    path.write_bytes(data)
    want = data.split(b"\n")[:-1] if data.endswith(b"\n") else data.split(b"\n")
    for step in (1, 2, 3, 7, 50, 1000):
        got = []
        for p in range(0, len(data), step):
            got += ranges.lines_of(str(path), p, min(p + step, len(data)), read_bytes=5)
        assert got == want


def test_batches_follow_each_other_over_files():
    files = [("a", 10), ("b", 3), ("c", 25)]
    at, seen = ("", 0), defaultdict(list)
    while True:
        got, at = ranges.next_ranges(files, at, 8, 3)
        if not got:
            break
        assert sum(e - s for _, s, e in got) <= 8 and all(0 < e - s <= 3 for _, s, e in got)
        for p, s, e in got:
            seen[p] += range(s, e)
    assert {p: v for p, v in seen.items()} == {p: list(range(n)) for p, n in files}


def test_a_stopped_file_goes_on_without_rereading(spark, monkeypatch):
    ship_package(spark)
    m = R.lang_model(spark, SF001)
    base = scratch_path(spark, "t-ranges")
    write_comments_json(X.comments(spark, SF001), f"{base}/in", files=1)
    (path, size), = ranges.list_files(spark, f"{base}/in")
    read = []
    inner = ranges.read_ranges
    monkeypatch.setattr(ranges, "read_ranges", lambda s, r, schema: read.append(r) or inner(s, r, schema))
    args = (spark, f"{base}/in", f"{base}/out", f"{base}/progress", m, R.QUERY_LANGS)
    assert zip_ranges(*args, batch_bytes=size // 2, split_bytes=1000, most=1) == 1
    half = read_output(spark, f"{base}/out").count()
    assert sum(e - s for r in read for _, s, e in r) == size // 2 and 0 < half
    # A batch that dies before it is recorded is done again, in place.
    with monkeypatch.context() as broken:
        broken.setattr(publish.Files, "write_new", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            zip_ranges(*args, batch_bytes=size, split_bytes=1000)
    del read[:]
    assert zip_ranges(*args, batch_bytes=size, split_bytes=1000) == 1
    assert min(s for r in read for _, s, _ in r) == size // 2 and sum(e - s for r in read for _, s, e in r) == size - size // 2
    want = sorted(map(tuple, zip_comments(X.comments(spark, SF001), m, R.QUERY_LANGS).select(*DETAILED_COLUMNS).collect()))
    assert sorted(map(tuple, read_output(spark, f"{base}/out").select(*DETAILED_COLUMNS).collect())) == want
    assert zip_ranges(*args, batch_bytes=size) == 0
    record = sorted(n for n in publish.Files(spark, base).names(f"{base}/progress"))[-1]
    assert json.loads(publish.Files(spark, base).read(f"{base}/progress/{record}"))["byte"] == size


def test_the_dump_is_written_in_parallel_and_left_inside_a_file(spark, monkeypatch):
    from colloquy.streaming import incremental
    seen, inner = [], incremental.zip_ranges

    def spy(session, src, out, progress, *args, **options):
        n = inner(session, src, out, progress, *args, **options)
        if options.get("most"):
            files, sizes = publish.Files(session, progress), dict(ranges.list_files(session, src))
            r = json.loads(files.read(f"{progress}/{sorted(files.names(progress))[-1]}"))
            seen.append((len(sizes), 0 < r["byte"] < sizes[r["path"]], options["split_bytes"] <= ranges.SPLIT_BYTES))
        return n
    monkeypatch.setattr(incremental, "zip_ranges", spy)
    got = sorted(map(tuple, R.q_zip_ranges(spark, SF001).collect()))
    assert got == sorted(map(tuple, R.q_zip_bytes(spark, SF001).select(*DETAILED_COLUMNS).collect()))
    assert len(seen) == 1 and seen[0][0] > 1 and seen[0][1:] == (True, True)


def test_grams_marked_in_tables_equal_hashed_ones():
    import numpy as np

    from colloquy.operators import bytegrams as B
    rnd = random.Random(2)
    texts = ["".join(rnd.choices("abé", k=rnd.randint(0, 30))).encode() for _ in range(40)] + [b""]
    label = np.array([rnd.choice((0, 3, 7)) for _ in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    for order in B.ORDERS:
        code, r = B.gram_codes(data, row, order)
        held = Counter((int(n) << 36) + g for n, t in zip(label, texts)
                       for g in {(order << 32) + int.from_bytes(t[i:i + order], "big") for i in range(len(t) - order + 1)})
        met = Counter(((label[r] << 36) + code).tolist())
        wanted = np.unique(code)
        for k, n in (B._documents_of(code, r, label), B._documents_of(code, r, label, cells=0)):
            assert dict(zip(k.tolist(), n.tolist())) == held
        k, n = B._occurrences(np.searchsorted(wanted, code), r, label, wanted)
        assert dict(zip(k.tolist(), n.tolist())) == met
    none = np.zeros(0, np.int64)
    assert all(len(x) == 0 for f in ((none, none, label), (none, none, none)) for x in B._documents_of(*f))
    assert all(len(x) == 0 for x in B._occurrences(none, none, none, none))


def test_ranges_refuse_bad_lines_and_records(spark, tmp_path):
    ship_package(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_bytes(b'{"id": "a"}\n{"id": \n')
    size = (tmp_path / "in" / "x.json").stat().st_size
    with pytest.raises(Exception):
        ranges.read_ranges(spark, [(str(tmp_path / "in" / "x.json"), 0, size)], COMMENT_SCHEMA).collect()
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "b000000000.json").write_text("no record")
    with pytest.raises(ValueError):
        ranges.each_batch(spark, str(tmp_path / "in"), str(tmp_path / "p"), COMMENT_SCHEMA, lambda rows, n: None, 10)


# --- subword tokens ---

def test_subword_tokens_equal_the_plain_tokenizer(spark):
    import sentencepiece
    ship_package(spark)
    path = subword.public_path(R.PIECES)
    model, f = sentencepiece.SentencePieceProcessor(model_file=path), subword.piece_factory(path)
    t = X.turn_pairs(spark, SF001)
    rows = t.collect()
    enc = {r["pair_id"]: r for r in subword.encode_fixed_pieces(t, "pair_id", f).collect()}
    for r in rows:
        e = enc[r["pair_id"]]
        for col, text in (("input_ids", r["source_body"]), ("labels", r["target_body"])):
            ids = model.encode(text)[:49] + [2]
            assert e[col] == ids + [0] * (50 - len(ids))
        assert e["attention_mask"] == [1] * min(50, len(model.encode(r["source_body"])) + 1) + [0] * max(0, 49 - len(model.encode(r["source_body"])))
    d = t.select(F.lit("x").alias("lang"), F.lit("").alias("title"), "source_body", "target_body", F.lit("").alias("link_id"),
                 F.lit("").alias("source_id"), F.col("pair_id").alias("target_id"))
    kept = {r["target_id"] for r in clean_dialogues(d, tokenizer=f).collect()}
    masked = clean_dialogues(d, lo=-1, hi=1 << 30).collect()
    assert kept == {r["target_id"] for r in masked if all(4 < len(model.encode(r[c])) < 80 for c in ("source_body", "target_body"))}
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "a  b"), (4, "中文 \U0001F600")], "k int, t string")
    got = {r["k"]: r["p"] for r in odd.select("k", subword.pieces("t", f).alias("p")).collect()}
    assert got == {1: [], 2: [], 3: model.encode("a  b", out_type=str), 4: model.encode("中文 \U0001F600", out_type=str)}


def test_bleu_over_subwords_equals_plain_counts(spark):
    import sentencepiece
    ship_package(spark)
    path = subword.public_path(R.PIECES)
    model, f = sentencepiece.SentencePieceProcessor(model_file=path), subword.piece_factory(path)
    p = X.predictions(spark, SF001).limit(30)
    rows = p.collect()
    got = {r["name"]: r["value"] for r in M.bleu(p, tokens=lambda c: subword.pieces(c, f)).collect()}
    match, total, sys_len, ref_len = Counter(), Counter(), 0, 0
    for r in rows:
        a, b = ([x.strip("▁") for x in model.encode(r[c], out_type=str)] for c in ("pred", "ref"))
        sys_len, ref_len = sys_len + len(a), ref_len + len(b)
        for n in range(1, 5):
            x, y = (Counter(tuple(s[i:i + n]) for i in range(len(s) - n + 1)) for s in (a, b))
            match[n] += sum((x & y).values())
            total[n] += sum(x.values())
    for n in range(1, 5):
        assert got[f"precision_{n}"] == pytest.approx(match[n] / total[n], abs=1e-12)
    bp = 1.0 if sys_len > ref_len else math.exp(1 - ref_len / sys_len)
    assert got["bleu"] == pytest.approx(bp * math.exp(sum(math.log(match[n] / total[n]) for n in range(1, 5)) / 4), abs=1e-12)


# --- monthly counts ---

def test_monthly_diversity_equals_one_pass(spark):
    p = X.predictions(spark, SF001)
    want = sorted(map(tuple, M.diversity(M.with_metric_tokens(p), by=["lang"]).collect()))
    root = scratch_path(spark, "t-diversity")
    for k in (0, 1, 2, 1):
        monthly.add_diversity_run(p.where(F.col("pair_id") % 3 == k), root, f"m{k}", ["lang"])
    got = sorted(map(tuple, monthly.diversity_report(spark, root, ["lang"]).collect()))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-9)
    one = sorted(map(tuple, M.diversity(M.with_metric_tokens(p.where("pair_id % 3 = 2")), by=["lang"]).collect()))
    part = sorted(map(tuple, monthly.diversity_report(spark, root, ["lang"], runs=["m2"]).collect()))
    assert [r[3] for r in part] == pytest.approx([r[3] for r in one], abs=1e-9)


def test_a_month_counted_again_leaves_one_folder_and_no_shuffles(spark, monkeypatch):
    from colloquy.plans import registry
    from colloquy.sources import publish
    gone, vacuum = [], publish.vacuum
    monkeypatch.setattr(publish, "vacuum", lambda *a, **k: gone.extend(vacuum(*a, **k)) or gone)
    registry.q_diversity_months(spark, SF001).collect()
    assert len(gone) == 2 and all("/m0-" in g for g in gone)
    root = scratch_path(spark, "t-grams")
    monthly.add_diversity_run(X.predictions(spark, SF001), root, "m0", ["lang"])
    blocks = publish.read_published(spark, f"{root}/grams")
    assert blocks.schema["low"].dataType.simpleString() == "binary" and blocks.count() < 1000


def test_length_report_has_every_total(spark):
    rows = [("en", "train", 3), ("en", "train", 5), ("en", "test", 5), ("de", "train", 1), (None, "test", 9), ("all", "train", 2)]
    df = spark.createDataFrame(rows, "lang string, split string, n int")
    counts = monthly.length_counts(df, F.col("n"), F.col("n") * 10)
    got = [tuple(r) for r in monthly.length_report(counts.unionByName(counts), quantiles=(0.5, 1.0)).collect()]
    want = []
    for by_lang in (0, 1):
        for by_split in (0, 1):
            groups = defaultdict(list)
            for la, sp, n in rows * 2:
                groups[la if by_lang else "all", sp if by_split else "all"].append(n)
            want += [(*k, len(v), sum(v) / len(v), 10 * sum(v), sorted(v)[math.ceil(len(v) * 0.5) - 1], max(v)) for k, v in groups.items()]
    assert sorted(got, key=str) == sorted(want, key=str)


# --- A10 from texts, S3 ---

def test_vectors_and_scores_of_texts_equal_plain_python(spark):
    import hashlib

    import numpy as np

    from colloquy.operators import embeddings as EM
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(12)] + ["é", "the"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9))), " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9)))) for i in range(30)]
    rows += [(100, "w1 the w2 w3", "w1 the w2 w3"), (101, "", "w1"), (102, None, None), (103, "lonely", "lonely")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "pair_id long, pred string, ref string, vec string").repartition(3)
    texts = [(t or "").split() for r in rows for t in r[1:]]
    c = Counter()
    for t in texts:
        for i in range(len(t)):
            for j in range(max(0, i - 2), min(len(t), i + 3)):
                if i != j:
                    c[t[i], t[j]] += 1
    s, total = Counter(), sum(c.values())
    for (a, _), n in c.items():
        s[a] += n
    vec = defaultdict(lambda: np.zeros(32))
    for (a, b), n in c.items():
        p = math.log(n * total / (s[a] * s[b]))
        if p > 0:
            vec[a] = vec[a] + p * np.array([1.0 if x >= "8" else -1.0 for x in hashlib.md5(b.encode()).hexdigest()])
    got = {r["token"]: r["vec"] for r in EM.token_vectors(df, ["pred", "ref"]).collect()}
    assert set(got) == set(vec) and "lonely" not in got
    for t, v in vec.items():
        assert got[t] == pytest.approx(v.tolist(), abs=1e-9)

    def score(a, b):
        a, b = ([vec[x] / np.linalg.norm(vec[x]) for x in (t or "").split() if x in vec] for t in (a, b))
        if not a or not b:
            return 0.0, 0.0, 0.0
        m = np.array(a) @ np.array(b).T
        p, r = m.max(1).mean(), m.max(0).mean()
        return p, r, 2 * p * r / (p + r) if p + r else 0.0
    want = np.mean([score(a, b) for _, a, b in rows], axis=0)
    out = {r["name"]: r["value"] for r in EM.bertscore_texts(df).collect()}
    assert [out[n] for n in ("precision", "recall", "f1")] == pytest.approx(want.tolist(), abs=1e-9)
    same = df.where("pair_id = 100 or pair_id < 5").withColumn("ref", F.col("pred")).where("length(pred) > 12")
    assert all(r["value"] == pytest.approx(1.0) for r in EM.bertscore_texts(same).collect())


def test_a_piece_gets_the_vector_of_a_word_once(spark):
    import numpy as np

    from colloquy.operators import embeddings as EM
    from colloquy.operators.metrics import greedy_scores
    from colloquy.session import materialize
    rnd = random.Random(5)
    text = lambda: " ".join(rnd.choices("abcdefghij", k=rnd.randint(0, 12)))
    rows = [(i, text(), text()) for i in range(300)] + [(None, "a b", "c d"), (None, "a", "a b"), (7, "a b a", "b"), (7, None, "c j"), (8, "a b", None)]
    df = spark.createDataFrame(rows, "pair_id long, pred string, ref string").repartition(2)
    vectors = EM.token_vectors(df, ["pred", "ref"])
    vec = {r["token"]: np.array(r["vec"]) for r in vectors.collect()}
    sides = defaultdict(lambda: (Counter(), Counter()))
    for key, *both in rows:
        for count, t in zip(sides[key], both):
            count.update((t or "").split())
    got = [greedy_scores([vec[w] for w in a if w in vec], [vec[w] for w in b if w in vec], [n for w, n in a.items() if w in vec],
                         [n for w, n in b.items() if w in vec]) if key is not None else (0.0, 0.0, 0.0) for key, (a, b) in sides.items()]
    of = dict(zip(sides, got))
    want = np.mean([of[key] for key, *_ in rows], axis=0).tolist()      # rows of one key are one pair, rows without a key score 0
    for held in (20, 1 << 22):
        out = {r["name"]: r["value"] for r in EM.bertscore_texts(df, held_tokens=held).collect()}
        assert [out[n] for n in ("precision", "recall", "f1")] == pytest.approx(want, abs=1e-9)
    cut = materialize(EM.cut_pairs(df), "t-pieces")
    carried, whole = EM.piece_vectors(cut, vectors), cut.where("words is not null").count()
    assert carried.count() == carried.select("of", "i").distinct().count() <= whole * len(vec)
    assert carried.count() < sum(len(a) + len(b) for a, b in sides.values()) / 5
    near = EM.cooccurrences(df.select(F.split("pred", " ").alias("t")), ["t"], held_tokens=10)
    assert near.count() == near.where("a <= b").select("a", "b").distinct().count()


def test_vectors_and_scores_in_passes_equal_one_pass(spark, monkeypatch):
    from colloquy.operators import embeddings as EM
    rnd = random.Random(7)
    text = lambda: " ".join(rnd.choices("abcdefghij", k=rnd.randint(0, 12)))
    df = spark.createDataFrame([(i, text(), text()) for i in range(100)], "pair_id long, pred string, ref string").repartition(2)
    found = []
    for passes in ({"counts": 1, "vectors": 1, "scores": 1}, {"counts": 2, "vectors": 3, "scores": 2}):
        monkeypatch.setattr(EM, "PASSES", passes)
        vec = {r["token"]: r["vec"] for r in EM.token_vectors(df, ["pred", "ref"]).collect()}
        found.append((vec, {r["name"]: r["value"] for r in EM.bertscore_texts(df, held_tokens=200).collect()}))
    (v, s), (w, t) = found
    assert set(v) == set(w) and all(v[x] == pytest.approx(w[x], abs=1e-9) for x in v) and s == pytest.approx(t, abs=1e-9)
    near = [EM.cooccurrences(df.select(F.split("pred", " ").alias("t")), ["t"], share=(k, 2)) for k in (0, 1)]
    whole = EM.cooccurrences(df.select(F.split("pred", " ").alias("t")), ["t"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, near[0].union(near[1]).collect()))


def test_csv_keeps_empty_strings_and_refuses_bad_lines(spark, tmp_path):
    from colloquy.sources.io import DIALOGUE_SCHEMA, read_dialogues, write_detailed, write_dialogues_csv
    rows = [("en", "", "a\nb", 'say "x", y', None, "NA", "\\N"), ("en", None, "", " pad ", "null", "\\", "\\\""), (None,) * 7]
    df = spark.createDataFrame(rows, DIALOGUE_SCHEMA)
    write_dialogues_csv(df.coalesce(1), str(tmp_path / "csv"))
    got = read_dialogues(spark, str(tmp_path / "csv"), "csv")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv").write_text('lang,title,source_body,target_body,link_id,source_id,target_id\n"en","only two"\n')
    with pytest.raises(Exception):
        read_dialogues(spark, str(tmp_path / "bad"), "csv").collect()
    write_detailed(spark.createDataFrame([("en", None, None), ("en", "x", None), (None, None, None)], "lang string, id string, body string"), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 1
