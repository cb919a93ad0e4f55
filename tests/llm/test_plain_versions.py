"""Operators 2, 3, 5, 7, 8 and 9 against plain versions, and their independence of how rows lie in partitions."""

import collections
import hashlib
import heapq
import json
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from colloquy.llm import decontaminate, quality, secrets, sharding, toxicity, wrappers
from colloquy.llm import queries as Q

SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from colloquy.session import ship_package
    ship_package(spark)


def words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


# 2 secrets

def plain_base(t):
    kinds = [("assign", re.compile("(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 12),
             ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]
    out = []
    for k, (kind, pattern, group, least) in enumerate(kinds):
        for m in pattern.finditer(t):
            if len(m[group]) >= least:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def test_base_spans_of_the_whole_table_equal_the_contract(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, "documents").collect()}
    got = {r["doc_id"]: r for r in Q.op2_secrets(spark, SF).collect()}
    assert set(got) == set(docs)
    found = 0
    for d, t in docs.items():
        base = plain_base(t)
        found += len(base)
        r = got[d]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        assert r["base_sha256"] == hashlib.sha256(",".join(s for _, _, s in base).encode()).hexdigest()
        assert set(r["spans"].split(",")) >= {s for _, _, s in base}
    assert found > 5


def test_pair_counts_do_not_depend_on_partitions(spark):
    docs = table(spark, "documents").select("text").unionByName(spark.createDataFrame([(t,) for t in (None, "", "a", "ab", "", "ba")], "text string"))
    want = np.zeros((128, 128), np.int64)
    for r in docs.collect():
        b = [min(x, 127) for x in (r["text"] or "").encode()]
        for x, y in zip(b, b[1:]):
            want[x, y] += 1
    for n in (1, 3, 7):
        assert (secrets.pair_counts(docs.repartition(n)) == want).all()
    for n in (1, 4):
        a = sorted(map(str, secrets.find_secrets(table(spark, "documents").repartition(n)).collect()))
        assert a == sorted(map(str, secrets.find_secrets(table(spark, "documents").repartition(5)).collect()))


def test_battery_is_honest_on_uniform_symbols_and_hard_on_patterns():
    rng = np.random.default_rng(2)
    for size, n in ((16, 32), (64, 40), (36, 24)):
        p = np.array([secrets.battery(rng.integers(0, size, n), size) for _ in range(4000)])
        for level in (0.001, 0.01):
            assert (p < level).mean() <= 4 * level        # the tests are approximate, their sum is corrected
        assert secrets.battery(np.arange(n) % size, size) < 0.001
        assert secrets.battery(np.zeros(n, np.int64), size) < 0.001


def test_secrets_take_clashing_columns(spark):
    df = table(spark, "documents").limit(20).selectExpr("doc_id", "text", "1 base", "'c' cands", "2 spans", "3 n_hex")
    plain = table(spark, "documents").limit(20).select("doc_id", "text")
    assert sorted(map(str, secrets.digest(secrets.find_secrets(df)).collect())) == sorted(map(str, secrets.digest(secrets.find_secrets(plain)).collect()))


# 3 extraction

def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}</body></html>"


def extracted(spark, pages, parts=None):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    df = df.repartition(parts) if parts else df
    return [r["text"] for r in wrappers.extract(df).orderBy("page_id").collect()]


ALPHA = page("<article><h1>Alpha</h1><p>para alpha one</p><blockquote>Quoted words of alpha.</blockquote><pre>code of alpha</pre>"
             "<div class=note>end alpha</div></article>")


@pytest.mark.parametrize("times", [1, 3, 10])
def test_a_repeated_page_keeps_its_text(spark, times):
    others = [(f"http://h/{i}", page(f"<article><h1>T{i}</h1><p>one {i}</p><p>two {i}</p></article>")) for i in range(8)]
    got = extracted(spark, [("http://h/alpha", ALPHA)] * times + others)
    assert got[:times] == ["Alpha\n\npara alpha one\n\nQuoted words of alpha.\n\ncode of alpha\n\nend alpha"] * times
    assert got[times:] == [f"T{i}\n\none {i}\n\ntwo {i}" for i in range(8)]


def test_a_mirrored_page_keeps_its_text(spark):
    # Print versions of one article: the rest of the page differs, the article does not.
    mirrors = [(f"http://h/alpha?{i}", ALPHA.replace("<body>", f"<body><nav>menu {i}</nav>")) for i in range(4)]
    others = [(f"http://h/{i}", page(f"<article><h1>T{i}</h1><p>one {i}</p></article>")) for i in range(6)]
    assert extracted(spark, mirrors + others)[:4] == ["Alpha\n\npara alpha one\n\nQuoted words of alpha.\n\ncode of alpha\n\nend alpha"] * 4


def test_marks_that_only_contain_listed_words_leave_nothing_out(spark):
    inner = ("<h2 class='section-header'>Head {0}</h2><table class='side-by-side'><tr><td>cell {0}</td></tr></table><p class='related-work'>work {0}</p>"
             "<div class='search-algorithms'>search {0}</div><p class='social-history'>history {0}</p><div class='menu-recipe'>recipe {0}</div>"
             "<math><mi>x{0}</mi></math><ul class='menu'><li>no {0}</li></ul><div class='ad-box'>no {0}</div><div class='post-footer'>no {0}</div>"
             "<p class=ad>a paragraph {0}</p>")
    want = "Head {0}\n\ncell {0}\n\nwork {0}\n\nsearch {0}\n\nhistory {0}\n\nrecipe {0}\n\nx{0}\n\na paragraph {0}"
    pages = [(f"http://h/{i}", page(f"<article>{inner.format(i)}</article>")) for i in range(5)]
    # A host of many pages, where these marks are on a few: the bounded keys tell the same.
    pages += [(f"http://big/{i}", page(f"<article>{inner.format(i)}</article>" if i < 2 else f"<article><p>text {i}</p></article>")) for i in range(60)]
    got = extracted(spark, pages)
    assert got[:5] == [want.format(i) for i in range(5)] and got[5:7] == [want.format(i) for i in range(2)]
    assert got[7:] == [f"text {i}" for i in range(2, 60)]


def test_wrappers_do_not_depend_on_partitions(spark):
    bodies = ["<article><h1>a {0}</h1><p>b</p></article>", "<main><ul><li>x {0}<li>y</ul><p>c</p></main><div class=z>k</div>", "<div class=z>k</div><article><p>d {0}</p><h2>e</h2></article>",
              "<article><table><tr><td>f {0}</table></article><footer>g</footer>", "<div class=w><p>q {0}</p></div><article><h2>e</h2><p>d</p><p>d2</p></article>"]
    pages = [(f"http://h{i % 2}/{i}", page(bodies[i * 7 % 5].format(i))) for i in range(60)]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    seen = {tuple(sorted(map(tuple, wrappers.infer_wrappers(df.repartition(n, F.xxhash64("page_id") + n), merge_shapes=ways).collect())))
            for n in (1, 3, 8) for ways in (2,)}
    assert len(seen) == 1
    assert len({tuple(extracted(spark, pages, n)) for n in (1, 4, 9)}) == 1
    one = json.loads(next(iter(seen))[0][2])
    assert one[4] == 30


# 5 sharding

def test_shards_equal_a_plain_placement(spark):
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in table(spark, "documents").collect()]

    def slot(i):
        h = xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), seed=42)
        return (h - (1 << 64) if h >> 63 else h) % sharding.SLOTS
    size = collections.Counter()
    for i, t in docs:
        size[slot(i)] += len(t) + 1
    most = sum(size.values()) // (Q.SHARDS * sharding.SPLITS)
    split = {s for s, n in size.items() if n > most and sum(slot(i) == s for i, _ in docs) > 1}
    got = {r["doc_id"]: r for r in Q.op5_shard(spark, SF).collect()}
    load = collections.Counter()
    for i, t in docs:
        r = got[i]
        assert (r["size"], r["text_crc32"], r["vslot"], r["law"], r["grown_shard"]) == (len(t) + 1, zlib.crc32(t), slot(i), "bytes", None)
        load[r["shard"]] += r["size"]
    # Where no slot had to be split, the placement is that of a plain loop, largest slot first.
    if not split:
        heap = [(0, s) for s in range(Q.SHARDS)]
        where = {}
        for n, s in sorted(((n, s) for s, n in size.items()), key=lambda x: (-x[0], x[1])):
            at, shard = heapq.heappop(heap)
            where[s] = shard
            heapq.heappush(heap, (at + n, shard))
        assert all(got[i]["shard"] == where[slot(i)] for i, _ in docs)
    units = max(max(size.values()), max(len(t) + 1 for _, t in docs))
    assert max(load.values()) - min(load.values()) <= units
    for s in range(Q.SHARDS):
        places = sorted(r["slot"] for r in got.values() if r["shard"] == s)
        assert places == list(range(len(places)))


# 7 toxicity

def test_ftrl_equals_a_plain_loop(spark):
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(vocabulary, 12)), int(rng.random() < 0.5)) for i in range(60)]
    rows = [(i, t + (" bad words" if y else ""), y) for i, t, y in rows]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int")
    bits, s = 12, toxicity.Settings(l1=0.5, epochs=2)
    data = toxicity.training_rows(docs, labels, bits).collect()
    model = toxicity.train(docs, labels, s, bits)
    z, n, z0, n0 = collections.defaultdict(float), collections.defaultdict(float), 0.0, 0.0

    def weight(f):
        return 0.0 if abs(z[f]) <= s.l1 else -(z[f] - math.copysign(s.l1, z[f])) / ((s.beta + math.sqrt(n[f])) / s.alpha + s.l2)
    for _ in range(s.epochs):
        for r in sorted(data, key=lambda r: (r["order"], r["label"])):
            w = {f: weight(f) for f in r["x"]}
            b = -z0 / ((s.beta + math.sqrt(n0)) / s.alpha + s.l2)
            g = 1 / (1 + math.exp(-(sum(w.values()) + b))) - r["label"]
            for f in r["x"]:
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / s.alpha * w[f]
                n[f] += g * g
            z0 += g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / s.alpha * b
            n0 += g * g
    want = {f: weight(f) for f in list(z) if weight(f)}
    assert dict(zip(model.feature.tolist(), model.weight.tolist())) == pytest.approx(want, abs=1e-9)
    assert model.bias == pytest.approx(-z0 / ((s.beta + math.sqrt(n0)) / s.alpha + s.l2), abs=1e-9)
    p = toxicity.score_texts(pa.array([t for _, t, _ in rows]), model)
    assert np.mean((p >= 0.5) == np.array([y for _, _, y in rows])) > 0.95


def test_features_are_the_distinct_words_pairs_and_skips():
    texts = ["a b c d a b", "", None, "one", "A, b! C"]
    got = collections.defaultdict(set)
    for i, _, row, f in toxicity.features(pa.array(texts), 40):
        for r, x in zip(row.tolist(), f.tolist()):
            got[i + r].add(x)

    def grams(t):
        w = words(t)
        return {(0, x) for x in w} | {(1, *p) for p in zip(w, w[1:])} | {(2, *p) for p in zip(w, w[2:])}
    assert [len(got[i]) for i in range(5)] == [len(grams(t)) for t in texts]
    assert len(got[0] & got[4]) == len(grams(texts[0]) & grams(texts[4]))


# 9 quality

def test_statistics_equal_plain_python(spark):
    texts = [r["text"] for r in table(spark, "documents").limit(60).collect()] + ["", None, "a", "\n\n", "!!! ... ??", "x\nx\ny\n", "É é-e; 12 12", "a b " * 40]

    def kind(b):
        c = chr(b)
        if b >= 0x80 or b < 0x20 and c not in "\t\n" or b == 0x7F:
            return "other"
        if c == "\n":
            return "newline"
        return ("lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9" else "space" if c in " \t"
                else "stop_mark" if c in ".,;:?" else "symbol")

    def plain(t):
        raw = (t or "").encode()
        if not raw:
            return [0.0] * len(quality.STATISTICS)
        kinds = collections.Counter(map(kind, raw))
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
        spans = [m.span() for m in re.finditer(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]
        w = [low[s:e] for s, e in spans]
        n = max(len(w), 1)
        mean = sum(map(len, w)) / n
        sd = math.sqrt(max(sum(len(x) ** 2 for x in w) / n - mean * mean, 0))
        repeat = []
        for k in (2, 5):
            g = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
            repeat.append((len(g) - len(set(g))) / max(len(g), 1))
        lines = raw.split(b"\n")
        lines = [x + b"\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
        symbol = [kind(b) == "symbol" for b in raw]
        doubled = sum(a and b for a, b in zip(symbol, symbol[1:]))
        touched = sum(e < len(raw) and symbol[e] for _, e in spans)
        stops, nl = kinds["stop_mark"], max(len(lines), 1)
        return [math.log1p(len(raw)), *(kinds[k] / len(raw) for k in ("lower", "upper", "digit", "stop_mark", "symbol", "other")), math.log1p(len(w)), mean, sd,
                len(set(w)) / n, max(collections.Counter(w).values(), default=0) / n, *repeat, sum(len(x) <= 2 for x in w) / n, sum(len(x) >= 14 for x in w) / n,
                math.log1p(len(lines)), (len(lines) - len(set(lines))) / nl, len(w) / nl, doubled / len(raw), touched / n, len(w) / max(stops, 1),
                math.log1p(len(w) - len(set(w))), math.log1p(kinds["symbol"])]
    got = quality.statistics(pa.array(texts))
    for t, row in zip(texts, got):
        assert dict(zip(quality.STATISTICS, row)) == pytest.approx(dict(zip(quality.STATISTICS, plain(t))), abs=1e-9), t


# 8 decontamination

def test_pattern_tables_stay_within_their_share():
    rng = np.random.default_rng(4)
    for letters in (1, 3, 8):
        text = " ".join("".join(rng.choice(list("abcdefghij"), letters)) for _ in range(20_000))
        groups = decontaminate.build_patterns([(1, text), (2, "a b"), (None, text[:300]), (2, "a b")])
        assert decontaminate.table_bytes(groups) <= decontaminate.TABLE_SHARE * (len(text) + 400)


def test_windows_of_one_hash_are_told_apart(spark, monkeypatch):
    items = [(1, "a b c"), (2, "a b d"), (3, "x y d"), (4, None)]
    monkeypatch.setattr(decontaminate, "_window_hash", lambda h, at, m: np.zeros(len(at), np.uint64))
    (p,) = decontaminate.build_patterns(items)
    run = decontaminate._scan([p], False)
    out = run(pa.RecordBatch.from_arrays([pa.array(["q a b d q", "x y d a b c", "a b", None, "A-B-C"])], ["text"]))
    assert out[2].to_pylist() == [[2], [1, 3], [], [], [1]]


def test_many_pattern_blocks_give_the_same(spark):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    one = decontaminate.judge(decontaminate.find_items(docs, bench, keep=["doc_id"]))
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0]
    many = decontaminate.judge(decontaminate.find_items(docs, bench, keep=["doc_id"], block_bytes=size // 7 + 1))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.select(*one.columns).collect()))
