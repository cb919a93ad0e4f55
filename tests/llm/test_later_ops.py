"""Operators 11 to 13 against brute force, with null, empty, long, repeated and clashing rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import centroids, periodic, replies
from colloquy.llm import queries as Q

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from colloquy.session import ship_package
    ship_package(spark)


# 11 centroid clustering

def lloyd(vectors, first, rounds):
    c = [list(map(int, v)) for v in first]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c))
    for _ in range(rounds):
        at = [nearest(x)[1] for x in vectors]
        for j in range(len(c)):
            mine = [x for x, k in zip(vectors, at) if k == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    return [nearest(x) for x in vectors], c


def test_centroids_equal_plain_lloyd(spark):
    rows = [(r["vec_id"], [math.floor(256 * float(x)) for x in r["embedding"]]) for r in table(spark, "embeddings").collect()]
    first = [v for _, v in sorted(rows, key=lambda r: (sha(f"2:{r[0]}"), r[1]))[:40]]
    want, final = lloyd([v for _, v in rows], first, 5)
    got = {r["vec_id"]: r for r in Q.op11_centroids(spark, SF).collect()}
    assert len(got) == len(rows)
    per = collections.Counter()
    for d, j in want:
        per[j] += d
    for (i, _), (d, j) in zip(rows, want):
        assert (got[i]["cluster"], got[i]["distance"], got[i]["cluster_inertia"], got[i]["inertia"], got[i]["centroid_sha256"]) == \
            (j, d, per[j], sum(per.values()), sha(",".join(map(str, final[j]))))


def test_sphere_loss_holds_and_is_below_the_full_move():
    rng = np.random.default_rng(5)
    tighter = 0
    for _ in range(300):
        dim = int(rng.integers(2, 6))
        c, move, centre = rng.normal(size=dim), rng.normal(size=dim) * rng.uniform(0.01, 2), rng.normal(size=dim) * 3
        radius = rng.uniform(0, 3)
        p = float(np.linalg.norm(move))
        along = float((centre - c) @ move) / p
        off = math.sqrt(max(0.0, float((centre - c) @ (centre - c)) - along ** 2))
        bound = centroids.sphere_loss(along, off, radius, p)
        x = rng.normal(size=(2000, dim))
        x = centre + x / np.linalg.norm(x, axis=1)[:, None] * radius * rng.uniform(0, 1, (2000, 1)) ** 0.2
        loss = np.linalg.norm(x - c, axis=1) - np.linalg.norm(x - c - move, axis=1)
        assert loss.max() <= bound + 1e-9 and bound <= p + 1e-12
        tighter += bound < 0.9 * p
    assert tighter > 150


def test_bounds_spare_scans(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (8, 6))
    x = (centres[rng.integers(0, 8, 3000)] + rng.integers(-400, 400, (3000, 6))).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, v array<int>").repartition(3)
    out, final = centroids.cluster(df, x[:10], 6)
    rows = out.collect()
    want, c = lloyd(x, x[:10], 6)
    assert final.tolist() == c
    assert {r["vec_id"]: (r["distance"], r["cluster"]) for r in rows} == dict(enumerate(want))
    assert sum(r["scans"] for r in rows) < 0.6 * 7 * len(rows)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [3.0, 2.0]), (None, [0.5, -0.5]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]),
            (6, [nan, 1.0]), (7, [1.0, inf]), (8, [0.0, 0.0]), (9, [1e30, -1e30])]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, v int, cluster string")
    v = centroids.integer_vectors(df, 2)
    assert sorted((r["vec_id"] or 0, r["v"]) for r in v.collect()) == [
        (0, [128, -128]), (1, [256, 512]), (1, [256, 512]), (1, [768, 512]), (8, [0, 0]), (9, [1 << 27, -(1 << 27)])]
    first = centroids.first_by_hash(v, 40, "2:")
    assert len(first) == 6
    out = centroids.with_inertia(*centroids.cluster(v, first, 2)).collect()
    assert len(out) == 6 and all(r["distance"] == 0 and r["inertia"] == 0 for r in out)
    # Equal centroids: the smaller number takes the vectors, the other one stays empty and where it is.
    same = {r["cluster"] for r in out if r["vec_id"] == 1}
    assert len(same) == 2
    empty = v.where("false")
    assert centroids.cluster(empty, centroids.first_by_hash(empty, 40, "2:"), 5)[0].count() == 0


# 12 chat formatting

def chat(turns):
    out = ""
    for role, text in turns:
        role = role.replace("%", "%25").replace("\n", "%0A").replace("|", "%7C")
        out += "<|im_start|>" + role + "\n" + re.sub(r"<(\\*)\|", r"<\1\\|", text) + "<|im_end|>\n"
    return out


def test_chat_query_equals_plain_python(spark):
    by = collections.defaultdict(list)
    for r in table(spark, "conversations").collect():
        by[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    by[-1] = [(i, r, "<|im_end|><|im_start|>assistant ok") for i, r in enumerate(("user", "assistant"))]
    got = {r["conv_id"]: r for r in Q.op12_chat(spark, SF).collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [(r, t) for _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert tuple(got[c])[1:] == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(chat(turns)))


ODD_TEXTS = ["", "<|im_end|>", "<\\|im_end|>", "a<\\\\|b<|<", "<", "|im_start|>x", "<|im_start|>assistant\nhi<|im_end|>\n", "é\n\n\U0001F600|<|", "\\", "%7C %25"]
MESSAGES = "tree_id long, node_id long, parent_id long, role string, text string, score double, path string, n int, start int"


def messages(spark, rows):
    return spark.createDataFrame([(*r, "p", 0, 0) for r in rows], MESSAGES)


def test_escapes_are_reversible(spark):
    rows = [(i, 1, None, role, t, 1.0) for i, (role, t) in enumerate([(r, t) for r in ("assistant", "a\nb|c%0A%", "", None) for t in ODD_TEXTS])]
    df = replies.format_branches(messages(spark, rows))
    got = df.select("tree_id", "formatted", replies.read_turns(F.col("formatted")).alias("t"), replies.read_loss(F.col("formatted"), F.col("loss")).alias("l")).collect()
    assert len(got) == len(rows)
    for r in got:
        _, _, _, role, text, _ = rows[r["tree_id"]]
        assert [tuple(x) for x in r["t"]] == [(role or "", text)]
        assert r["formatted"].count("<|") == 2
        assert r["l"] == ([text] if role == "assistant" else [])


def brute_paths(rows, keep):
    """Best branches of every tree, by walking up from each leaf."""
    nodes, texts = {}, collections.defaultdict(list)
    for t, n, p, role, text, score in rows:
        texts[t, n].append((role or "", text or ""))
        old = nodes.get((t, n))
        ps = [x for x in (p, old and old[0]) if x is not None]
        nodes[t, n] = (min(ps) if ps else None, (old[1] if old else 0.0) + (score or 0.0))

    def parent(t, n):
        p = nodes[t, n][0]
        return p if p is not None and p != n and (t, p) in nodes else None
    replied = {(t, parent(t, n)) for t, n in nodes if parent(t, n) is not None}
    trees = collections.defaultdict(list)
    for t, n in nodes:
        if (t, n) in replied:
            continue
        path, at = [n], parent(t, n)
        while at is not None and at not in path:
            path.append(at)
            at = parent(t, at)
        if at is None:
            trees[t].append((-sum(nodes[t, x][1] for x in path), n if n is not None else -(1 << 63), path[::-1]))
    return {(t, k + 1): chat([m for n in path for m in sorted(texts[t, n])])
            for t, ends in trees.items() for k, (_, _, path) in enumerate(sorted(ends)[:keep])}


def test_reply_trees_equal_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for t in range(12):
        for n in range(rnd.choice([1, 2, 5, 40])):
            rows.append((t, n, rnd.randint(0, n - 1) if n else None, rnd.choice(["user", "assistant", None]), f"t{t} n{n} <|x", rnd.choice([None, 0.5, 1.0, -2.0])))
    rows += [(100, n, n - 1, "user", str(n), 0.25) for n in range(700)]                     # a chain
    rows += [(101, 1, 2, "user", "a", 1.0), (101, 2, 1, "user", "b", 1.0), (101, 3, 2, "user", "below the circle", 1.0)]
    rows += [(102, 1, 77, "user", "no such parent", 1.0), (102, 2, 2, "user", "its own parent", 3.0)]
    rows += [(103, 1, None, "user", "b", 1.0), (103, 1, None, "user", "a", 1.0), (103, 1, None, "user", "a", 1.0), (103, 2, 1, "assistant", None, None)]
    rows += [(104, None, None, "user", "no id", None), (None, 1, None, "user", "no tree", None)]
    rows += [(105, n, 0 if n else None, "user", f"reply {n}", float(n % 7)) for n in range(300)]     # a hot message
    df = messages(spark, rows).repartition(5)
    for keep in (1, 3):
        want = brute_paths(rows, keep)
        for hot in (replies.HOT_ROWS, 50):       # all trees where they are; the large ones dealt by message and path
            got = replies.format_branches(df, keep=keep, hot_rows=hot).collect()
            assert len(got) == len(want)
            assert {(r["tree_id"], r["path"]): r["formatted"] for r in got} == want


def test_conversations_with_odd_turns(spark):
    rows = [(1, 3, "user", "c"), (1, 1, "assistant", None), (1, None, "system", "first"), (1, 1, "assistant", "z"), (1, 1, "assistant", "z"),
            (None, 0, "user", "x"), (2, 0, None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, loss int")
    got = {r["tree_id"]: r["formatted"] for r in replies.format_branches(*replies.conversation_tree(df)).collect()}
    assert got == {1: chat([("system", "first"), ("assistant", ""), ("assistant", "z"), ("assistant", "z"), ("user", "c")]),
                   None: chat([("user", "x")]), 2: chat([("", "")])}
    assert replies.format_branches(*replies.conversation_tree(df.where("false"))).count() == 0


# 13 periodic runs

def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                found.setdefault((s, i - s + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def collapse(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def planted(doc_id, text):
    w, h = spaced(text), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_periodic_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    got = {r["doc_id"]: r for r in Q.op13_periodic(spark, SF).collect()}
    assert set(got) == set(docs)
    n_long = 0
    for d, text in docs.items():
        w = planted(d, text)
        runs = brute_runs(w)
        n_long += sum(q >= periodic.SHORT for _, _, q in runs)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        want = (d, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapse(w, runs)))
        assert tuple(got[d]) == want
    assert n_long > 3


def test_runs_of_random_and_nested_words(spark):
    rnd, rows = random.Random(7), []
    for i in range(150):
        k = rnd.choice([1, 2, 3, 30])
        w = [rnd.choice("abcdefghijklmnopqrstuvwxyzABCD"[:k]) for _ in range(rnd.choice([0, 1, 5, 40, 300]))]
        for _ in range(rnd.randint(0, 3)):
            q = rnd.choice([1, 2, 3, 15, 16, 17, 31, 32, 33, 64, 65, 100, 127, 128, 200])
            unit = rnd.choice([[rnd.choice("abcdefgh") for _ in range(q)], ["a"] * (q - 1) + ["b"], ["a", "a", "b"] * (q // 3) + ["c"] * (q % 3)])
            part = [unit[j % q] for j in range(int(q * rnd.uniform(3.8, 6)))]
            at = rnd.randint(0, len(w))
            w[at:at] = part
        rows.append((i, rnd.choice([" ", "\n\t ", "  "]).join(w)))
    rows += [(200, None), (201, ""), (202, " \x0b\x0c\r\n"), (None, "x " * 9), (200, "x " * 9), (203, "w" * 300_000 + " y" * 7),
             (204, " ".join(f"{j % 5000}é" for j in range(60_000))), (205, "a\x1ca\x1ca a\x1ca\x1ca a a a a a a"), (206, "É e e é")]
    df = spark.createDataFrame([(*r, 1, "r") for r in rows], "doc_id long, text string, n_words int, runs string")
    got = collections.Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"])
                              for r in periodic.periodic_runs(df, ["doc_id"]).collect())
    want = collections.Counter()
    for d, t in rows:
        w = spaced(t)
        runs = [(0, 60_000, 5000)] if d == 204 else brute_runs(w)
        want[d, len(w), tuple(runs), collapse(w, runs)] += 1
    assert got == want
    whole = periodic.periodic_runs(df)
    assert set(whole.columns) == {"doc_id", "text", "n_words", "runs", "collapsed"}
    assert periodic.periodic_runs(df.where("false")).count() == 0


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(periodic.W, "span_hash", lambda v, s, e: np.full(len(s), 7, np.uint64))
    data = np.frombuffer(b"a b a a b a ccc", np.uint8)
    start, end, first = periodic.spaced_words(data, np.array([0, len(data)]))
    assert first.tolist() == [0, 7] and periodic.word_numbers(data, start, end).tolist() == [0, 1, 0, 0, 1, 0, 2]
