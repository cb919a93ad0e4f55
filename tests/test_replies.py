"""The responder over a table of followers, against plain versions of its training and its three strategies."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as V
from colloquy.operators import infer as I
from colloquy.operators import replytable as T
from colloquy.session import ship_package

WORDS = ["a", "b", "c", "d", "é", "中", "z."]


def some_pairs(n, seed=3):
    rnd = random.Random(seed)
    text = lambda: rnd.choice([None, "", " "]) if rnd.random() < 0.05 else "  ".join(rnd.choices(WORDS, range(9, 2, -1), k=rnd.randint(1, 7)))
    return [(i, text(), text()) for i in range(n)] + [(n, "a " + "x" * 65 + " b", "c"), (n + 1, "a b", "a b")] * 2


def plain_counts(pairs):
    c = Counter()
    for _, s, t in pairs:
        w = (s or "").split() + (t or "").split() + [""]
        c.update((x, y) for x, y in zip(w, w[1:]) if len(x) <= T.WORD_CHARS and len(y) <= T.WORD_CHARS)
    return c


def plain_table(pairs, contexts, choices):
    """context -> [(word, log probability)], most frequent first."""
    counts, total, rest = plain_counts(pairs), Counter(), Counter()
    for (x, y), c in counts.items():
        total[x] += c
        if y:
            rest[y] += c
    kept = sorted(total, key=lambda x: (-total[x], x))[:contexts]
    rows = {x: {y: c for (a, y), c in counts.items() if a == x} for x in kept}
    rows[""], total[""] = rest, sum(rest.values())
    return {x: [(y, math.log(c) - math.log(total[x])) for y, c in sorted(r.items(), key=lambda i: (-i[1], i[0]))[:choices]]
            for x, r in rows.items()}


def plain_start(table, text):
    w = (text or "").split()[:V.MAX_INPUT_LENGTH]
    return w[-1] if w and w[-1] in table else ""


def plain_greedy(table, text, limit):
    word, said = plain_start(table, text), []
    while len(said) < limit:
        nxt = table[word if word in table else ""]
        if not nxt or nxt[0][0] == "":
            break
        word = nxt[0][0]
        said.append(word)
    return " ".join(said)


def plain_beam(table, text, limit, beams=5, n=2):
    live, done = [(0.0, [])], []
    for step in range(limit):
        cand = []
        for k, (score, said) in enumerate(live):
            last = said[-1] if said else plain_start(table, text)
            grams = {tuple(said[i:i + n]) for i in range(len(said) - n + 1)}
            for r, (w, lp) in enumerate(table[last if last in table else ""]):
                if w and n and tuple(said + [w])[-n:] in grams:
                    continue
                cand.append((-(score + lp), k, r, w))
        cand.sort()
        grown = []
        for place, (cost, k, _, w) in enumerate(cand[:2 * beams]):
            if len(grown) == beams:
                break
            if w == "":
                if place < beams:
                    done.append((-cost / (step + 1), live[k][1]))
            else:
                grown.append((-cost, live[k][1] + [w]))
        if not grown and not done:
            done.append((live[0][0] / max(step, 1), live[0][1]))
        if not grown or len(done) >= beams:
            break
        live = grown
    else:
        done += [(s / limit, said) for s, said in live]
    return " ".join(sorted(done, key=lambda x: -x[0])[0][1])


def nucleus(followers, temperature, top_k, top_p):
    logs = [lp / temperature for _, lp in followers[:top_k or None]]
    p = [math.exp(x - max(logs)) for x in logs]
    p = [x / sum(p) for x in p]
    kept, mass = {}, 0.0
    for (w, _), x in zip(followers, p):
        if top_p and mass >= top_p:
            break
        kept[w], mass = x, mass + x
    return {w: x / mass for w, x in kept.items()}


@pytest.fixture(scope="module")
def learned(spark):
    ship_package(spark)
    pairs = some_pairs(300)
    df = spark.createDataFrame(pairs, "id long, source_body string, target_body string")
    return pairs, df


@pytest.mark.parametrize("contexts, choices", [(5000, 100), (4, 3), (1, 1)])
def test_table_equals_plain_counts(spark, learned, contexts, choices):
    pairs, df = learned
    got = defaultdict(list)
    for r in sorted(T.reply_table(df.repartition(3).withColumn("word", F.lit("x")).withColumn("k", F.lit(1)), contexts=contexts, choices=choices).collect(), key=lambda r: r["rank"]):
        got[r["context"]].append((r["word"], math.log(r["c"]) - math.log(r["total"])))
    want = plain_table(pairs, contexts, choices)
    assert {k: [w for w, _ in v] for k, v in got.items()} == {k: [w for w, _ in v] for k, v in want.items()}
    for k in want:
        assert np.allclose([p for _, p in got[k]], [p for _, p in want[k]])


@pytest.mark.parametrize("contexts, choices", [(5000, 100), (4, 3)])
def test_greedy_and_beam_equal_plain_search(spark, learned, contexts, choices):
    pairs, df = learned
    table, plain = T.train_replies(df, contexts=contexts, choices=choices), plain_table(pairs, contexts, choices)
    texts = [s for _, s, _ in pairs] + ["unknown", "b unknown", None, "", "a " * 49 + "b c"]
    for limit in (1, 2, 6, 50):
        model = table.factory(max_target=limit)()
        assert [r[0] for r in model(texts, "greedy")] == [plain_greedy(plain, t, limit) for t in texts]
        for beams, n in ((5, 2), (2, 1), (3, 3), (1, 0)):
            got = model(texts, "beam_search", num_beams=beams, no_repeat_ngram_size=n, num_return_sequences=1)
            assert [r[0] for r in got] == [plain_beam(plain, t, limit, beams, n) for t in texts]
    said = [r[0].split() for r in table.factory()()(texts, "beam_search", **V.STRATEGIES["beam_search"])]
    assert all(len(set(zip(w, w[1:]))) == max(len(w) - 1, 0) for w in said)


def test_beam_finds_the_best_of_all_answers():
    """With as many beams as answers the search is exhaustive: the best mean log probability of all."""
    plain = plain_table([(0, "s", "a b"), (1, "s", "a c"), (2, "s", "d"), (3, "s", "d e f"), (4, "s", "a c f")], 50, 50)
    import pandas as pd
    frame = pd.DataFrame([(c, i + 1, w, math.exp(p) * 1000, 1000.0) for c, f in plain.items() for i, (w, p) in enumerate(f)],
                         columns=["context", "rank", "word", "c", "total"])
    answers = []

    def walk(word, said, score):
        for w, p in plain[word]:
            if w == "":
                answers.append(((score + p) / (len(said) + 1), said))
            else:
                walk(w, said + [w], score + p)
    walk("s", [], 0.0)
    got = T.load_table(frame).factory()()(["s"], "beam_search", num_beams=20, num_return_sequences=3)[0]
    best = sorted(answers, key=lambda a: -a[0])
    assert got[0] == " ".join(best[0][1]) and len(got) == 3


def test_samples_stay_in_the_nucleus_with_its_frequencies(learned):
    pairs, df = learned
    table, plain = T.train_replies(df), plain_table(pairs, 5000, 100)
    texts = [f"{i} a" for i in range(20000)]
    for temperature, top_k, top_p in ((0.8, 100, 0.7), (1.0, 0, 0), (0.5, 3, 0), (2.0, 0, 0.5)):
        got = table.factory(max_target=6)()(texts, "sample", temperature=temperature, top_k=top_k, top_p=top_p, num_return_sequences=1)
        firsts = Counter((r[0].split() or [""])[0] for r in got)
        want = nucleus(plain["a"], temperature, top_k, top_p)
        assert set(firsts) == set(want)
        for w, p in want.items():
            assert abs(firsts[w] / len(texts) - p) < 5 * math.sqrt(p * (1 - p) / len(texts)) + 1e-9
        for words in (r[0].split() for r in got[:500]):
            assert all(y in nucleus(plain[x], temperature, top_k, top_p) for x, y in zip(["a"] + words, words))
    two = table.factory()()(texts[:50], "sample", num_return_sequences=2)
    assert all(len(r) == 2 for r in two) and any(a != b for a, b in two)
    other = table.factory(seed=1)()(texts[:50], "sample", num_return_sequences=2)
    assert other != two


def test_answers_do_not_depend_on_partitions(spark, learned):
    _, df = learned
    model = T.train_replies(df).factory()
    for strategy in ("greedy", "beam_search", "sample"):
        one, many = (sorted(map(tuple, I.respond(df.repartition(n, F.rand(n)), model, strategy=strategy).select("id", "source_body", "pred").collect()), key=str)
                     for n in (1, 7))
        assert one == many and len(one) == df.count() and all(r[2] is not None for r in one)


def test_a_worker_decodes_a_row_once(learned, monkeypatch):
    table = T.train_replies(learned[1])
    for strategy in ("greedy", "beam_search"):
        decoded, inner = [], getattr(T, strategy)
        monkeypatch.setattr(T, strategy, lambda t, start, *a, f=inner, d=decoded, **k: d.extend(start.tolist()) or f(t, start, *a, **k))
        run = table.factory()()
        texts = ["a", "b", "a", None, "no such word", "c a"] * 20
        options = V.STRATEGIES[strategy]
        got = [x for i in range(0, len(texts), 7) for x in run(texts[i:i + 7], strategy, **options)]
        assert len(decoded) == len(set(decoded)) <= len(table.follower)
        each = [table.factory()()([t], strategy, **options)[0] for t in texts[:6]]
        assert got == each * 20
        one = {"num_beams": 1} if strategy == "beam_search" else {}
        assert [run([t], strategy, **{**options, **one}) for t in texts[:6]] == [table.factory()()([t], strategy, **{**options, **one}) for t in texts[:6]]


def test_empty_tables_answer_with_nothing(spark):
    schema = "source_body string, target_body string"
    for rows in ([], [(None, None)], [("", " ")], [("a", None)]):
        model = T.train_replies(spark.createDataFrame(rows, schema)).factory()()
        for strategy, options in V.STRATEGIES.items():
            assert model(["a b", None], strategy, **options) == [[""], [""]]
            assert model([], strategy, **options) == []
