"""Edge rows of the scalar operators."""

from pyspark.sql import functions as F

from colloquy.functions import text as TX
from colloquy.operators.corpus import clean_dialogues


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "s string").select(col.alias("r")).first()["r"]


def test_delete_emoji(spark):
    assert one(spark, TX.delete_emoji("s"), "smile 😀 (ok)") == "smile  ok"


def test_mask_order(spark):
    cases = {
        "hi u/foo_bar1 (u/abc) /u/x": "hi [USER]_bar1 [USER] /[USER]",
        "see https://www.reddit.com/r/foo/c ok": "see [SUB]/c ok",
        "and/or/not menu/abc": "and/o[SUB] men[USER]",
        "https://x.edu/abc?q=1. end": "[USER]?q=1. end",
        "[t](https://a.b/c) z": "[t] z",
        "http://x": "http://x",
        "a\nb": "a b",
    }
    for src, want in cases.items():
        assert one(spark, TX.mask_all("s"), src) == want, src


def test_newline_rule(spark):
    assert one(spark, TX.too_many_lines("s"), "a\nb\nc") is False
    assert one(spark, TX.too_many_lines("s"), "a\nb\nc\nd") is True
    assert one(spark, TX.too_many_lines("s"), "a\r\n\nb\nc") is True
    assert one(spark, TX.too_many_lines("s"), None) is True


def test_length_filter_bounds(spark):
    df = spark.createDataFrame([("x" * n,) for n in (4, 5, 1000, 1001)], "s string")
    kept = [len(r["s"]) for r in df.where(F.length(TX.delete_emoji("s")).between(5, 1000)).collect()]
    assert sorted(kept) == [5, 1000]


def test_token_count_bounds(spark):
    def body(n):
        return " ".join(["w"] * n)
    rows = [("de", "", body(n), body(10), "", "", str(n)) for n in (4, 5, 79, 80)]
    df = spark.createDataFrame(rows, "lang string, title string, source_body string, target_body string, "
                                     "link_id string, source_id string, target_id string")
    kept = sorted(int(r["target_id"]) for r in clean_dialogues(df).collect())
    assert kept == [5, 79]


def test_tokenize_13a(spark):
    got = one(spark, TX.tokenize_13a("s"), "  Hello, world. It's 3.5 &amp; 1-2 ")
    assert got == ["Hello", ",", "world", ".", "It's", "3.5", "&", "1", "-", "2"]


def test_char_ngrams(spark):
    assert one(spark, TX.char_ngrams("s", 3), "ab😀cd") == ["ab😀", "b😀c", "😀cd"]
    assert one(spark, TX.char_ngrams("s", 3), "ab") == []
