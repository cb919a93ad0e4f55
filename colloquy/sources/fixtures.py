"""Inputs derived from the given tables.

The corpus tool reads a dump of threaded comments, the submissions they
belong to, model predictions and token vectors. None of these are given, so
they are derived from ``conversations``, ``pages``, ``documents`` and
``embeddings``; every row of the source tables is used and the work grows
with them. Each function has an SQL twin in ``colloquy.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw comments: one per conversation turn; a turn replies to the one before.

    Bodies get user names, forum names, links and emoji in a fixed rotation
    so the masking and emoji operators have work to do.
    """
    c = table(spark, sf_dir, "conversations").alias("c")
    p = table(spark, sf_dir, "pages").select("page_id", "url").alias("p")
    conv, turn, text = F.col("c.conv_id"), F.col("c.turn"), F.col("c.text")
    rot = (conv * 7 + turn) % 6
    body = (F.when(rot == 0, F.concat(text, F.lit(" u/user"), conv.cast("string")))
            .when(rot == 1, F.concat(F.lit("(r/topic) "), text))
            .when(rot == 2, F.concat(text, F.lit(" "), F.coalesce(F.col("p.url"), F.lit("https://example.com/a"))))
            .when(rot == 3, F.concat(text, F.lit(" 😀")))
            .otherwise(text))
    return (c.join(p, F.col("p.page_id") == conv, "left")
            .select(
                F.concat(F.lit("c"), conv.cast("string"), F.lit("x"), turn.cast("string")).alias("id"),
                F.concat(F.col("c.role"), F.lit("_"), (conv % 7).cast("string")).alias("author"),
                body.alias("body"),
                F.concat(F.lit("t3_s"), conv.cast("string")).alias("link_id"),
                F.when(turn == 0, F.concat(F.lit("t3_s"), conv.cast("string")))
                 .otherwise(F.concat(F.lit("t1_c"), conv.cast("string"), F.lit("x"), (turn - 1).cast("string")))
                 .alias("parent_id"),
                (F.col("c.role") != "user").alias("no_follow"),
                F.concat(F.lit("/r/topic"), (conv % 5).cast("string"), F.lit("/comments/s"), conv.cast("string"),
                         F.lit("/c"), conv.cast("string"), F.lit("x"), turn.cast("string"), F.lit("/")).alias("permalink"),
                F.concat(F.lit("topic"), (conv % 5).cast("string")).alias("subreddit")))


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One submission per conversation; its title is the whole opening turn."""
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("turn") == 0).select(
        F.concat(F.lit("t3_s"), F.col("conv_id").cast("string")).alias("link_id"),
        F.col("text").alias("title"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eval pairs (pair_id, lang, pred, ref) over whole documents.

    The reference is the whole text; the prediction is the whole text with
    every period and comma removed, a fixed imperfect "model" that has
    nothing to say to every 50th reference.
    """
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("pair_id"), "lang",
                    F.when(F.col("doc_id") % 50 == 0, F.lit("")).otherwise(F.regexp_replace("text", "[.,]", "")).alias("pred"),
                    F.col("text").alias("ref"))


def token_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token vectors (pair_id, side, pos, vec): ten vectors per pair, five per side.

    The prediction of every 50th pair is empty: its ten are all the reference's.
    """
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.floor(F.col("vec_id") / 10).cast("bigint").alias("pair_id"),
        F.when((F.col("vec_id") % 10 < 5) & (F.col("vec_id") % 500 >= 10), F.lit("pred")).otherwise(F.lit("ref")).alias("side"),
        (F.col("vec_id") % 10).cast("bigint").alias("pos"),
        F.col("embedding").alias("vec"))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pair_id, source_body, target_body): each turn with the turn before it.

    An equi-join on (conv_id, turn - 1), so no window over a conversation.
    """
    c = table(spark, sf_dir, "conversations")
    prev = c.select(F.col("conv_id"), (F.col("turn") + 1).alias("turn"), F.col("text").alias("source_body"))
    return (c.join(prev, ["conv_id", "turn"])
            .select(F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("pair_id"),
                    "source_body", F.col("text").alias("target_body")))


def chinese_variants(lang, key) -> Column:
    """Documents and rows labelled ``en`` as Chinese, by turns of the two variants; other labels stay.

    The given tables hold no Chinese; only the labels differ, the texts are as given.
    """
    return F.when(lang == "en", F.when(key % 2 == 0, F.lit("zh-cn")).otherwise(F.lit("zh-tw"))).otherwise(lang)


def documents_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled text for the language model: (lang, text)."""
    d = table(spark, sf_dir, "documents")
    return d.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
