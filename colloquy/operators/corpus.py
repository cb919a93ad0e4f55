"""Corpus building: zip (P1-P5, P13), generate (P6-P8, J1, J2, P14), clean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import accepts, delete_emoji, mask_all, too_many_lines, whitespace_tokens
from .bytegrams import ByteModel, classify_bytes
from .langid import LangModel, classify, label_rows

DETAILED_COLUMNS = ["lang", "id", "author", "body", "link_id", "parent_id", "no_follow", "permalink", "subreddit"]
DIALOGUE_COLUMNS = ["lang", "title", "source_body", "target_body", "link_id", "source_id", "target_id"]


def with_language(rows: DataFrame, model: LangModel | ByteModel, lang: str = "lang") -> DataFrame:
    """``rows`` (id, body) with the detected language and its probability; rows that cannot be classified go.

    A byte model, or one of grams that the tasks can hold, labels each row
    where it is scanned; rows without an id go with the latter. A larger table of grams is
    joined to the texts: ids may repeat, equal (id, body) rows are classified once and all kept,
    different bodies of one id are classified each.
    """
    if isinstance(model, ByteModel):
        return classify_bytes(rows, "body", model, lang)
    held = model.held()
    if held is not None:
        return label_rows(rows.where(F.col("id").isNotNull()), "body", held, lang)
    keyed = rows.withColumn("_body", F.xxhash64("body"))
    cl = classify(keyed.select("id", "_body", "body").dropDuplicates(["id", "_body"]), ["id", "_body"], "body", model)
    return keyed.join(cl.select("id", "_body", F.col("lang").alias(lang), "prob"), ["id", "_body"]).drop("_body")


def zip_comments(comments: DataFrame, model: LangModel | ByteModel, langs=V.LANGS,
                 min_chars: int = V.MIN_BODY_CHARS, max_chars: int = V.MAX_BODY_CHARS,
                 min_prob: float = V.MIN_LANG_PROB) -> DataFrame:
    """Delete emoji -> length filter -> classify -> language and confidence filters.

    The length filter runs before classification, which is the costly part.
    """
    c = comments.withColumn("body", delete_emoji("body"))
    c = c.where(F.length("body").between(min_chars, max_chars))
    c = with_language(c, model).where(F.col("lang").isin(list(langs)) & (F.col("prob") >= min_prob))
    return c.select(*DETAILED_COLUMNS)


def generate_dialogues(detailed: DataFrame, comments: DataFrame, submissions: DataFrame,
                       detector: LangModel | ByteModel, langs=V.LANGS) -> DataFrame:
    """Pair each reply with its parent comment and the parent's submission title.

    ``detector`` (N2) is a model of its own, such as one of ``DETECT_ORDER``: the
    one that zipped the comments would repeat its answer for the replies.

    Replies must be detected in their partition's language, parents too
    (``zh`` accepts ``zh-cn`` and ``zh-tw``, any other only itself). Parents
    are the raw comments of all loaded months; each needed parent is
    classified once, however many replies it has.
    """
    r0 = (detailed.where(F.col("lang").isin(list(langs)) & F.col("parent_id").startswith(V.REPLY_PREFIX))
            .select("lang", "id", "body", "link_id", F.expr("substr(parent_id, 4)").alias("pkey")))
    # Parents of all candidate replies, each classified once. Taking them
    # from the candidates (not from the replies that passed detection) keeps
    # the reply classification single-use in the plan.
    need = r0.select(F.col("pkey").alias("id")).distinct()
    parents = comments.select("id", "body", "link_id").join(need, "id", "left_semi")
    parents = with_language(parents, detector, "plang")
    r = with_language(r0, detector, "rlang").where(accepts("lang", "rlang")).drop("rlang", "prob")
    d = (r.alias("r").join(parents.alias("p"), F.col("r.pkey") == F.col("p.id"))
          .where(accepts(F.col("r.lang"), F.col("p.plang"))))
    d = d.join(submissions.alias("s"), F.col("p.link_id") == F.col("s.link_id"))
    return d.select(F.col("r.lang").alias("lang"), F.col("s.title").alias("title"),
                    F.col("p.body").alias("source_body"), F.col("r.body").alias("target_body"),
                    F.col("r.link_id").alias("link_id"), F.col("p.id").alias("source_id"),
                    F.col("r.id").alias("target_id"))


def token_count(col, tokenizer=None):
    """Token count by the default whitespace tokenizer, or a U1 tokenizer hook."""
    if tokenizer is None:
        return F.size(whitespace_tokens(col))
    from .infer import token_count_udf
    return token_count_udf(tokenizer)(F.col(col) if isinstance(col, str) else col)


def clean_dialogues(dialogues: DataFrame, tokenizer=None,
                    lo: int = V.MIN_TOKENS_EXCLUSIVE, hi: int = V.MAX_TOKENS_EXCLUSIVE) -> DataFrame:
    """Multi-line drop -> mask users, forums, links, newlines -> token-count filter."""
    d = dialogues.where(~too_many_lines("source_body") & ~too_many_lines("target_body"))
    d = d.withColumn("source_body", mask_all("source_body")).withColumn("target_body", mask_all("target_body"))
    ns, nt = token_count("source_body", tokenizer), token_count("target_body", tokenizer)
    return d.where((ns > lo) & (ns < hi) & (nt > lo) & (nt < hi))
