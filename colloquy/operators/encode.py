"""Token arrays for training and decoding (F13-F16, J8, U2 input).

The pretrained subword vocabularies of the original are not available; the
vocabulary is learned from the corpus: whitespace tokens ranked by count
(then token), after the three special ids. Lookups are joins against the
written vocabulary table, broadcast only where Spark knows it is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import whitespace_tokens
from ..session import materialize
from .positional import rank_within

SPECIALS = [(V.PAD_TOKEN, V.PAD_ID), (V.EOS_TOKEN, V.EOS_ID), (V.UNK_TOKEN, V.UNK_ID)]


@dataclass
class Vocab:
    table: DataFrame      # token string, id int (specials included)
    n_rows: int

    def side(self) -> DataFrame:
        """The table for a join: written, so Spark knows its bytes and broadcasts it only where they are few."""
        return self.table


def build_vocab(df: DataFrame, cols: list) -> Vocab:
    """Ids 0-2 are pad, end, unknown; then tokens by descending count, then token."""
    toks = None
    for c in cols:
        t = df.select(F.explode(whitespace_tokens(c)).alias("token"))
        toks = t if toks is None else toks.unionByName(t)
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("cnt")).withColumn("_neg", -F.col("cnt"))
    ranked = rank_within(counts.withColumn("_g", F.lit(0)), ["_g"], ["_neg", "token"])
    words = ranked.select("token", (F.col("rn") + (len(SPECIALS) - 1)).cast("int").alias("id"))
    spark = df.sparkSession
    specials = spark.createDataFrame(SPECIALS, "token string, id int")
    table = materialize(specials.unionByName(words))
    return Vocab(table, table.count())


def _ids_of(df: DataFrame, key: str, cols: list, vocab: Vocab, limit: int) -> DataFrame:
    """(key, ids_<col> ...) with the first ``limit`` tokens of each column as ids.

    One row per input row: rows of one key are told apart by their tokens, and
    rows equal in these too are counted and repeated. A null text has no tokens.
    """
    parts = [F.transform(F.slice(F.coalesce(whitespace_tokens(c), F.array().cast("array<string>")), 1, limit),
                         (lambda i: lambda t, p: F.struct(F.lit(i).alias("side"), p.alias("pos"), t.alias("token")))(i))
             for i, c in enumerate(cols)]
    e = df.select(key, F.concat(*parts).alias("_t")).select(key, F.xxhash64("_t").alias("_h"), F.posexplode_outer("_t").alias("_i", "x"))
    e = e.select(key, "_h", (F.coalesce("_i", F.lit(0)) == 0).alias("_first"), "x.*")
    j = e.join(vocab.side(), "token", "left").withColumn("id", F.coalesce(F.col("id"), F.lit(V.UNK_ID)))
    aggs = [F.array_sort(F.collect_set(F.when(F.col("side") == i, F.struct("pos", "id")))).alias(f"_s{i}")
            for i in range(len(cols))]
    return _repeat(j.groupBy(key, "_h").agg(F.count_if("_first").alias("_n"), *aggs)).select(
        key, *[F.transform(f"_s{i}", lambda s: s["id"]).alias(f"ids_{c}") for i, c in enumerate(cols)])


def _repeat(df: DataFrame) -> DataFrame:
    """Every row ``_n`` times."""
    return df.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).drop("_k", "_n")


def pad_to(ids: Column, length: int, pad: int = V.PAD_ID) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(ids), F.lit(0))))


def encode_fixed(df: DataFrame, key: str, vocab: Vocab, source: str = "source_body", target: str = "target_body",
                 max_input: int = V.MAX_INPUT_LENGTH, max_target: int = V.MAX_TARGET_LENGTH) -> DataFrame:
    """truncate to max_len - 1 tokens, add the end id, pad to max_len (source and target)."""
    limit = max(max_input, max_target) - 1
    ids = _ids_of(df, key, [source, target], vocab, limit)
    s = F.concat(F.slice(F.col(f"ids_{source}"), 1, max_input - 1), F.array(F.lit(V.EOS_ID)))
    t = F.concat(F.slice(F.col(f"ids_{target}"), 1, max_target - 1), F.array(F.lit(V.EOS_ID)))
    return ids.select(key, pad_to(s, max_input).alias("input_ids"),
                      pad_to(F.transform(s, lambda x: F.lit(1)), max_input, 0).alias("attention_mask"),
                      pad_to(t, max_target).alias("labels"))


def pair_columns(translated: bool) -> tuple:
    """The (source, target) columns to encode."""
    return ("translated_source_body", "translated_target_body") if translated else ("source_body", "target_body")


def pack_pairs(df: DataFrame, key: str, vocab: Vocab, source: str = "source_body", target: str = "target_body",
               max_len: int = V.MAX_INPUT_LENGTH) -> DataFrame:
    """src[:max_len-1] + [end] + tgt[:max_len-1] + [end]; labels equal the inputs."""
    ids = _ids_of(df, key, [source, target], vocab, max_len - 1)
    packed = F.concat(F.col(f"ids_{source}"), F.array(F.lit(V.EOS_ID)), F.col(f"ids_{target}"), F.array(F.lit(V.EOS_ID)))
    return ids.select(key, packed.alias("input_ids"), packed.alias("labels"))


def replace_ignored(ids: Column, pad: int = V.PAD_ID) -> Column:
    """F16: label -100 -> pad id."""
    return F.transform(ids, lambda x: F.when(x == V.LABEL_IGNORE, F.lit(pad)).otherwise(x))


def decode(df: DataFrame, key: str, ids_col: str, vocab: Vocab, out: str = "text") -> DataFrame:
    """Ids -> text, special ids skipped, tokens joined by one space. One row per input row, as in ``_ids_of``."""
    specials = [i for _, i in SPECIALS]
    kept = F.filter(replace_ignored(F.col(ids_col)), lambda x: ~x.isin(specials))
    e = df.select(key, kept.alias("_t")).select(key, F.xxhash64("_t").alias("_h"), F.posexplode_outer("_t").alias("pos", "id"))
    j = e.join(vocab.side(), "id", "left")
    g = _repeat(j.groupBy(key, "_h").agg(
        F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("_n"),
        F.array_sort(F.collect_set(F.when(F.col("token").isNotNull(), F.struct("pos", "token")))).alias("_s")))
    return g.select(key, F.array_join(F.transform("_s", lambda s: s["token"]), " ").alias(out))
