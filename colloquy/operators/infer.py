"""User-supplied models over Arrow batches.

Models, translators and tokenizers are user functions. They run inside
iterator Pandas UDFs, loaded once per Python worker (``_loaded``) and fed
Arrow batches of ``batch_size`` rows; everything around them (selection, pairing,
scoring) stays in DataFrame operations.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from ..functions.text import append_marker, truncate_tokens
from ..session import materialize
from . import metrics as M
from . import split as S


def _batched(fn: Callable[[list], list], batch_size: int):
    """Apply ``fn`` to lists of at most ``batch_size`` strings, in order."""
    def run(s: pd.Series) -> pd.Series:
        vals = s.tolist()
        out: list = []
        for i in range(0, len(vals), batch_size):
            chunk = vals[i:i + batch_size]
            res = list(fn(chunk))
            if len(res) != len(chunk):
                raise ValueError("a batch function must return one value per input")
            out.extend(res)
        return pd.Series(out, dtype=object)
    return run


_MODELS: OrderedDict = OrderedDict()
MODELS_KEPT = 4      # models one worker keeps; the least recently used goes


def _loaded(name: str, factory: Callable):
    """``factory()``, called once per worker process and UDF, not once per task."""
    if name not in _MODELS:
        _MODELS[name] = factory()
    _MODELS.move_to_end(name)
    model = _MODELS[name]
    while len(_MODELS) > MODELS_KEPT:
        _MODELS.popitem(last=False)
    return model


def text_udf(factory: Callable[[], Callable[[list], list]], batch_size: int):
    """Iterator Pandas UDF string -> string; ``factory()`` runs once per worker."""
    name = uuid.uuid4().hex

    @F.pandas_udf(T.StringType())
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = _batched(_loaded(name, factory), batch_size)
        for b in batches:
            yield run(b)
    return udf


def token_count_udf(tokenizer):
    """A tokenizer hook -> token counts. An object with ``tokenize`` is sent
    to the tasks; a class or function is a factory, called once per worker."""
    name = uuid.uuid4().hex
    factory = (lambda: tokenizer) if hasattr(tokenizer, "tokenize") and not isinstance(tokenizer, type) else tokenizer

    @F.pandas_udf(T.IntegerType())
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = _loaded(name, factory)
        for b in batches:
            yield b.map(lambda x: len(tok.tokenize(x)) if x is not None else 0).astype("int32")
    return udf


def batched_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema,
                batch_size: int = V.ENCODE_BATCH) -> DataFrame:
    """A batch function over the whole table, ``batch_size`` rows per call."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), batch_size):
                yield fn(b.iloc[i:i + batch_size].reset_index(drop=True))
    return df.mapInPandas(run, schema)


def translate_columns(df: DataFrame, translator_factory, cols=("source_body", "target_body"),
                      batch_size: int = V.TRANSLATE_BATCH) -> DataFrame:
    """Add ``translated_<col>`` for each column, in the same row (no positional merge)."""
    udf = text_udf(translator_factory, batch_size)
    for c in cols:
        df = df.withColumn(f"translated_{c}", udf(F.col(c)))
    return df


def responder(model_factory, strategy: str = "greedy", batch_size: int = V.TRANSLATE_BATCH, **options):
    """A UDF text -> first response, for strategy greedy, beam_search or sample.

    ``model_factory()`` returns ``respond(texts, strategy, **options) -> list``
    whose items are lists of responses; the first is used.
    """
    if strategy not in V.STRATEGIES:
        raise ValueError("strategy must be greedy, beam_search or sample")
    opts = {**V.STRATEGIES[strategy], **options}

    def factory():
        model = model_factory()
        return lambda texts: [r[0] if isinstance(r, (list, tuple)) else r for r in model(texts, strategy, **opts)]
    return text_udf(factory, batch_size)


def respond(df: DataFrame, model_factory, source: str = "source_body", out: str = "pred",
            strategy: str = "greedy", **options) -> DataFrame:
    return df.withColumn(out, responder(model_factory, strategy, **options)(F.col(source)))


def _score(pairs: DataFrame, metric: str, by) -> DataFrame:
    """Model output is computed once: the pairs are checkpointed before the
    metrics, which each read them again."""
    return M.compute_metric(metric, materialize(pairs), None, by)


def evaluate(test: DataFrame, model_factory, key: str = "target_id", number=V.SMALL_TRUE,
             metric: str = "all", strategy: str = "greedy", by=("lang",), **options) -> DataFrame:
    """U8: per language, seeded sample of ``number`` test rows -> respond -> J4 -> metrics."""
    rows = S.sample_rows(test, key, number, True) if number else test
    pairs = respond(rows, model_factory, "source_body", "pred", strategy, **options)
    pairs = pairs.select(*by, F.col(key).alias("pair_id"), "pred", F.col("target_body").alias("ref"))
    return _score(pairs, metric, list(by))


def eval_raw(test: DataFrame, model_factory, key: str = "target_id", number=V.SMALL_TRUE, metric: str = "all",
             strategy: str = "greedy", max_len: int = V.MAX_INPUT_LENGTH, by=("lang",), **options) -> DataFrame:
    """The source cut to ``max_len`` tokens, the end marker appended, respond, score
    against the target cut to ``max_len`` tokens."""
    rows = S.sample_rows(test, key, number, True) if number else test
    rows = rows.withColumn("_src", append_marker(truncate_tokens("source_body", max_len), V.EOS_TOKEN))
    pairs = respond(rows, model_factory, "_src", "pred", strategy, **options)
    pairs = pairs.select(*by, F.col(key).alias("pair_id"), "pred",
                         truncate_tokens("target_body", max_len).alias("ref"))
    return _score(pairs, metric, list(by))


def eval_pivot(test: DataFrame, model_factory, to_english, from_english, key: str = "target_id",
               number=V.SMALL_TRUE, metric: str = "all", strategy: str = "greedy",
               max_len: int = V.MAX_INPUT_LENGTH, by=("lang",), **options) -> DataFrame:
    """Respond on the English translation of the source, translate the
    response back, score against the original target."""
    rows = S.sample_rows(test, key, number, True) if number else test
    if "translated_source_body" not in rows.columns:
        rows = translate_columns(rows, to_english, ("source_body",))
    rows = rows.withColumn("_src", append_marker(truncate_tokens("translated_source_body", max_len), V.EOS_TOKEN))
    rows = respond(rows, model_factory, "_src", "pred_en", strategy, **options)
    back = text_udf(from_english, V.TRANSLATE_BATCH)
    pairs = rows.select(*by, F.col(key).alias("pair_id"), back(F.col("pred_en")).alias("pred"),
                        truncate_tokens("target_body", max_len).alias("ref"))
    return _score(pairs, metric, list(by))


def example_rows(pairs: DataFrame, key: str = "target_id", n: int = V.EXAMPLE_ROWS, by=("lang",)) -> DataFrame:
    """The first ``n`` rows per language in seeded order, numbered from 0."""
    r = S.rank_within(pairs.withColumn("_o", S.seeded_order(key)), list(by), ["_o", key]).where(F.col("rn") <= n)
    return r.withColumn("example", (F.col("rn") - 1).cast("bigint")).drop("_o", "rn", "n")


def example_report(test: DataFrame, model_factory, key: str = "target_id", n: int = V.EXAMPLE_ROWS,
                   by=("lang",), strategy: str = "greedy", **options) -> DataFrame:
    """(example, context, reference, prediction); only the examples are answered."""
    rows = respond(example_rows(test, key, n, by), model_factory, "source_body", "prediction", strategy, **options)
    return rows.select(*by, "example", F.col(key).alias("pair_id"), F.col("source_body").alias("context"),
                       F.col("target_body").alias("reference"), "prediction")


def example_report_translated(test: DataFrame, model_factory, from_english, key: str = "target_id",
                              n: int = V.EXAMPLE_ROWS, by=("lang",), strategy: str = "greedy",
                              max_len: int = V.MAX_INPUT_LENGTH, **options) -> DataFrame:
    """L5 after U6: the report with the English context, reference and prediction beside.

    ``test`` has the translated columns (``translate_columns``).
    """
    rows = example_rows(test, key, n, by).withColumn("context_en", truncate_tokens("translated_source_body", max_len))
    rows = rows.withColumn("_src", append_marker(F.col("context_en"), V.EOS_TOKEN))
    rows = respond(rows, model_factory, "_src", "prediction_en", strategy, **options)
    rows = rows.withColumn("prediction", text_udf(from_english, V.TRANSLATE_BATCH)(F.col("prediction_en")))
    return rows.select(*by, "example", F.col(key).alias("pair_id"), F.col("source_body").alias("context"),
                       truncate_tokens("target_body", max_len).alias("reference"), "prediction", "context_en",
                       F.col("translated_target_body").alias("reference_en"), "prediction_en")


# --- fixed stand-ins used by the registered queries --------------------------

def echo_model():
    """A baseline responder: returns the context as the response."""
    def model(texts, strategy, **options):
        return [[t] for t in texts]
    return model


def tag_translator(tag: str = "[en] "):
    """A stand-in translator: prefixes a language tag."""
    def factory():
        return lambda texts: [None if t is None else tag + t for t in texts]
    return factory
