"""Subword tokens of a public vocabulary.

The vocabulary file is a parameter; it is opened once per Python worker and
texts pass in Arrow batches. Nothing is trained here.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from .encode import pad_to
from .infer import _loaded


def public_path(name: str) -> str:
    """The place of one of the public vocabulary files."""
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceTokenizer:
    """A tokenizer hook (U1) over a sentence-piece vocabulary: pieces with the mark of word starts, and their ids."""

    def __init__(self, path: str):
        import sentencepiece
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)

    def tokenize(self, text: str) -> list[str]:
        # Equal pieces are one object: a batch holds its different pieces once.
        return [sys.intern(p) for p in self._model.encode(text, out_type=str, num_threads=1)]

    def ids(self, text: str) -> list[int]:
        return self._model.encode(text, num_threads=1)


def piece_factory(path: str):
    """A factory for ``corpus.clean_dialogues`` and the functions below."""
    return lambda: PieceTokenizer(path)


def _compact(cut: Callable[[str], list], kind: T.DataType) -> Callable:
    """``cut`` for texts that may be null; ids as 32-bit arrays, a ninth of a list of Python numbers."""
    if isinstance(kind, T.IntegerType):
        return lambda x: np.asarray(cut(x) if x is not None else [], np.int32)
    return lambda x: cut(x) if x is not None else []


def _udf(factory, method: str, kind: T.DataType):
    name = uuid.uuid4().hex

    @F.pandas_udf(T.ArrayType(kind))
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cut = _compact(getattr(_loaded(name, factory), method), kind)
        for b in batches:
            yield pd.Series([cut(x) for x in b], dtype=object)
    return udf


def pieces(col: Column | str, factory) -> Column:
    """the subword tokens of a text; null and empty texts have none."""
    return _udf(factory, "tokenize", T.StringType())(col)


def piece_ids(col: Column | str, factory) -> Column:
    """The ids of the subword tokens of a text."""
    return _udf(factory, "ids", T.IntegerType())(col)


def encode_fixed_pieces(df: DataFrame, key: str, factory, source: str = "source_body", target: str = "target_body",
                        max_input: int = V.MAX_INPUT_LENGTH, max_target: int = V.MAX_TARGET_LENGTH, eos: int = 2, pad: int = 0) -> DataFrame:
    """F13 on subword ids: truncate to max_len - 1, add ``eos``, pad to max_len. One row per input row, no join and no shuffle."""
    ids = df.select(key, piece_ids(source, factory).alias("_s"), piece_ids(target, factory).alias("_t"))
    s = F.concat(F.slice("_s", 1, max_input - 1), F.array(F.lit(eos)))
    t = F.concat(F.slice("_t", 1, max_target - 1), F.array(F.lit(eos)))
    return ids.select(key, pad_to(s, max_input, pad).alias("input_ids"), pad_to(F.transform(s, lambda x: F.lit(1)), max_input, 0).alias("attention_mask"),
                      pad_to(t, max_target, pad).alias("labels"))
