"""Train/eval/test splits and dataset selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .positional import first_k_per_group, rank_within

TRAIN, EVAL, TEST = V.SPLIT_NAMES


def seeded_order(key, seed: int = V.SEED) -> Column:
    """L1: a seeded permutation key, md5('<seed>|<key>'), the same string in SQL."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), k.cast("string")))


def split_tail(df: DataFrame, key: str, test_rows: int = V.TAIL_TEST_ROWS, ratio: float = V.TAIL_RATIO,
               lang_col: str = "lang") -> DataFrame:
    """In key order per language, the last ``test_rows`` are test; of the
    rest, the first int((n - test_rows) / ratio) are train and the others eval.

    A language with no more than ``test_rows`` rows is test as a whole (the
    original's test set; its train set would overlap it there).
    """
    r = rank_within(df, [lang_col], [key])
    train_len = F.floor((F.col("n") - test_rows) / F.lit(float(ratio)))
    split = (F.when(F.col("rn") <= train_len, TRAIN)
              .when(F.col("rn") <= F.col("n") - test_rows, EVAL).otherwise(TEST))
    return r.withColumn("split", split).drop("rn", "n")


def _borders_split(df: DataFrame, key: str, a: Column, b: Column, lang_col: str) -> DataFrame:
    r = rank_within(df, [lang_col], [key])
    split = F.when(F.col("rn") <= a, TRAIN).when(F.col("rn") <= b, EVAL).otherwise(TEST)
    return r.withColumn("split", split).drop("rn", "n")


def split_ratio(df: DataFrame, key: str, borders=V.RATIO_BORDERS, caps=V.SPLIT_CAPS,
                seed: int = V.SEED, lang_col: str = "lang") -> DataFrame:
    """Borders int(n*0.85), int(n*0.93) in key order; each part permuted by
    the seed and cut to its cap (train, eval, test)."""
    a = F.floor(F.col("n") * F.lit(float(borders[0])))
    b = F.floor(F.col("n") * F.lit(float(borders[1])))
    s = _borders_split(df, key, a, b, lang_col).withColumn("_o", seeded_order(key, seed))
    if caps is None:
        return s.drop("_o")
    cap = F.when(F.col("split") == TRAIN, caps[0]).when(F.col("split") == EVAL, caps[1]).otherwise(caps[2])
    # The ranked rows are a written table; the cut reads it a few times and moves no row.
    return first_k_per_group(s, [lang_col, "split"], ["_o", key], cap, hexadecimal=True).drop("_o")


def split_percent(df: DataFrame, key: str, split=V.PERCENT_SPLIT, lang_col: str = "lang") -> DataFrame:
    """Percent borders a <= b < 100; each border is round-half-even(p * n / 100)."""
    low, high = split
    if not 0 <= low <= high < 100:
        raise ValueError(f"percent borders must rise from 0 and stay below 100, not {low}, {high}")
    a = F.bround(F.col("n") * low / F.lit(100.0), 0)
    b = F.bround(F.col("n") * high / F.lit(100.0), 0)
    return _borders_split(df, key, a, b, lang_col)


def select_split(df: DataFrame, name: str) -> DataFrame:
    """L3: 'raw' (all), 'train', 'val' (reads eval), 'test'; other names raise."""
    if name == "raw":
        return df
    names = {"train": TRAIN, "val": EVAL, "test": TEST}
    if name not in names:
        raise ValueError("dataset name must be one of ['raw', 'train', 'val', 'test']")
    return df.where(F.col("split") == names[name])


def sample_rows(df: DataFrame, key: str, number: int | None = None, shuffle: bool = True,
                seed: int = V.SEED, lang_col: str = "lang") -> DataFrame:
    """L1/L2: per language, permute by the seed (or keep key order) and keep the first ``number``."""
    if not number:
        return df
    if not shuffle:
        return head_rows(df, key, int(number), lang_col)
    # the key breaks ties, so a recomputed partition keeps the same rows
    return first_k_per_group(df.withColumn("_o", seeded_order(key, seed)), [lang_col], ["_o", key], int(number), hexadecimal=True).drop("_o")


def head_rows(df: DataFrame, key: str, number: int = V.TRANSLATE_ROWS, lang_col: str = "lang") -> DataFrame:
    """L4: the first ``number`` rows per language in key order."""
    return first_k_per_group(df, [lang_col], [key], int(number))


def sized_split(split_df: DataFrame, name: str, key: str, small, full: int, seed: int = V.SEED,
                lang_col: str = "lang") -> DataFrame:
    """The 'train', 'val' or 'test' rows, cut per language to what ``small`` allows.

    ``True`` means ``full`` rows (``V.SMALL_TRAIN``, ``V.SMALL_DEFAULT`` or
    ``V.SMALL_TRUE``), a number that many, anything else all; 'val' gets a tenth.
    """
    rows = select_split(split_df, name)
    if not small:
        return rows
    number = full if small is True else int(small)
    number = int(number / 10) if name == "val" else number
    # ``number`` may round to 0 rows, which sample_rows would read as no limit
    return sample_rows(rows, key, number, True, seed, lang_col) if number else rows.limit(0)
