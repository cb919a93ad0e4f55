"""Scalar text functions (F1-F12, F17-F19) as JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def delete_emoji(col) -> Column:
    """delete emoji ranges and both parentheses."""
    return F.regexp_replace(_c(col), V.emoji_class(), "")


def mask_user(col) -> Column:
    """user names -> [USER] (also inside words)."""
    return F.regexp_replace(_c(col), V.USER_PATTERN, V.USER_MASK)


def mask_subreddit(col) -> Column:
    """forum names -> [SUB]."""
    return F.regexp_replace(_c(col), V.SUBREDDIT_PATTERN, V.SUBREDDIT_MASK)


def delete_urls(col) -> Column:
    """delete http(s)/ftp/file links with optional brackets."""
    return F.regexp_replace(_c(col), V.URL_PATTERN, "")


def newline_to_space(col) -> Column:
    """F5."""
    return F.translate(_c(col), "\n", " ")


def mask_all(col) -> Column:
    """F2 -> F3 -> F4 -> F5, in this order (the order changes results)."""
    return newline_to_space(delete_urls(mask_subreddit(mask_user(col))))


def whitelist_filter(col) -> Column:
    """delete everything outside the whitelist (defined, off by default)."""
    return F.regexp_replace(_c(col), V.WHITELIST_PATTERN, "")


def newline_count(col) -> Column:
    """Number of '\\n' characters; counting avoids Java's '.' excluding '\\r'."""
    c = _c(col)
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))


def too_many_lines(col) -> Column:
    """P9 predicate: null or three or more newlines."""
    c = _c(col)
    return c.isNull() | (newline_count(c) >= 3)


def accepts(lang, code) -> Column:
    """The detected code belongs to the corpus language (zh: its two variants, else the code itself)."""
    l, c = _c(lang), _c(code)
    return F.when(l == "zh", c.isin(list(V.ZH_VARIANTS))).otherwise(c == l)


def lang_prefix(col) -> Column:
    """'zh-cn' -> 'zh'."""
    return F.substring(_c(col), 1, 2)


def whitespace_tokens(col) -> Column:
    """F12 default tokenizer: split on runs of whitespace, no empty tokens."""
    return F.filter(F.split(_c(col), V.WS_CLASS), lambda t: t != "")


def strip_ws(col) -> Column:
    """strip whitespace at both ends."""
    return F.regexp_replace(_c(col), f"^{V.WS_CLASS}|{V.WS_CLASS}$", "")


def strip_mark(tokens, mark: str = V.SUBWORD_MARK) -> Column:
    """strip the subword mark from both ends of every token."""
    return F.transform(_c(tokens), lambda t: F.when(F.instr(t, mark) > 0, F.regexp_replace(
        t, f"^{mark}+|{mark}+$", "")).otherwise(t))


def tokenize_13a(col) -> Column:
    """sacreBLEU 13a tokenisation of a stripped line -> array of tokens.

    The first rule would also set spaces between spaces, which no later rule nor the split can tell from one.
    """
    c = strip_ws(_c(col))
    for a, b in V.TOK13A_REPLACE:
        c = F.replace(c, F.lit(a), F.lit(b))
    for a, b in V.TOK13A_UNESCAPE:
        c = F.replace(c, F.lit(a), F.lit(b))
    c = F.concat(F.lit(" "), c, F.lit(" "))
    for pat, rep in V.TOK13A_RULES:
        c = F.regexp_replace(c, pat.replace(r" -\&", r"!-\&"), rep.replace("\\1", "$1").replace("\\2", "$2"))
    return whitespace_tokens(c)


def truncate_tokens(col, n: int) -> Column:
    """text cut to its first n whitespace tokens, joined by one space."""
    return F.array_join(F.slice(whitespace_tokens(col), 1, n), " ")


def append_marker(col, marker: str = V.EOS_TOKEN) -> Column:
    """F18."""
    return F.concat(_c(col), F.lit(marker))


def cut_prompt(out_ids, in_ids) -> Column:
    """output ids after the prompt length."""
    o, i = _c(out_ids), _c(in_ids)
    return F.slice(o, F.size(i) + 1, F.greatest(F.size(o) - F.size(i), F.lit(0)))


def char_ngrams(col, n: int = 3) -> Column:
    """Character (code point) n-grams of a string, in order; empty when shorter than n.

    The string is cut into code points once; the n-grams are built by zipping
    shifted slices, so no lambda refers to the text (a lambda that did would
    re-evaluate it per element).
    """
    chars = F.regexp_extract_all(_c(col), F.lit("(?s)."), 0)
    grams = chars
    for j in range(1, n):
        grams = F.zip_with(grams, F.slice(chars, j + 1, F.greatest(F.size(chars), F.lit(1))),
                           lambda a, b: F.concat(a, b))
    return F.slice(grams, 1, F.greatest(F.size(chars) - (n - 1), F.lit(0)))
