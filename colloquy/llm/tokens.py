"""Token ids of whole texts by the public tokenizers, and their pieces.

``WordTokenizer`` cuts a batch at ASCII white space, encodes each distinct
word once and joins the ids again. White space is never part of a token of
such a tokenizer and no rule of it looks across white space, so the ids equal
those of the whole text.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import add_columns, arrow_map, text_chunks

END_ID = 1
_CACHE_WORDS = 250_000
_FOLD = np.arange(256, dtype=np.uint8)      # A-Z lowered, ASCII white space as one kind
_FOLD[0x41:0x5B] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_LOADED: dict = {}


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """The lower-casing word BPE, with a cache of words that is emptied when full."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True     # their strings in a text are ordinary text
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.cache: dict[str, bytes] = {}

    def _encode(self, words: list[str]) -> None:
        hard = []
        tokenize, letter, cache = self.model.tokenize, self.letters.__getitem__, self.cache
        for w in words:
            if w.isalpha() and (w.isascii() or max(w) < "\u0100"):
                # Letters of Latin-1 are one pre-token and already composed.
                w_ = w if w.isascii() else "".join(map(letter, w.lower().encode()))
                cache[w] = array("I", [t.id for t in tokenize(w_)]).tobytes()
            else:
                hard.append(w)
        for w, e in zip(hard, self.whole.encode_batch_fast(hard, add_special_tokens=False)):
            cache[w] = array("I", e.ids).tobytes()

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, bytes]]:
        """(row, little-endian unsigned 32-bit ids) of every text (null: none), in order."""
        for i, j, data, offs in text_chunks(texts):
            low = _FOLD[data]
            cut = _cuts(low, offs)
            solid = low != 32
            bounds = np.append((np.cumsum(solid) - 1)[cut], np.count_nonzero(solid))
            parts = pa.LargeStringArray.from_buffers(len(cut), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(low[solid]))
            coded = parts.dictionary_encode()
            words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            if len(self.cache) > _CACHE_WORDS:
                self.cache = {}
            cache = self.cache
            self._encode([w for w in words if w not in cache])
            ids = [cache[w] for w in words]
            # The ids of all words in a row: one gather from the distinct words' ids.
            flat = np.frombuffer(b"".join(ids), np.uint32)
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            at = coded.indices.to_numpy(zero_copy_only=False)
            n = size[at]
            behind = np.concatenate([[0], np.cumsum(n)])
            out = flat[np.repeat((np.cumsum(size) - size)[at] - behind[:-1], n) + np.arange(behind[-1])].astype("<u4")
            place = behind[np.searchsorted(cut, offs)].tolist()
            for r, (s, e) in enumerate(zip(place[:-1], place[1:]), i):
                yield r, out[s:e].tobytes()


def _cuts(low: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where words of a folded text begin: behind white space, and at a lone comma or stop that ends a word.

    Behind a letter such a mark is a token of its own, and words repeat more
    often without it.
    """
    n = len(low)
    if not n:
        return np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    space = low == 32
    ends = np.append(space[1:], True) | edge[1:]
    letter = (low >= 97) & (low <= 122)
    cut = edge[:-1].copy()
    cut[1:] |= space[:-1]
    cut &= ~space
    cut[1:] |= ((low == 44) | (low == 46))[1:] & ends[1:] & letter[:-1]
    return np.flatnonzero(cut)


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def pieces(docs: DataFrame, capacity: int, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """The pieces of each row of ``docs`` (doc_id, text): its ids, then the end id, cut after every ``capacity`` ids.

    Columns doc_id, piece (from 0), start, length, ids_crc32 (unsigned, of the
    little-endian unsigned 32-bit ids), and ids if asked for. Null and empty
    texts have one piece, the end id alone.
    """
    end = np.array([END_ID], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tok = word_tokenizer(tokenizer_path)
        row, piece, start, length, crc, ids = [], [], [], [], [], []
        for r, raw in tok.encode(batch.column("text")):
            raw += end
            for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[at:at + 4 * capacity]
                row.append(r)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int32))
        cols = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        if with_ids:
            cols.append(pa.array(ids, pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)])
    def release() -> None:
        _LOADED.clear()         # workers live on after their task; the cache need not
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return arrow_map(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), run, schema, release)


class RankTokenizer:
    """A byte-level BPE of a rank file."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def counts(self, texts: pa.Array) -> list[int]:
        return [len(self.enc.encode_ordinary(t)) if t else 0 for t in texts.to_pylist()]


def rank_tokenizer(path: str) -> RankTokenizer:
    """One tokenizer per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = RankTokenizer(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, tokenizer_path: str, name: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the number of ids of each text; null and empty texts have 0."""
    return add_columns(docs, lambda b: [pa.array(rank_tokenizer(tokenizer_path).counts(b.column("text")), pa.int64())],
                       f"`{name}` long", keep)
