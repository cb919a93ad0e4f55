"""A responder over an n-gram table, for every strategy of U5 (greedy, beam_search, sample).

The neural decoders of the original are not available. ``train_replies``
learns in Spark which word follows which: a row of a dialogue is the words of
its source, then those of its target, then the end, so that the last word of
a source leads to the first of its answer. The table has a fixed size: the
``contexts`` most frequent words and, for each, its ``choices`` most frequent
followers; one more row, for all other words, has the most frequent words of
all. ``ReplyTable.factory`` is a model for ``infer.responder``; it decodes the
texts of a batch together, in numpy, inside the tasks.

Words are whitespace tokens; a word of more than ``WORD_CHARS`` characters is
in no pair. The end is written as the empty word, which no token is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.draws import text_key, uniform
from ..functions.text import whitespace_tokens
from ..session import materialize
from .positional import first_k_per_group

CONTEXTS = 5000      # words that have a row of their own
CHOICES = 100        # followers kept per row
WORD_CHARS = 64
END = ""


def _places(pairs: DataFrame, source: str, target: str) -> DataFrame:
    """(word, before, after) of every place; a null text has no words, and a long word is next to nothing."""
    none = F.array().cast("array<string>")
    words = F.concat(F.coalesce(whitespace_tokens(source), none), F.coalesce(whitespace_tokens(target), none), F.array(F.lit(END)))
    e = pairs.select(words.alias("_w")).select(F.posexplode("_w").alias("_i", "word"), "_w")
    short = lambda c: F.when(F.length(c) <= WORD_CHARS, c)
    return e.where(F.length("word") <= WORD_CHARS).select(
        "word", short(F.get("_w", F.col("_i") - 1)).alias("before"), short(F.get("_w", F.col("_i") + 1)).alias("after"))


def reply_table(pairs: DataFrame, source: str = "source_body", target: str = "target_body",
                contexts: int = CONTEXTS, choices: int = CHOICES) -> DataFrame:
    """(context, rank, word, c, total): the kept followers, most frequent first, ties by word.

    ``total`` counts every follower of the context, also those not kept. The
    row of all other words has the empty context and never the end. Words are
    counted first, so that only the followers of kept contexts are shuffled.
    """
    places = _places(pairs, source, target)
    words = materialize(places.groupBy("word").agg(F.count("before").alias("c"), F.count("after").alias("total")), "words")
    led = words.where("total > 0").select(F.col("word").alias("context"), "total", (-F.col("total")).alias("_o"), F.lit(0).alias("_g"))
    kept = materialize(first_k_per_group(led, ["_g"], ["_o", "context"], contexts).select(
        F.monotonically_increasing_id().alias("k"), "context", "total"), "contexts")
    side = F.broadcast(kept)                                    # ``contexts`` rows
    # A context travels as its number.
    pairs_of = places.where(F.col("after").isNotNull()).join(side.select("k", F.col("context").alias("word")), "word")
    own = pairs_of.groupBy("k", F.col("after").alias("word")).agg(F.count(F.lit(1)).alias("c"))
    rest = words.where((F.col("word") != END) & (F.col("c") > 0)).select(F.lit(-1).cast("long").alias("k"), "word", "c")
    total = rest.agg(F.sum("c")).first()[0] or 0                # one number
    # The rank filter is applied in the tasks before the shuffle: a context sends ``choices`` rows per task.
    w = Window.partitionBy("k").orderBy(F.desc("c"), "word")
    ranked = own.unionByName(rest).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= choices)
    return ranked.join(side, "k", "left").select(F.coalesce("context", F.lit(END)).alias("context"), "rank", "word", "c",
                                                 F.coalesce("total", F.lit(total)).alias("total"))


@dataclass
class ReplyTable:
    words: list              # sorted; the end is word 0
    row_of: np.ndarray       # word -> its row, 0 for the row of all other words
    follower: np.ndarray     # rows x choices, word ids, -1 behind the last
    logp: np.ndarray         # rows x choices, -inf behind the last

    @cached_property
    def ids(self) -> dict:
        """Made in the task, so that it does not travel."""
        return {w: i for i, w in enumerate(self.words)}

    def factory(self, max_input: int = V.MAX_INPUT_LENGTH, max_target: int = V.MAX_TARGET_LENGTH, seed: int = V.SEED):
        """A model factory for ``infer.responder``: sources are read up to ``max_input`` words,
        answers end after ``max_target`` words. A null or empty source starts at the row of all other words."""
        decoders = {"greedy": greedy, "beam_search": beam_search, "sample": sample}

        def model():
            known: dict = {}        # strategy and options -> answers by the row they start from

            def run(texts, strategy, **options):
                starts = np.array([self.start_row(t, max_input) for t in texts], dtype=np.int64)
                if not len(self.words) or not len(starts):
                    return [[""] for _ in texts]

                def decode(rows, **more):
                    found = decoders[strategy](self, rows, max_target, **options, **more)
                    return [[" ".join(self.words[i] for i in answer) for answer in answers] for answers in found]
                if strategy == "sample":
                    return decode(starts, keys=np.array([text_key(t, seed) for t in texts], dtype=np.uint64))
                # Nothing but the row decides the answers: a worker decodes each row of the table once at most.
                have = known.setdefault((strategy, *sorted(options.items())), {})
                new = sorted(set(starts.tolist()) - have.keys())
                if new:
                    have.update(zip(new, decode(np.array(new, dtype=np.int64))))
                return [list(have[row]) for row in starts.tolist()]
            return run
        return model

    def start_row(self, text, max_input: int) -> int:
        read = (text or "").split()[:max_input]
        return int(self.row_of[self.ids[read[-1]]]) if read and read[-1] in self.ids else 0


def load_table(rows: pd.DataFrame) -> ReplyTable:
    """The rows of ``reply_table`` as arrays."""
    said, led = (rows[c].astype("category") for c in ("word", "context"))
    words = sorted({END, *said.cat.categories, *led.cat.categories}) if len(rows) else []
    ids = {w: i for i, w in enumerate(words)}
    contexts = [END] + sorted(set(led.cat.categories) - {END})
    row = {c: i for i, c in enumerate(contexts)}
    width = int(rows["rank"].max()) if len(rows) else 1
    follower = np.full((len(contexts), width), -1, dtype=np.int32)
    logp = np.full((len(contexts), width), -np.inf)
    at = np.array([row[c] for c in led.cat.categories], dtype=np.int64)[led.cat.codes], rows["rank"].to_numpy(dtype=np.int64) - 1
    follower[at] = np.array([ids[w] for w in said.cat.categories], dtype=np.int64)[said.cat.codes]
    logp[at] = np.log(rows["c"].to_numpy(dtype=float)) - np.log(rows["total"].to_numpy(dtype=float))
    row_of = np.array([row.get(w, 0) for w in words], dtype=np.int32)
    return ReplyTable(words, row_of, follower, logp)


def train_replies(pairs: DataFrame, source: str = "source_body", target: str = "target_body",
                  contexts: int = CONTEXTS, choices: int = CHOICES) -> ReplyTable:
    """Learn the table of ``pairs``; (contexts + 1) x choices rows reach the driver, as Arrow, whatever the corpus."""
    return load_table(reply_table(pairs, source, target, contexts, choices).toArrow().to_pandas(strings_to_categorical=True))


# --- decoding: ``start`` holds the row each text starts from; answers are lists of word ids ---

def greedy(table: ReplyTable, start: np.ndarray, limit: int, num_return_sequences: int = 1) -> list:
    """The most frequent follower each time."""
    answers: list = [[] for _ in start]
    live, row = np.arange(len(start)), start.copy()
    for _ in range(limit):
        word = table.follower[row, 0]
        going = word > 0
        live, word = live[going], word[going]
        if not len(live):
            break
        for i, w in zip(live.tolist(), word.tolist()):
            answers[i].append(w)
        row = table.row_of[word]
    return [[a] for a in answers]


def _repeats(said: np.ndarray, step: int, n: int, follower: np.ndarray) -> np.ndarray:
    """Which followers would repeat an n-gram of the ``step`` words said so far."""
    banned = np.zeros(follower.shape, dtype=bool)
    for t in range(step - n + 1):
        same = np.ones(said.shape[:2], dtype=bool)
        for j in range(n - 1):
            same &= said[:, :, t + j] == said[:, :, step - n + 1 + j]
        banned |= same[:, :, None] & (follower == said[:, :, t + n - 1][:, :, None])
    return banned


def beam_search(table: ReplyTable, start: np.ndarray, limit: int, num_beams: int = 5, no_repeat_ngram_size: int = 0,
                num_return_sequences: int = 1) -> list:
    """The best answers by mean log probability per word (the end counts as one).

    Each step ranks all followers of all beams (ties: earlier beam, more
    frequent follower). An end among the first ``num_beams`` finishes an
    answer, a later one is passed over; the first ``num_beams`` others go on.
    A text is done with ``num_beams`` finished answers, when no beam goes on,
    or after ``limit`` words, where the beams count as finished. A follower
    that repeats an n-gram of ``no_repeat_ngram_size`` words is not taken; an
    answer all of whose followers repeat is lost unless it is the only one.
    """
    finished: list = [[] for _ in start]
    live = np.arange(len(start))
    width = table.follower.shape[1]
    said = np.zeros((len(start), num_beams, limit), dtype=np.int32)
    score = np.full((len(start), num_beams), -np.inf)
    score[:, 0] = 0.0
    row = np.repeat(start[:, None], num_beams, axis=1)
    for step in range(limit):
        follower = table.follower[row]
        total = score[:, :, None] + table.logp[row]
        if no_repeat_ngram_size and step >= no_repeat_ngram_size:
            total[_repeats(said, step, no_repeat_ngram_size, follower) & (follower > 0)] = -np.inf
        flat = total.reshape(len(live), -1)
        order = np.argsort(-flat, axis=1, kind="stable")[:, :2 * num_beams]
        keep, new_said, new_score = [], [], []
        for b, text in enumerate(live.tolist()):
            beams, scores = [], []
            for place, i in enumerate(order[b].tolist()):
                s = flat[b, i]
                if s == -np.inf or len(beams) == num_beams:
                    break
                k, w = i // width, int(follower[b, i // width, i % width])
                if w == 0:
                    if place < num_beams:
                        finished[text].append((s / (step + 1), said[b, k, :step].tolist()))
                    continue
                beams.append((k, w))
                scores.append(s)
            if not beams and not finished[text]:        # every follower repeats: the best beam ends here
                finished[text].append((score[b, 0] / max(step, 1), said[b, 0, :step].tolist()))
            if not beams or len(finished[text]) >= num_beams:
                continue
            grown = said[b][[k for k, _ in beams] + [0] * (num_beams - len(beams))]
            grown[:len(beams), step] = [w for _, w in beams]
            keep.append(text)
            new_said.append(grown)
            new_score.append(scores + [-np.inf] * (num_beams - len(beams)))
        if not keep:
            break
        live, said, score = np.array(keep), np.stack(new_said), np.array(new_score)
        row = table.row_of[said[:, :, step]]
    else:
        for b, text in enumerate(live.tolist()):
            finished[text] += [(s / limit, said[b, k].tolist()) for k, s in enumerate(score[b].tolist()) if s > -np.inf]
    best = [sorted(f, key=lambda x: -x[0])[:num_return_sequences] for f in finished]
    return [[answer for _, answer in b] for b in best]


def sample(table: ReplyTable, start: np.ndarray, limit: int, keys: np.ndarray, temperature: float = 1.0, top_k: int = 0,
           top_p: float = 0.0, num_return_sequences: int = 1) -> list:
    """Draw followers: the first ``top_k`` (0: all), of these the fewest that hold ``top_p`` of their
    probability at ``temperature`` (0: all). The draws depend on the seed and the text, so that equal
    texts get equal answers wherever they are decoded."""
    answers: list = [[[] for _ in range(num_return_sequences)] for _ in start]
    for a in range(num_return_sequences):
        live, row = np.arange(len(start)), start.copy()
        for step in range(limit):
            logp = table.logp[row][:, :top_k or None] / temperature
            with np.errstate(invalid="ignore"):      # a row without followers: no number, and the answer ends
                p = np.exp(logp - logp[:, :1])
            p /= p.sum(axis=1, keepdims=True)
            if top_p:
                p[np.cumsum(p, axis=1) - p >= top_p] = 0.0
            reach = np.cumsum(p, axis=1)
            u = uniform(keys[live], a * limit + step) * reach[:, -1]
            # The first follower whose reach is beyond the draw; one of no probability adds no reach.
            place = (reach <= u[:, None]).sum(axis=1)
            word = table.follower[row, np.minimum(place, (p > 0).sum(axis=1) - 1)]
            going = word > 0
            live, word = live[going], word[going]
            if not len(live):
                break
            for i, w in zip(live.tolist(), word.tolist()):
                answers[i][a].append(w)
            row = table.row_of[word]
    return answers
