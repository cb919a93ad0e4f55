"""N-gram Jaccard join: MinHash banding, then every pair checked on its full n-gram sets.

One pass over the texts writes a sketch table (word hashes, band hashes).
Texts with the same word sequence share one node. Nodes that meet in a band
are linked to the band's smallest node, one row per member; the connected
components of these links are the candidate clusters. Inside a cluster the
n-gram sets are compared exactly, in blocks of bounded size, as products of
sparse 0/1 rows; a block returns link counts and a spanning star per group,
never a row per pair. A hot band or group of exact copies therefore costs one
row per member. A large cluster is spread over many blocks, of which only those
meet whose n-gram counts allow a link; a member is copied once for each of them,
so the rows of near copies of like length grow with the square of their number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_map, materialize, text_chunks
from .components import connected_components

N = 5
THRESHOLD = 0.8
RECALL = 0.99
MAX_HASHES = 128
BLOCK_WORDS = 400_000
BLOCK_NODES = 2_000


@dataclass(frozen=True)
class Banding:
    bands: int
    rows: int

    def recall(self, similarity: float) -> float:
        """Chance that a pair of this similarity meets in a band."""
        return 1 - (1 - similarity ** self.rows) ** self.bands


def choose_banding(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> Banding:
    """The most rows a band can have while pairs at ``threshold`` meet with chance ``recall``."""
    best = Banding(max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        b = Banding(max_hashes // rows, rows)
        if b.recall(threshold) >= recall:
            best = b
    return best


def shingles(w: W.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word n-gram; a text of 1 to n - 1 words has one, all its words."""
    g, row = W.ngrams(w, tuple(range(n)))
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < n))
    if not len(short):
        return g, row
    extra = W.span_hash(w.hashes, w.first[short], w.first[short + 1])
    g, row = np.concatenate([g, extra]), np.concatenate([row, short])
    order = np.argsort(row, kind="stable")
    return g[order], row[order]


def _sketch(banding: Banding, n: int, seed: int):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2 ** 32, banding.bands * banding.rows, dtype=np.uint32) | np.uint32(1)
    x = rng.integers(0, 2 ** 32, banding.bands * banding.rows, dtype=np.uint32)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.num_rows
        node = np.zeros(rows, np.int64)
        count = np.zeros(rows, np.int64)
        grams = np.zeros(rows, np.int64)
        bands = np.zeros((rows, banding.bands), np.int64)
        flat = []
        for i, j, data, offs in text_chunks(batch.column("text")):
            w = W.split_words(data, offs)
            count[i:j] = np.diff(w.first)
            node[i:j] = W.span_hash(w.hashes, w.first[:-1], w.first[1:]).view(np.int64)
            flat.append((w.hashes >> W.U64(32)).astype(np.uint32).view(np.int32))
            g, row = shingles(w, n)
            if not len(g):
                continue
            grams[i:j] = np.bincount(_gram_rows(flat[-1], w.row, w.first, n)[1], minlength=j - i)
            first = np.flatnonzero(np.diff(row, prepend=-1))
            at = i + row[first]
            low = (g >> W.U64(32)).astype(np.uint32)
            for b in range(banding.bands):
                acc = np.full(len(first), b + 1, np.uint64)
                for k in range(b * banding.rows, (b + 1) * banding.rows):
                    least = np.minimum.reduceat((low ^ x[k]) * a[k], first)
                    acc = W.mix(acc * W.U64(31) + least.astype(np.uint64))
                bands[at, b] = acc.view(np.int64)
        word_offs = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        band_offs = np.where(count > 0, 1, 0).cumsum() * banding.bands
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(node), pa.array(count),
            pa.ListArray.from_arrays(np.concatenate([[0], band_offs]).astype(np.int32), bands[count > 0].ravel()),
            pa.ListArray.from_arrays(word_offs, np.concatenate([*flat, np.zeros(0, np.int32)])),
            pa.array(grams),
        ], ["doc_id", "node", "n_words", "bands", "words", "n_grams"])
    return run


def sketch(docs: DataFrame, banding: Banding, n: int = N, seed: int = 11) -> DataFrame:
    """(doc_id, node, n_words, bands, words, n_grams) of each row of ``docs`` (doc_id, text); null texts have no words.

    ``words`` holds 32 bits of each word's hash: an n-gram is told apart by
    n times 32 bits, and ``n_grams`` counts the different ones. ``node`` is a 64-bit hash of the word sequence.
    """
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     _sketch(banding, n, seed), "doc_id long, node long, n_words long, bands array<long>, words array<int>, n_grams long")


def _gram_rows(words: np.ndarray, row: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (n-gram, row) of word sequences, sorted by n-gram."""
    h = W.mix(words.view(np.uint32).astype(np.uint64) + W.U64(1))
    z = np.zeros(0, np.int64)
    g, row = shingles(W.Words(h, row, first, z, z), n)
    order = np.lexsort((row, g))
    g, row = g[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    return g[new], row[new]


def _gram_sets(words: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, n-gram) of some word sequences, as row and column number, columns met in two rows or more."""
    count = np.array([len(x) for x in words])
    first = np.concatenate([[0], np.cumsum(count)])
    g, row = _gram_rows(np.concatenate(words), np.repeat(np.arange(len(words)), count), first, n)
    col = np.cumsum(np.diff(g, prepend=g[:1]) != 0)
    return row, col


def _intersections(row: np.ndarray, col: np.ndarray, n_rows: int, step: int = 2048) -> np.ndarray:
    """Sizes of all pairwise intersections of 0/1 rows, by products of column slices."""
    out = np.zeros((n_rows, n_rows), np.float32)
    df = np.bincount(col)
    keep = df[col] > 1
    row, col = row[keep], col[keep]
    if not len(col):
        return out
    col = np.cumsum(np.diff(col, prepend=col[:1]) != 0)
    cuts = np.searchsorted(col, np.arange(0, col[-1] + step + 1, step))
    for c, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
        if e > s:
            part = np.zeros((n_rows, step), np.float32)
            part[row[s:e], col[s:e] - c * step] = 1
            used = np.flatnonzero(part.any(1))
            out[np.ix_(used, used)] += part[used] @ part[used].T
    return out


def _groups(near: np.ndarray) -> np.ndarray:
    """Smallest member of the connected group of each row of a symmetric boolean matrix."""
    label = np.full(len(near), -1)
    for i in range(len(near)):
        if label[i] < 0:
            label[i], front = i, np.array([i])
            while len(front):
                front = np.flatnonzero(near[front].any(0) & (label < 0))
                label[front] = i
    return label


def _verify(n: int, num: int, den: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, bi, bj), c in part.groupby(["cluster", "bi", "bj"], sort=False):
            c = c.sort_values("node", kind="stable")
            words = [np.asarray(x, np.int32) for x in c["words"]]
            row, col = _gram_sets(words, n)
            size = np.bincount(row, minlength=len(c)).astype(np.float64)
            inter = _intersections(row, col, len(c)).astype(np.float64)
            # J >= num / den, in whole numbers: den * both >= num * (a + b - both)
            near = (den + num) * inter >= num * (size[:, None] + size[None, :])
            np.fill_diagonal(near, False)
            if bi != bj:
                block = c["block"].to_numpy()
                near &= block[:, None] != block[None, :]
            node = c["node"].to_numpy()
            linked = np.flatnonzero(near.any(1))
            if len(linked):
                docs = near[linked] @ c["n_docs"].to_numpy().astype(np.float64)
                out.append(pd.DataFrame({"node": node[linked], "hub": node[_groups(near)[linked]],
                                         "links": docs.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"node": [], "hub": [], "links": []}, dtype="int64")
    return run


def dealt(cand: DataFrame, num: int, den: int, block_words: int = BLOCK_WORDS, block_nodes: int = BLOCK_NODES,
          seed: int = 11) -> DataFrame:
    """``cand`` (cluster, node, n_words, n_grams) with ``parts``, its ``block`` and the blocks ``others`` that this one meets.

    A cluster too large for one block (``parts`` over 1) is cut into layers of
    n-gram counts, each wider than the ratio that a similarity of num / den
    allows: linked nodes lie in one layer or in neighbouring ones, and only the
    blocks of those meet. A layer of k rows has k / ``block_nodes`` blocks or
    more, and a row is copied once per block of three layers: where all rows
    are of like length, that is k copies of k / ``block_nodes`` at least, which
    grows with the square of k.
    """
    blocks = F.greatest(F.ceil(F.sum("n_words") / block_words), F.ceil(F.count(F.lit(1)) / block_nodes)).cast("int")
    # A little wider than the ratio, so that rounding cannot part two linked nodes.
    width = float(np.log(1.001 * den / max(num, 1)))
    layer = F.floor(F.log(F.greatest("n_grams", F.lit(1)).cast("double")) / width).cast("int")
    member = cand.join(cand.groupBy("cluster").agg(blocks.alias("parts")), "cluster").withColumn("layer", layer)
    layers = member.where("parts > 1").groupBy("cluster", "layer").agg(blocks.alias("nb"))
    near = layers.select("cluster", F.explode(F.array(F.col("layer") - 1, "layer", F.col("layer") + 1)).alias("layer"),
                         F.struct(F.col("layer").alias("of"), "nb").alias("l"))
    near = near.groupBy("cluster", "layer").agg(F.collect_list("l").alias("near"),
                                                F.max(F.when(F.col("l.of") == F.col("layer"), F.col("l.nb"))).alias("nb"))
    number = lambda of, i: of.cast("long") * (1 << 32) + i
    others = F.flatten(F.transform("near", lambda x: F.transform(F.sequence(F.lit(0), x["nb"] - 1), lambda i: number(x["of"], i))))
    zero = F.lit(0).cast("long")
    own = number(F.col("layer"), F.pmod(F.xxhash64("node", F.lit(seed)), F.col("nb")))
    return member.join(near, ["cluster", "layer"], "left").withColumns(
        {"block": F.coalesce(own, zero), "others": F.coalesce(others, F.array(zero))}).drop("near", "nb", "layer")


def jaccard_groups(docs: DataFrame, threshold: float = THRESHOLD, n: int = N, recall: float = RECALL,
                   max_hashes: int = MAX_HASHES, block_words: int = BLOCK_WORDS,
                   block_nodes: int = BLOCK_NODES, seed: int = 11) -> DataFrame:
    """(row_id, doc_id, class_id, copy_id, n_links) of each row of ``docs`` (doc_id, text).

    ``n_links`` counts the other rows whose word n-gram set has a Jaccard
    similarity of ``threshold`` or more; ``class_id`` is the smallest doc_id
    reached over such links, ``copy_id`` the smallest with the same words.
    Every link found comes from a full comparison; a pair at the threshold is
    a candidate with a chance of at least ``recall``. A text with fewer than
    n words has one n-gram, all of them. A null, empty or wordless text has no
    links and is its own class. Rows that repeat a doc_id are rows of their
    own (``row_id``); an empty table gives no rows; other columns of ``docs``
    are not read.
    """
    num, den = int(round(threshold * 1000)), 1000
    sk = sketch(docs, choose_banding(threshold, recall, max_hashes), n, seed)
    sk = materialize(sk.withColumn("row_id", F.monotonically_increasing_id()), "jaccard-sketch")
    worded = sk.where("n_words > 0")

    nodes = worded.groupBy("node").agg(F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("n_docs"),
                                       F.min("row_id").alias("row_id"), F.first("n_words").alias("n_words"),
                                       F.first("n_grams").alias("n_grams"))
    nodes = materialize(nodes, "jaccard-nodes")
    # One row of each node carries its bands and words from here on.
    bands = (worded.join(nodes.select("row_id"), "row_id", "left_semi")
                   .select("node", F.explode("bands").alias("band")))
    hubs = (bands.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
                 .where("hub <> top").select("band", "hub"))
    # Merge joins at every size: whether AQE broadcasts a side would else change what is shuffled.
    stars = bands.join(hubs.hint("merge"), "band").where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    cand = materialize(connected_components(stars).withColumnRenamed("component", "cluster")
                       .join(nodes, "node"), "jaccard-clusters")

    total = cand.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    packs = max(1, -(-int(total) // block_words))
    member = dealt(cand, num, den, block_words, block_nodes, seed)
    member = worded.select("row_id", "words").join(member.hint("merge"), "row_id")
    pairs = member.withColumn("other", F.explode("others"))
    pairs = pairs.select("cluster", "node", "n_docs", "block", "words", F.least("block", "other").alias("bi"),
                         F.greatest("block", "other").alias("bj"), F.pmod("cluster", F.lit(packs)).alias("pack"),
                         F.when(F.col("parts") > 1, F.col("cluster")).otherwise(0).alias("big"))
    # Small clusters share a call; a block pair of a large one has its own.
    pairs = pairs.withColumn("pack", F.when(F.col("big") == 0, F.col("pack")).otherwise(-1))
    found = pairs.select("cluster", "node", "n_docs", "block", "words", "bi", "bj", "pack", "big") \
        .groupBy("big", "pack", "bi", "bj").applyInPandas(_verify(n, num, den), "node long, hub long, links long")
    found = materialize(found, "jaccard-links")

    comp = connected_components(found.select(F.col("node").alias("u"), F.col("hub").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(comp, "node", "left").join(links, "node", "left")
    least = named.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("copy_id").alias("class_id"))
    named = (named.withColumn("component", F.coalesce("component", "node")).join(least, "component")
                  .select("node", "copy_id", "class_id", (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    has = F.col("n_words") > 0
    out = sk.select("row_id", "doc_id", "n_words", "node").join(named, "node", "left")
    return out.select("row_id", "doc_id", F.when(has, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                      F.when(has, F.col("copy_id")).otherwise(F.col("doc_id")).alias("copy_id"),
                      F.when(has, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay when one of each class stays: the one with the smallest (doc_id, row number).

    All columns are kept. Wordless texts form no class and stay.
    """
    own = "__jaccard_row"
    numbered = materialize(docs.withColumn(own, F.monotonically_increasing_id()), "jaccard-docs")
    groups = jaccard_groups(numbered.select(F.col(own).alias("doc_id"), "text"), **options)
    by_doc = groups.withColumnRenamed("doc_id", own).join(numbered.select(own, F.col("doc_id").alias("__id")), own)
    low = by_doc.groupBy("class_id").agg(F.min(F.struct(F.col("__id").isNull(), "__id", own)).alias("m"))
    return numbered.join(low.select(F.col(f"m.{own}").alias(own)), own, "left_semi").drop(own)
