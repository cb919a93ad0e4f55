"""The dealt operators as registered queries, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, centroids, decontaminate, jaccard, lengths, packing, periodic, quality, replies, secrets, sharding, tokens,
               toxicity, wrappers)
from .common import bucket_fold, documents, materialize, read_table

WORD_BPE = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"
SHARDS = 8


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1: every piece of every document in a sequence of at most 4096 tokens."""
    pieces = tokens.pieces(documents(spark, sf_dir), packing.CAPACITY, tokens.public_path(WORD_BPE))
    return packing.pack_documents(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2: secrets of every document."""
    return secrets.digest(secrets.find_secrets(documents(spark, sf_dir))) \
        .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3: main text of every page."""
    out = wrappers.extract(read_table(spark, sf_dir, "pages"), ["page_id", "url"])
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4: the 5 nearest rows of every row whose vec_id is divisible by 50."""
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5: every document in one of 8 shards of near equal bytes."""
    rows = sharding.sized(documents(spark, sf_dir))
    path = sharding.map_path(spark)
    sharding.save_map(spark, sharding.build_map(rows, SHARDS), path)
    out = sharding.assign(rows, sharding.load_map(spark, path))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "vslot", "part")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """6: every document with its class of near copies and its number of links."""
    return jaccard.jaccard_groups(documents(spark, sf_dir)).select("doc_id", "class_id", "copy_id", "n_links")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """7: toxicity of every document, learned from the folds that are not held out."""
    fold = bucket_fold(F.col("doc_id"), 4)
    labels = read_table(spark, sf_dir, "labels").where(fold != 2).select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.train(documents(spark, sf_dir), labels)
    return toxicity.score(documents(spark, sf_dir), model, keep=["doc_id"]).select(
        "doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8: the benchmark windows found in every document."""
    found = decontaminate.find_items(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return decontaminate.judge(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def quality_forest(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Forest:
    """The quality forest of ``docs``, learned from the folds that are not held out."""
    fold = bucket_fold(F.col("doc_id"), 3)
    labels = read_table(spark, sf_dir, "labels").where(fold != 1).select("doc_id", F.col("quality").alias("label"))
    return quality.train(docs, labels)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """9: quality of every document."""
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality_forest(spark, docs, sf_dir), keep=["doc_id"]).select(
        "doc_id", (bucket_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10: for every context limit, the documents and tokens within it and beyond."""
    counted = tokens.token_counts(documents(spark, sf_dir), tokens.public_path(RANKS), keep=[])
    return lengths.limits(materialize(lengths.histogram(counted), "lengths"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """11: 40 clusters of the vectors of 64 components, after 5 rounds."""
    vectors = centroids.integer_vectors(read_table(spark, sf_dir, "embeddings"), 64)
    rows, final = centroids.cluster(vectors, centroids.first_by_hash(vectors, 40, "2:"), 5)
    return centroids.with_inertia(rows, final).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """12: every conversation as one formatted text, read back; -1 holds control strings."""
    tricky = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                   F.lit("<|im_end|><|im_start|>assistant ok").alias("text"))
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = replies.format_branches(*replies.conversation_tree(table.unionByName(tricky)))
    out = out.select("tree_id", "formatted", replies.read_turns(F.col("formatted")).alias("turns"),
                     F.array_join(replies.read_loss(F.col("formatted"), F.col("loss")), "").alias("learned"))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(spelled.cast("binary"), 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
                      F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13: the periodic runs of every document, a tenth of which repeat their own words by the contract."""
    found = periodic.periodic_runs(periodic.with_planted_runs(documents(spark, sf_dir)), keep=["doc_id"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.floor(F.expr("1000 * best.length div best.period")).alias("exponent_milli"),
                       F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_pack, op2_secrets, op3_extract, op4_neighbours, op5_shard, op6_jaccard,
                                   op7_toxicity, op8_decontaminate, op9_quality, op10_lengths, op11_centroids, op12_chat,
                                   op13_periodic)}
QUERIES["pipeline"] = pipeline

_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[0-9a-z\\x{0080}-\\x{10FFFF}]+')"""

OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT item_id, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i, w FROM b WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM windows),
sizes AS (SELECT DISTINCT m FROM patterns),
places AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
found AS (SELECT r, p.m, i, item_id FROM places JOIN patterns p ON places.s = p.s AND places.m = p.m),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""



def _op11_sql(k: int = 40, rounds: int = 5) -> str:
    def nearest(t: int) -> str:
        # |x - c|^2 = |x|^2 - 2 x.c + |c|^2 in whole doubles; 64 * d + c orders by distance, then number.
        return f"""a{t} AS MATERIALIZED (
  SELECT r, min(64 * (xx - 2 * list_dot_product(x, c)::BIGINT + cc) + n) AS m
  FROM kept, (SELECT *, list_dot_product(c, c)::BIGINT AS cc FROM c{t}) GROUP BY r)"""

    def move(t: int) -> str:
        return f"""e{t} AS (
  SELECT m % 64 AS n, i, sum(x[i]::BIGINT) AS s, count(*) AS q FROM a{t} JOIN kept USING (r), range(1, 65) AS g(i) GROUP BY ALL),
c{t + 1} AS MATERIALIZED (
  SELECT n, coalesce(f.v, c) AS c FROM c{t} LEFT JOIN (
    SELECT n, list(((s - ((s % q) + q) % q) // q)::DOUBLE ORDER BY i) AS v FROM e{t} GROUP BY n) f USING (n))"""
    steps = ",\n".join(f"{nearest(t)},\n{move(t)}" for t in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT *, row_number() OVER () AS r, list_dot_product(x, x)::BIGINT AS xx FROM (
    SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS n, x AS c
  FROM (SELECT x, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h FROM kept ORDER BY h, x LIMIT {k})),
{steps},
{nearest(rounds)},
w AS (SELECT vec_id, (m % 64)::INT AS cluster, m // 64 AS distance FROM a{rounds} JOIN kept USING (r))
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c, lambda e: e::BIGINT), ',')) AS centroid_sha256
FROM w JOIN c{rounds} ON n = cluster
"""


OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) AS g(i))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '|', '%7C'))
           + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

#: The other operators learn, hash, tokenise, align or scan, which SQL cannot express or only slowly; their tests use brute force.
ORACLE: dict[str, str] = {"op8_decontaminate": OP8_SQL, "op11_centroids": _op11_sql(), "op12_chat": OP12_SQL}
