"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each builder returns CTE text; ``oracle_sql()`` in ``__spark_entry__`` joins
them into full statements over the pre-registered driver tables.
"""

from __future__ import annotations

from ..functions import fixed_values as V
from ..operators.bytegrams import ORDERS, PER_LANG
from ..operators.langid import DETECT_ORDER, GRAM_ORDER


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


COMMENTS = """comments AS (
  SELECT concat('c', c.conv_id, 'x', c.turn) AS id,
         concat(c.role, '_', c.conv_id % 7) AS author,
         CASE (c.conv_id * 7 + c.turn) % 6
           WHEN 0 THEN concat(c.text, ' u/user', c.conv_id)
           WHEN 1 THEN concat('(r/topic) ', c.text)
           WHEN 2 THEN concat(c.text, ' ', coalesce(p.url, 'https://example.com/a'))
           WHEN 3 THEN concat(c.text, ' 😀')
           ELSE c.text END AS body,
         concat('t3_s', c.conv_id) AS link_id,
         CASE WHEN c.turn = 0 THEN concat('t3_s', c.conv_id)
              ELSE concat('t1_c', c.conv_id, 'x', c.turn - 1) END AS parent_id,
         c.role <> 'user' AS no_follow,
         concat('/r/topic', c.conv_id % 5, '/comments/s', c.conv_id, '/c', c.conv_id, 'x', c.turn, '/') AS permalink,
         concat('topic', c.conv_id % 5) AS subreddit
  FROM conversations c LEFT JOIN pages p ON p.page_id = c.conv_id)"""

SUBMISSIONS = """submissions AS (
  SELECT concat('t3_s', conv_id) AS link_id, text AS title FROM conversations WHERE turn = 0)"""

PREDICTIONS = """predictions AS (
  SELECT doc_id AS pair_id, lang, CASE WHEN doc_id % 50 = 0 THEN '' ELSE regexp_replace(text, '[.,]', '', 'g') END AS pred,
         text AS ref FROM documents)"""

TOKEN_VECTORS = """token_vectors AS (
  SELECT CAST(floor(vec_id / 10) AS BIGINT) AS pair_id,
         CASE WHEN vec_id % 10 < 5 AND vec_id % 500 >= 10 THEN 'pred' ELSE 'ref' END AS side,
         CAST(vec_id % 10 AS BIGINT) AS pos, embedding AS vec
  FROM embeddings)"""

TURN_PAIRS = """turn_pairs AS (
  SELECT concat(c.conv_id, '-', c.turn) AS pair_id, p.text AS source_body, c.text AS target_body
  FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn + 1 = c.turn)"""

def model(p: str, order: int, lang: str = "lang") -> str:
    """CTEs of the naive Bayes model ``p`` over character n-grams of ``order``, of documents labelled ``lang``."""
    return f"""{p}_docs AS (SELECT {lang} AS lang, lower(text) AS t FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL),
{p}_grams AS (SELECT lang, substr(t, i, {order}) AS gram
             FROM (SELECT lang, t, unnest(range(1, length(t) - {order} + 2)) AS i FROM {p}_docs)),
{p}_counts AS (SELECT gram, lang, count(*) AS c FROM {p}_grams GROUP BY gram, lang),
{p}_vocab AS (SELECT DISTINCT gram FROM {p}_counts),
{p}_ndocs AS (SELECT lang, count(*) AS ndocs FROM {p}_docs GROUP BY lang),
{p}_langs AS (
  SELECT t.lang,
         ln(d.ndocs / (SELECT sum(ndocs) FROM {p}_ndocs)) AS prior,
         -ln(t.n + (SELECT count(*) FROM {p}_vocab)) AS u
  FROM (SELECT lang, sum(c) AS n FROM {p}_counts GROUP BY lang) t JOIN {p}_ndocs d USING (lang))"""


MODEL = model("lm", GRAM_ORDER)
DETECTOR = model("dm", DETECT_ORDER)
#: The labels of ``fixtures.chinese_variants``.
ZH_DETECTOR = model("dm", DETECT_ORDER,
                    "CASE WHEN lang <> 'en' THEN lang WHEN doc_id % 2 = 0 THEN 'zh-cn' ELSE 'zh-tw' END")


def classify(prefix: str, src: str, key: str = "id", text: str = "body",
             model: str = "lm", order: int = GRAM_ORDER) -> str:
    """CTEs ``{prefix}_cls(key, lang, prob)`` classifying ``src``."""
    p = prefix
    return f"""{p}_g AS (SELECT {key}, substr(t, i, {order}) AS gram
       FROM (SELECT {key}, t, unnest(range(1, length(t) - {order} + 2)) AS i
             FROM (SELECT {key}, lower({text}) AS t FROM {src}))),
{p}_nv AS (SELECT {key}, count(*) AS n_vocab FROM {p}_g WHERE gram IN (SELECT gram FROM {model}_vocab) GROUP BY {key}),
{p}_s AS (SELECT g.{key}, c.lang, sum(ln(c.c + 1)) AS sw FROM {p}_g g JOIN {model}_counts c USING (gram)
          GROUP BY g.{key}, c.lang),
{p}_sc AS (SELECT nv.{key}, l.lang, l.prior + nv.n_vocab * l.u + coalesce(s.sw, 0) AS score
           FROM {p}_nv nv CROSS JOIN {model}_langs l
           LEFT JOIN {p}_s s ON s.{key} = nv.{key} AND s.lang = l.lang),
{p}_cls AS (SELECT {key}, first(lang ORDER BY score DESC, lang) AS lang, 1.0 / sum(exp(score - mx)) AS prob
            FROM (SELECT *, max(score) OVER (PARTITION BY {key}) AS mx FROM {p}_sc) GROUP BY {key})"""


def _cell(n: str, r: str, c: str) -> str:
    return f"CASE WHEN {n} > 0 THEN ({n}) * ln(({n})::DOUBLE * bn / (({r})::DOUBLE * ({c}))) ELSE 0 END"


def byte_features(p: str = "bf") -> str:
    """CTEs ``{p}_occ`` (grams of documents as hexadecimal digits) and ``{p}_sel`` (lang, gram, score)."""
    return f"""{p}_docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, lang, coalesce(source, '') AS source, lower(hex(encode(text))) AS h
  FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL),
{p}_occ AS MATERIALIZED (
  SELECT r, lang, source, gram, count(*) AS c FROM (
    SELECT r, lang, source, substr(h, 2 * i + 1, 2 * k) AS gram
    FROM (SELECT *, unnest(range(0, len(h) // 2 - k + 1)) AS i FROM {p}_docs, (SELECT unnest([{', '.join(map(str, ORDERS))}]) AS k)))
  GROUP BY ALL),
{p}_n AS (SELECT count(*)::DOUBLE AS bn FROM {p}_docs),
{p}_a AS (SELECT gram, count(*)::DOUBLE AS a FROM {p}_occ GROUP BY gram),
{p}_s AS (
  SELECT gram, any_value(a) AS a, sum({_cell('n', 'a', 'm')} + {_cell('m - n', 'bn - a', 'm')}) AS t, sum(m) AS met
  FROM (SELECT gram, source, count(*) AS n FROM {p}_occ GROUP BY ALL) JOIN {p}_a USING (gram)
  JOIN (SELECT source, count(*)::DOUBLE AS m FROM {p}_docs GROUP BY source) USING (source), {p}_n GROUP BY gram),
{p}_l AS (
  SELECT lang, gram, n, a, m, t + CASE WHEN a < bn THEN (bn - met) * ln(bn / (bn - a)) ELSE 0 END AS t, bn
  FROM (SELECT lang, gram, count(*) AS n FROM {p}_occ GROUP BY ALL) JOIN {p}_s USING (gram)
  JOIN (SELECT lang, count(*)::DOUBLE AS m FROM {p}_docs GROUP BY lang) USING (lang), {p}_n),
{p}_sel AS MATERIALIZED (
  SELECT lang, gram, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, gram) AS k FROM (
      SELECT lang, gram, round(({_cell('n', 'a', 'm')} + {_cell('a - n', 'a', 'bn - m')} + {_cell('m - n', 'bn - a', 'm')}
                                + {_cell('bn - a - m + n', 'bn - a', 'bn - m')} - t) / bn, 9) AS score FROM {p}_l))
  WHERE k <= {PER_LANG})"""


def byte_model(p: str = "bf") -> str:
    """CTEs ``{p}_w`` (gram, lang, w) and ``{p}_prior`` after ``byte_features``."""
    return f"""{p}_f AS (SELECT DISTINCT gram FROM {p}_sel),
{p}_prior AS (SELECT lang, ln(count(*) / (SELECT bn FROM {p}_n)) AS prior FROM {p}_docs GROUP BY lang),
{p}_c AS (SELECT gram, lang, sum(c) AS c FROM {p}_occ JOIN {p}_f USING (gram) GROUP BY ALL),
{p}_w AS MATERIALIZED (
  SELECT gram, lang, ln((coalesce(c, 0) + 1) / (sum(coalesce(c, 0)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))) AS w
  FROM {p}_f CROSS JOIN {p}_prior LEFT JOIN {p}_c USING (gram, lang))"""


def classify_bytes(prefix: str, src: str, key: str = "id", text: str = "body", p: str = "bf") -> str:
    """CTEs ``{prefix}_cls(key, lang, prob)`` classifying ``src`` by the byte model."""
    x = prefix
    return f"""{x}_h AS (SELECT {key}, lower(hex(encode({text}))) AS h FROM {src}),
{x}_g AS MATERIALIZED (
  SELECT {key}, gram, count(*) AS c FROM (
    SELECT {key}, substr(h, 2 * i + 1, 2 * k) AS gram
    FROM (SELECT *, unnest(range(0, len(h) // 2 - k + 1)) AS i FROM {x}_h, (SELECT unnest([{', '.join(map(str, ORDERS))}]) AS k)))
  WHERE gram IN (SELECT gram FROM {p}_f) GROUP BY ALL),
{x}_sc AS (SELECT {key}, lang, any_value(prior) + sum(c * w) AS score FROM {x}_g JOIN {p}_w USING (gram) JOIN {p}_prior USING (lang) GROUP BY ALL),
{x}_cls AS (SELECT {key}, first(lang ORDER BY score DESC, lang) AS lang, 1.0 / sum(exp(score - mx)) AS prob
            FROM (SELECT *, max(score) OVER (PARTITION BY {key}) AS mx FROM {x}_sc) GROUP BY {key})"""


EMOJI = V.emoji_class()


def zip_ctes(langs, name: str = "detailed", classify=classify) -> str:
    return f"""zc AS (SELECT id, author, regexp_replace(body, {q(EMOJI)}, '', 'g') AS body, link_id, parent_id,
                  no_follow, permalink, subreddit FROM comments),
zf AS (SELECT * FROM zc WHERE length(body) BETWEEN {V.MIN_BODY_CHARS} AND {V.MAX_BODY_CHARS}),
{classify('zl', 'zf')},
{name} AS (SELECT c.lang, f.id, f.author, f.body, f.link_id, f.parent_id, f.no_follow, f.permalink, f.subreddit
             FROM zf f JOIN zl_cls c USING (id)
             WHERE c.lang IN {in_list(langs)} AND c.prob >= {V.MIN_LANG_PROB})"""


def generate_ctes(langs) -> str:
    return f"""r0 AS (SELECT * FROM detailed WHERE lang IN {in_list(langs)} AND starts_with(parent_id, {q(V.REPLY_PREFIX)})),
{classify('rl', 'r0', model='dm', order=DETECT_ORDER)},
r1 AS (SELECT r0.lang, r0.id, r0.body, r0.link_id, substr(r0.parent_id, 4) AS pkey
       FROM r0 JOIN rl_cls c USING (id) WHERE (r0.lang <> 'zh' AND c.lang = r0.lang OR r0.lang = 'zh' AND c.lang IN {in_list(V.ZH_VARIANTS)})),
par AS (SELECT id, body, link_id FROM comments WHERE id IN (SELECT pkey FROM r1)),
{classify('pl', 'par', model='dm', order=DETECT_ORDER)},
dialogues AS (SELECT r1.lang, s.title, p.body AS source_body, r1.body AS target_body, r1.link_id,
                     p.id AS source_id, r1.id AS target_id
              FROM r1 JOIN par p ON r1.pkey = p.id JOIN pl_cls pc ON pc.id = p.id
              JOIN submissions s ON s.link_id = p.link_id
              WHERE (r1.lang <> 'zh' AND pc.lang = r1.lang OR r1.lang = 'zh' AND pc.lang IN {in_list(V.ZH_VARIANTS)}))"""


def newlines(x: str) -> str:
    return f"(length({x}) - length(replace({x}, chr(10), '')))"


def mask(x: str) -> str:
    s = f"regexp_replace({x}, {q(V.USER_PATTERN)}, {q(V.USER_MASK)}, 'g')"
    s = f"regexp_replace({s}, {q(V.SUBREDDIT_PATTERN)}, {q(V.SUBREDDIT_MASK)}, 'g')"
    s = f"regexp_replace({s}, {q(V.URL_PATTERN)}, '', 'g')"
    return f"replace({s}, chr(10), ' ')"


def tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {q(V.WS_CLASS)}), lambda t: t <> '')"


def ntok(x: str) -> str:
    return f"len({tokens(x)})"


def clean_ctes(src: str = "dialogues", count=None) -> str:
    ntok = count or globals()["ntok"]
    return f"""cl0 AS (SELECT * FROM {src}
        WHERE source_body IS NOT NULL AND target_body IS NOT NULL
          AND {newlines('source_body')} < 3 AND {newlines('target_body')} < 3),
cl1 AS (SELECT lang, title, {mask('source_body')} AS source_body, {mask('target_body')} AS target_body,
               link_id, source_id, target_id FROM cl0),
cleaned AS (SELECT * FROM cl1
        WHERE {ntok('source_body')} > {V.MIN_TOKENS_EXCLUSIVE} AND {ntok('source_body')} < {V.MAX_TOKENS_EXCLUSIVE}
          AND {ntok('target_body')} > {V.MIN_TOKENS_EXCLUSIVE} AND {ntok('target_body')} < {V.MAX_TOKENS_EXCLUSIVE})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
