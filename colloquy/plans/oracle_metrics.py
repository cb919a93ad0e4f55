"""DuckDB SQL twins of the metric queries."""

from __future__ import annotations

from ..functions import fixed_values as V
from .oracle import q


def tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {q(V.WS_CLASS)}), lambda w: w <> '')"


def ntok_sql(x: str) -> str:
    return f"len({tokens(x)})"


def metric_tokens(x: str, eos: bool = True) -> str:
    t = tokens(x)
    return f"list_concat({t}, [{q(V.EOS_TOKEN)}])" if eos else t


def ng(t: str, n: str) -> str:
    """n-grams of list t (n may be a column)."""
    return (f"CASE WHEN len({t}) >= {n} THEN list_transform(range(1, len({t}) - {n} + 2), "
            f"lambda i: list_slice({t}, i, i + {n} - 1)) ELSE list_slice([{t}], 1, 0) END")


def orders(ns) -> str:
    return "(SELECT unnest([" + ", ".join(str(n) for n in ns) + "]) AS n)"


def _by(by) -> tuple[str, str, str]:
    """(select prefix, group-by prefix, join condition parts)."""
    if not by:
        return "", "", ""
    cols = ", ".join(by)
    return cols + ", ", cols + ", ", cols


def unpivot(src: str, by, metric: str, cols) -> str:
    sel, _, _ = _by(by)
    on = ", ".join(cols)
    return (f"SELECT {sel}{q(metric)} AS metric, name, round(value, 6) AS value FROM "
            f"(UNPIVOT (SELECT {sel}{', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in cols)} FROM {src}) "
            f"ON {on} INTO NAME name VALUE value)")


def sentence_distinct(src: str, by=(), ns=V.DISTINCT_ORDERS) -> str:
    sel, grp, _ = _by(by)
    parts = []
    for n in ns:
        parts.append(f"coalesce(avg(CASE WHEN len(t) = 0 THEN 0.0::DOUBLE WHEN len(t) < {n} THEN 1.0::DOUBLE "
                     f"ELSE len(list_distinct({ng('t', str(n))})) / len(t) END), 0.0::DOUBLE) AS distinct_{n}")
    inner = f"(SELECT {sel}{', '.join(parts)} FROM {src} {'GROUP BY ' + grp.rstrip(', ') if by else ''})"
    return unpivot(inner, by, "sentence_distinct", [f"distinct_{n}" for n in ns])


def corpus_distinct(src: str, by=(), ns=V.DISTINCT_ORDERS) -> str:
    sel, grp, _ = _by(by)
    keys = (f"(SELECT {sel}o.n, unnest(CASE WHEN len(t) >= o.n THEN {ng('t', 'o.n')} "
            f"ELSE list_transform(t, lambda x: [x]) END) AS gram FROM {src}, {orders(ns)} o)")
    nd = f"(SELECT {sel}n, count(DISTINCT gram) AS nd FROM {keys} GROUP BY {grp}n)"
    tot = f"(SELECT {sel}sum(len(t)) AS total FROM {src} {'GROUP BY ' + grp.rstrip(', ') if by else ''})"
    on = " AND ".join([f"d.{c} = tt.{c}" for c in by] + ["d.n = o.n"])
    tsel = "".join(f"tt.{c}, " for c in by)
    return (f"SELECT {tsel}'corpus_distinct' AS metric, 'distinct_' || o.n AS name, "
            f"round(CASE WHEN tt.total > 0 THEN coalesce(d.nd, 0) / tt.total ELSE 0.0::DOUBLE END, 6) AS value "
            f"FROM {tot} tt CROSS JOIN {orders(ns)} o LEFT JOIN {nd} d ON {on}")


def entropy(src: str, by=(), ns=V.DISTINCT_ORDERS) -> str:
    sel, grp, _ = _by(by)
    keys = (f"(SELECT {sel}o.n, unnest(CASE WHEN len(t) >= o.n THEN {ng('t', 'o.n')} ELSE [t] END) AS gram "
            f"FROM {src}, {orders(ns)} o)")
    c = f"(SELECT {sel}n, gram, count(*) AS c FROM {keys} GROUP BY {grp}n, gram)"
    h = f"(SELECT {sel}n, sum(c) AS tc, sum(c * ln(c)) AS s FROM {c} GROUP BY {grp}n)"
    tot = f"(SELECT {sel}count(*) AS sentences FROM {src} {'GROUP BY ' + grp.rstrip(', ') if by else ''})"
    on = " AND ".join([f"h.{c} = tt.{c}" for c in by] + ["h.n = o.n"])
    tsel = "".join(f"tt.{c}, " for c in by)
    return (f"SELECT {tsel}'entropy' AS metric, 'entropy_' || o.n AS name, "
            f"round(CASE WHEN h.tc > 0 THEN ln(h.tc) - h.s / h.tc ELSE 0.0::DOUBLE END, 6) AS value "
            f"FROM {tot} tt CROSS JOIN {orders(ns)} o LEFT JOIN {h} h ON {on}")


def match_counts(src: str, by=(), max_order: int = V.BLEU_MAX_ORDER, key: str = "pair_id") -> str:
    """Wide table m1..m4, t1..t4, r1..r4 over src(by..., key, p, r)."""
    sel, grp, _ = _by(by)
    ns = range(1, max_order + 1)
    e = (f"(SELECT {sel}{key}, o.n, unnest({ng('p', 'o.n')}) AS gram, 1 AS ip, 0 AS ir FROM {src}, {orders(ns)} o "
         f"UNION ALL SELECT {sel}{key}, o.n, unnest({ng('r', 'o.n')}) AS gram, 0 AS ip, 1 AS ir FROM {src}, {orders(ns)} o)")
    g = f"(SELECT {sel}{key}, n, gram, sum(ip) AS cp, sum(ir) AS cr FROM {e} GROUP BY {grp}{key}, n, gram)"
    per = f"(SELECT {sel}n, sum(least(cp, cr)) AS m, sum(cp) AS t, sum(cr) AS rt FROM {g} GROUP BY {grp}n)"
    cols = []
    for n in ns:
        cols += [f"coalesce(sum(m) FILTER (WHERE n = {n}), 0) AS m{n}",
                 f"coalesce(sum(t) FILTER (WHERE n = {n}), 0) AS t{n}",
                 f"coalesce(sum(rt) FILTER (WHERE n = {n}), 0) AS r{n}"]
    return f"(SELECT {sel}{', '.join(cols)} FROM {per} {'GROUP BY ' + grp.rstrip(', ') if by else ''})"


def bleu(src_preds: str, by=(), max_order: int = V.BLEU_MAX_ORDER) -> str:
    sel, _, _ = _by(by)
    strip = f"lambda x: regexp_replace(x, {q('^' + V.SUBWORD_MARK + '+|' + V.SUBWORD_MARK + '+$')}, '', 'g')"
    tk = (f"(SELECT {sel}pair_id, list_transform({tokens('pred')}, {strip}) AS p, "
          f"list_transform({tokens('ref')}, {strip}) AS r FROM {src_preds})")
    w = match_counts(tk, by, max_order)
    ns = range(1, max_order + 1)
    ps = [f"CASE WHEN t{n} > 0 THEN m{n} / t{n} ELSE 0.0::DOUBLE END AS precision_{n}" for n in ns]
    step1 = f"(SELECT *, {', '.join(ps)}, CASE WHEN r1 > 0 THEN t1 / r1 ELSE NULL END AS ratio FROM {w})"
    logs = " + ".join(f"ln(precision_{n})" for n in ns)
    least = ", ".join(f"precision_{n}" for n in ns)
    step2 = (f"(SELECT *, CASE WHEN ratio > 1.0 THEN 1.0::DOUBLE WHEN ratio > 0 THEN exp(1.0 - 1.0 / ratio) "
             f"ELSE 0.0::DOUBLE END AS brevity_penalty FROM {step1})")
    step3 = (f"(SELECT *, CASE WHEN least({least}) > 0 THEN exp(({logs}) / {max_order}) ELSE 0.0::DOUBLE END "
             f"* brevity_penalty AS bleu, coalesce(ratio, 0.0::DOUBLE) AS length_ratio, t1 AS translation_length, "
             f"r1 AS reference_length FROM {step2})")
    cols = ["bleu"] + [f"precision_{n}" for n in ns] + ["brevity_penalty", "length_ratio", "translation_length",
                                                       "reference_length"]
    return unpivot(step3, by, "bleu", cols)


def tokenize_13a(x: str) -> str:
    s = f"regexp_replace({x}, {q(f'^{V.WS_CLASS}|{V.WS_CLASS}$')}, '', 'g')"
    for a, b in V.TOK13A_REPLACE + V.TOK13A_UNESCAPE:
        s = f"replace({s}, {q(a)}, {q(b)})"
    s = f"concat(' ', {s}, ' ')"
    for pat, rep in V.TOK13A_RULES:
        s = f"regexp_replace({s}, {q(pat)}, {q(rep)}, 'g')"
    return tokens(s)


def sacrebleu(src_preds: str, by=(), max_order: int = V.BLEU_MAX_ORDER) -> str:
    sel, _, _ = _by(by)
    tk = f"(SELECT {sel}pair_id, {tokenize_13a('pred')} AS p, {tokenize_13a('ref')} AS r FROM {src_preds})"
    w = match_counts(tk, by, max_order)
    ns = list(range(1, max_order + 1))
    ps = []
    for n in ns:
        zeros = " + ".join(f"CASE WHEN m{j} = 0 THEN 1 ELSE 0 END" for j in range(1, n + 1))
        ps.append(f"CASE WHEN m1 = 0 OR t{n} = 0 THEN 0.0::DOUBLE WHEN m{n} > 0 THEN 100.0 * m{n} / t{n} "
                  f"ELSE 100.0 / (pow(2.0, {zeros}) * t{n}) END AS precision_{n}")
    step1 = (f"(SELECT *, {', '.join(ps)}, CASE WHEN t1 < r1 THEN (CASE WHEN t1 > 0 THEN exp(1.0 - r1 / t1) "
             f"ELSE 0.0::DOUBLE END) ELSE 1.0::DOUBLE END AS bp FROM {w})")
    logs = " + ".join(f"ln(precision_{n})" for n in ns)
    least = ", ".join(f"precision_{n}" for n in ns)
    counts = ", ".join(f"m{n} AS counts_{n}, t{n} AS totals_{n}" for n in ns)
    step2 = (f"(SELECT *, CASE WHEN least({least}) > 0 THEN bp * exp(({logs}) / {max_order}) ELSE 0.0::DOUBLE END "
             f"AS score, {counts}, t1 AS sys_len, r1 AS ref_len FROM {step1})")
    cols = (["score"] + [f"counts_{n}" for n in ns] + [f"totals_{n}" for n in ns] + [f"precision_{n}" for n in ns]
            + ["bp", "sys_len", "ref_len"])
    return unpivot(step2, by, "sacrebleu", cols)


def greedy_match(src_vectors: str) -> str:
    tv = f"(SELECT pair_id, side, pos, CAST(vec AS DOUBLE[]) AS v FROM {src_vectors})"
    s = (f"(SELECT p.pair_id, p.pos AS pp, r.pos AS rp, list_dot_product(p.v, r.v) / "
         f"(sqrt(list_dot_product(p.v, p.v)) * sqrt(list_dot_product(r.v, r.v))) AS cos "
         f"FROM {tv} p JOIN {tv} r ON p.pair_id = r.pair_id AND p.side = 'pred' AND r.side = 'ref')")
    pp = f"(SELECT pair_id, avg(m) AS prec FROM (SELECT pair_id, pp, max(cos) AS m FROM {s} GROUP BY ALL) GROUP BY pair_id)"
    rr = f"(SELECT pair_id, avg(m) AS rec FROM (SELECT pair_id, rp, max(cos) AS m FROM {s} GROUP BY ALL) GROUP BY pair_id)"
    both = (f"(SELECT coalesce(prec, 0.0::DOUBLE) AS prec, coalesce(rec, 0.0::DOUBLE) AS rec "
            f"FROM (SELECT DISTINCT pair_id FROM {tv}) LEFT JOIN {pp} USING (pair_id) LEFT JOIN {rr} USING (pair_id))")
    pr = f"(SELECT prec, rec, CASE WHEN prec + rec <> 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0::DOUBLE END AS f FROM {both})"
    agg = f"(SELECT avg(prec) AS precision, avg(rec) AS recall, avg(f) AS f1 FROM {pr})"
    return unpivot(agg, (), "bertscore", ["precision", "recall", "f1"])
