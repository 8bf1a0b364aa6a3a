"""DuckDB SQL of the training-data queries that SQL can express."""
from __future__ import annotations

# words of every document, ASCII blanks apart
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _quality() -> str:
    from .quality_rules import STOP_WORDS

    stop = ", ".join(f"'{x}'" for x in sorted({x for w in STOP_WORDS for x in (w, w.capitalize())}))
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body, {_WORDS} AS w FROM documents),
lines AS (
  SELECT r, list_filter(regexp_split_to_array(body, '\n'), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
grams AS (
  SELECT r, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM t)),
twice AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) >= 2),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i+1, i+2]) AS p FROM twice) GROUP BY r),
m AS (
  SELECT t.doc_id, len(t.w)::BIGINT AS n_words, length(array_to_string(t.w, ''))::BIGINT AS word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(t.w, lambda x: x IN ({stop}))) AS stops,
    length(body) - length(replace(body, '!!', '!')) AS bangs, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09]*[•\-*] '))) AS bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$'))) AS dots
  FROM t JOIN lines USING (r) LEFT JOIN covered c USING (r)),
q AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0::DOUBLE END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0::DOUBLE END AS symbol_ratio,
    CASE WHEN n_words > 0 THEN stops / n_words ELSE 0.0::DOUBLE END AS stop_word_ratio,
    CASE WHEN n_words > 0 THEN bangs / n_words ELSE 0.0::DOUBLE END AS bang_word_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0::DOUBLE END AS dup_line_ratio,
    CASE WHEN n_lines > 0 THEN bullets / n_lines ELSE 0.0::DOUBLE END AS bullet_line_ratio,
    CASE WHEN n_lines > 0 THEN dots / n_lines ELSE 0.0::DOUBLE END AS ellipsis_line_ratio
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words >= 50 AND mean_word_chars BETWEEN 2.0 AND 20.0 AND symbol_ratio <= 0.1
    AND stop_word_ratio >= 0.04 AND bang_word_ratio <= 0.5 AND dup_line_ratio <= 0.5
    AND bullet_line_ratio <= 0.9 AND ellipsis_line_ratio <= 0.3 AS kept,
  mean_word_chars, symbol_ratio, stop_word_ratio, bang_word_ratio, dup_line_ratio, bullet_line_ratio, ellipsis_line_ratio
FROM q"""


def _secrets() -> str:
    from . import secret_scan as S

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    hits = " UNION ALL ".join(
        f"SELECT r, {i} AS kind, regexp_extract_all(body, {quoted(p)}) AS h, regexp_split_to_array(body, {quoted(p)}) AS g FROM t"
        for i, (_, p) in enumerate(S.KINDS)
    )
    role = {name: ", ".join(str(S.RANK[k]) for k in kinds) for name, kinds in S.ROLES.items()}

    def sides(name: str) -> str:
        mine = f"kind IN ({role[name]})"
        return f"""CASE WHEN opens THEN pos - max(CASE WHEN {mine} AND NOT opens THEN pos END) OVER upto
      ELSE min(CASE WHEN {mine} AND opens THEN pos END) OVER onward - pos END AS gap_{name}"""

    def near(name: str) -> str:
        return f"coalesce(min(gap_{name}), {S.SCOPE + 1}) <= {S.SCOPE} AS near_{name}"

    names = "[" + ", ".join(quoted(k) for k, _ in S.KINDS) + "]"
    one = f"{names}[kind + 1] || ':' || s || ':' || e"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
hits AS ({hits}),
each AS (SELECT r, kind, g, h, unnest(range(1, len(h) + 1)) AS i FROM hits),
flat AS (SELECT r, kind, h[i] AS hit, sum(length(g[i]) + length(h[i])) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM each),
parts AS (
  SELECT r, kind, (e - length(hit))::BIGINT AS s, e::BIGINT AS e FROM flat
  WHERE CASE kind WHEN 0 THEN length(regexp_extract(hit, {quoted(S.ASSIGN)}, 2)) >= 6 WHEN 1 THEN length(hit) >= 20
    WHEN {S.RANK["token"]} THEN regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') ELSE true END),
ends AS (SELECT *, s AS pos, true AS opens FROM parts UNION ALL SELECT *, e AS pos, false AS opens FROM parts),
gaps AS (
  SELECT r, kind, s, e, {sides("id")},
    {sides("secret")}
  FROM ends
  WINDOW upto AS (PARTITION BY r ORDER BY pos), onward AS (PARTITION BY r ORDER BY pos DESC)),
beside AS (SELECT r, kind, s, e, {near("id")}, {near("secret")} FROM gaps GROUP BY r, kind, s, e),
linked AS (
  SELECT *, coalesce(max(CASE WHEN kind < 3 THEN e END) OVER before, -1) > s
      OR coalesce(min(CASE WHEN kind < 3 THEN s END) OVER later, e) < e AS again
  FROM beside
  WINDOW before AS (PARTITION BY r ORDER BY s, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    later AS (PARTITION BY r ORDER BY s DESC, kind DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
kept AS (
  SELECT * FROM linked WHERE kind < 3 OR (NOT again AND CASE kind WHEN {S.RANK["ident"]} THEN near_secret
    WHEN {S.RANK["token"]} THEN near_id ELSE near_id AND near_secret END)),
lists AS (
  SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS x,
    string_agg({one}, ',' ORDER BY s, kind, e) FILTER (kind < 3) AS base,
    string_agg({one}, ',' ORDER BY s, kind, e) AS spans
  FROM kept GROUP BY r)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(x, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN lists USING (r)"""


_MIXING = """
WITH per AS (SELECT source, sum(coalesce(strlen(text), 0) + 1)::BIGINT AS bytes FROM documents GROUP BY source),
rates AS (
  SELECT source, pow(bytes::DOUBLE, 0.5) / sum(pow(bytes::DOUBLE, 0.5)) OVER () * sum(bytes) OVER () / bytes AS rate FROM per),
terms AS (
  SELECT source, rate, k, sum(CASE WHEN k > 0 THEN ln(k::DOUBLE) ELSE 0.0 END) OVER (PARTITION BY source ORDER BY k) AS lnf
  FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM rates)),
cdf AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lnf)) OVER (PARTITION BY source ORDER BY k) AS below FROM terms),
steps AS (SELECT source, list(below) AS cdf FROM cdf GROUP BY source),
drawn AS (
  SELECT doc_id, d.source,
    len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / pow(2, 52)))::INTEGER AS copies
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, source, copies, copy::INTEGER AS copy,
  ('0x' || substr(md5('17-order|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy), 1, 15))::BIGINT AS order_key
FROM (SELECT *, unnest(range(0, copies)) AS copy FROM drawn)"""


_REPEATS = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (
  SELECT doc_id, 1000 * c AS base, substr(h, 2000 * c + 1, 2098) AS part
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2000 + 1)) AS c FROM t)),
places AS (
  SELECT doc_id, base + q AS p, substr(part, 2 * q + 1, 100) AS s
  FROM (SELECT doc_id, base, part, unnest(range(0, greatest(least(1000, length(part) // 2 - 49), 0))) AS q FROM parts)),
firsts AS (SELECT s, min(doc_id) AS least FROM places GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS prev
  FROM places JOIN firsts USING (s) WHERE least < doc_id),
runs AS (SELECT doc_id, p, sum(CASE WHEN p - prev <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gone),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM spans),
kept AS (
  SELECT t.doc_id, count(*) AS n, sum(b - a) AS removed,
    string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest
  FROM gaps JOIN t USING (doc_id) GROUP BY t.doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)"""

_NEAR = """
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1))) AS i FROM t)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM t WHERE len(w) BETWEEN 1 AND 3),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM t UNION SELECT reach.doc_id, y FROM reach JOIN links ON r = x)
SELECT t.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r) AS component_id, t.doc_id = min(r) AS kept
FROM t JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY t.doc_id"""


_COLLOCATIONS = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
grams AS (
  SELECT lang, array_to_string(w[i:i+s-1], ' ') AS phrase, s
  FROM (SELECT lang, w, s, unnest(range(1, greatest(len(w) - s + 2, 1))) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS s))),
f AS (SELECT lang, phrase, s, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
cuts AS (
  SELECT lang, phrase, f AS a, s, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS x, array_to_string(string_split(phrase, ' ')[k+1:s], ' ') AS y
  FROM (SELECT *, unnest(range(1, s)) AS k FROM f WHERE s > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.y),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, array_to_string(w[i:i+n-1], ' ') AS phrase, max(f) AS most
  FROM (SELECT lang, f, w, n, unnest(range(1, s - n + 2)) AS i
    FROM (SELECT lang, f, s, string_split(phrase, ' ') AS w, unnest(range(2, s)) AS n FROM f WHERE s > 2)) GROUP BY ALL),
ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.phrase)) AS rank, w.phrase, a, l, r, score
  FROM weakest w LEFT JOIN held h USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

_TOP_PRODUCTS = """
WITH v AS (
  SELECT DISTINCT vec_id::BIGINT AS id, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.id AS query_id, c.id AS vec_id, q.v AS qv, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.id % 100 = 0 AND q.id <> c.id AND len(q.v) = len(c.v)),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": _secrets(),
    "op2_quality_rules": _quality(),
    "op4_suffix_array_dedup": _REPEATS,
    "op6_source_mixing": _MIXING,
    "op8_minhash_near_dedup": _NEAR,
    "op11_phrase_collocations": _COLLOCATIONS,
    "op13_kdtree_search": _TOP_PRODUCTS,
}
