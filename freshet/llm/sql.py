"""DuckDB twins of the registered text queries that SQL can express."""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP4 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g, least(10, len(w)) AS m
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, i, m, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
found AS (SELECT r, i, m, item_id FROM dw JOIN bw USING (g, m)),
hits AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS p FROM (SELECT DISTINCT r, i, m FROM found)) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""


def _found(no: int, kind: str, pattern: str, value: str, least: int) -> str:
    """Matches of one kind with their places, from the pieces between them."""
    return f"""
  SELECT r, '{kind}' AS kind, {no} AS no, a AS start, a + length(m) AS "end", v AS value FROM (
    SELECT r, m, {value} AS v,
           sum(length(gap) + CASE WHEN k = 1 THEN 0 ELSE length(prev) END) OVER (PARTITION BY r ORDER BY k) AS a
    FROM (SELECT r, k, gaps[k] AS gap, ms[k] AS m, ms[k - 1] AS prev
          FROM (SELECT r, ms, gaps, unnest(generate_series(1, len(ms))) AS k
                FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS gaps FROM d))))
  WHERE length(v) >= {least}"""


_ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"

_OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
base AS ({_found(0, 'assign', _ASSIGN, f"regexp_extract(m, '{_ASSIGN}', 1)", 6)}
  UNION ALL {_found(1, 'access', 'AKIA[A-Z0-9]+', 'm', 20)}
  UNION ALL {_found(2, 'hex', '[0-9a-f]+', 'm', 24)}),
owned AS (
  SELECT value, count(DISTINCT coalesce('s' || source, 'n')) <= 1 AS live FROM base JOIN d USING (r) GROUP BY value),
bare AS (
  SELECT * FROM ({_found(3, 'value', '[A-Za-z0-9+/_.=-]+', 'm', 16)}) x
  WHERE regexp_matches(value, '[0-9]') AND value IN (SELECT value FROM owned WHERE live)
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = x.r AND b.start <= x.start AND b."end" >= x."end")),
spans AS (SELECT base.*, live FROM base JOIN owned USING (value) UNION ALL BY NAME SELECT *, true AS live FROM bare),
every AS (
  SELECT r, string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT), ',' ORDER BY start, no) AS s,
         count_if(live) AS n_live, count_if(NOT live) AS n_examples FROM spans GROUP BY r),
basic AS (
  SELECT r, string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT), ',' ORDER BY start, no) AS s,
         count_if(kind = 'assign') AS na, count_if(kind = 'access') AS nk, count_if(kind = 'hex') AS nh FROM base GROUP BY r)
SELECT doc_id, CAST(coalesce(na, 0) AS BIGINT) AS n_assign, CAST(coalesce(nk, 0) AS BIGINT) AS n_access, CAST(coalesce(nh, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(basic.s, '')) AS base_sha256, coalesce(every.s, '') AS spans,
       CAST(coalesce(n_live, 0) AS BIGINT) AS n_live, CAST(coalesce(n_examples, 0) AS BIGINT) AS n_examples
FROM d LEFT JOIN basic USING (r) LEFT JOIN every USING (r)
"""

_OP9 = f"""
WITH RECURSIVE rules(v, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
pg AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\s[^>]*>')) AS t FROM pg WHERE url IS NOT NULL),
links AS (
  SELECT DISTINCT url AS a, b FROM (
    SELECT url, CASE WHEN regexp_matches(t, '(?i)<link.*\\brel\\s*=\\s*["'']?canonical\\b') THEN regexp_extract(t, '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)
                     WHEN regexp_matches(t, '(?i)<meta.*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b') THEN regexp_extract(t, '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1) END AS b FROM tags)
  WHERE contains(b, '://') AND b <> url),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
every AS (SELECT DISTINCT u FROM (SELECT url AS u FROM pg WHERE url IS NOT NULL UNION SELECT a FROM both_ways)),
parts AS (
  SELECT u, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), '{_UP}', '{_LOW}') AS host,
         regexp_extract(u, '(?s)^.*?://[^/?#]*(/[^?#]*)', 1) AS path FROM every),
ruled AS (
  SELECT u, h || p AS rule, v FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY u ORDER BY length(h) + length(p) DESC, length(p) DESC, v) = 1),
inherited AS (
  SELECT r.a AS u FROM reach r JOIN ruled x ON x.u = r.b GROUP BY r.a HAVING bool_or(x.v = 'block') AND NOT bool_or(x.v = 'allow'))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(v, CASE WHEN i.u IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM pg LEFT JOIN parts ON parts.u = url LEFT JOIN ruled ON ruled.u = url LEFT JOIN inherited i ON i.u = url
"""


def mix_sql(docs: str, labels: str = "labels") -> str:
    """The mix of the rows of ``docs``."""
    return f"""
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(e * size + greatest(0, least(floor(target) - e * source_size
       - coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), size)) AS BIGINT) AS taken
FROM (
  SELECT d.*, target, source_size, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS e
  FROM (
    SELECT doc_id, source, size, name, -ln((CAST('0x' || substr(name, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / weight AS key
    FROM (
      SELECT x.doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
             md5('mix|' || coalesce(CAST(x.doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS name,
             CASE WHEN good = 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
      FROM {docs} x LEFT JOIN (SELECT doc_id, max(quality) AS good FROM {labels} GROUP BY doc_id) l ON l.doc_id = x.doc_id)) d
  JOIN (
    SELECT source, source_size, CASE WHEN lvl IS NULL THEN most ELSE least(most, lvl * weight) END AS target
    FROM (
      SELECT *, first_value(CASE WHEN ratio > level THEN level END IGNORE NULLS)
                OVER (ORDER BY ratio, k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lvl
      FROM (
        SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY ratio, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY ratio, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM (
          SELECT *, source_size * 2.0::DOUBLE AS most, source_size * 2.0::DOUBLE / weight AS ratio, coalesce('s' || source, 'n') AS k
          FROM (
            SELECT source, CAST(source_size AS DOUBLE) AS source_size,
                   CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
            FROM (SELECT source, sum(CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT)) AS source_size FROM {docs} GROUP BY source)))))) t
  ON t.source IS NOT DISTINCT FROM d.source)
"""


_OP8 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0 AND len(q.e) > 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

_TERMS = f"regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, unnest({_TERMS}) AS term FROM documents),
tf AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
size AS MATERIALIZED (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
total AS MATERIALIZED (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM size),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term),
item AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (r), total GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


_OP13 = f"""
WITH p AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, '{_UP}', '{_LOW}'), '[.,;:!?\\x0A-\\x0D]')) AS p
        FROM documents)),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM p, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 10),
cuts AS (
  SELECT lang, k, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y
  FROM c, (SELECT unnest([1, 2]) AS j) WHERE j < k),
s AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r,
         CAST((CAST(1000000 AS HUGEINT) * cuts.a * cuts.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, j) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS most
  FROM (SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS phrase FROM c, (SELECT unnest([1, 2]) AS i) WHERE k = 3) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, s.a DESC, phrase) AS rank, phrase, s.a, l, r, n, score
FROM s JOIN total USING (lang) LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * s.a QUALIFY rank <= 2000
"""

SQL: dict[str, str] = {
    "op4_decontamination": _OP4,
    "op7_secrets": _OP7,
    "op8_top_k": _OP8,
    "op9_url_filter": _OP9,
    "op10_mixing": mix_sql("documents"),
    "op12_ranked_search": _OP12,
    "op13_collocations": _OP13,
}
