"""DuckDB SQL for the queries of queries.py, where SQL can express them."""

from __future__ import annotations

from weft.llm import secret_scan

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

OP1 = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents
), q AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id),
k AS (
  SELECT d.*, -ln((('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE)
    / 4503599627370496.0::DOUBLE) / (CASE WHEN q > 0 THEN 2.0 WHEN q = 0 THEN 0.5 ELSE 1.0 END)::DOUBLE AS key
  FROM d LEFT JOIN q ON d.doc_id = q.doc_id
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::BIGINT AS w
  FROM k GROUP BY source
), f AS (
  SELECT *, 3 * source_size AS cap,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level,
    row_number() OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST) AS i
  FROM s
), l AS (SELECT arg_min(level, i) AS level FROM f WHERE level * w <= cap),
t AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE, l.level * w), cap::DOUBLE) AS target FROM f LEFT JOIN l ON true
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t
), r AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  (size * (epochs + (target > epochs * source_size AND 2 * upto - size <= 2 * (target - epochs * source_size))::INT))::BIGINT AS taken,
  (epochs + (target > epochs * source_size AND 2 * upto - size <= 2 * (target - epochs * source_size))::INT)::BIGINT AS copies
FROM r
"""

OP6 = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

OP5 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, hash(CASE WHEN len(w) >= 4 THEN w[i : i + 3] ELSE w END, len(w) < 4) AS s
  FROM w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS u(i)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS v, a AS u FROM e UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.u)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT v AS doc_id, min(u) AS component_id FROM r GROUP BY v) c USING (doc_id)
"""



def _op12() -> str:
    """Four rounds and the last assignment, each as two common tables; squared lengths of parts are added only to errors."""
    steps = [
        """WITH k AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (
  SELECT r, vec_id, label, p, x[p * len(x) // 4 + 1 : (p + 1) * len(x) // 4] AS x FROM k, unnest(range(4)) AS u(p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM v QUALIFY e < 256
)"""
    ]
    for n in range(5):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT v.r, v.p, arg_min(c.e, 256 * (list_dot_product(c.x, c.x) - 2 * list_dot_product(v.x, c.x)) + c.e) AS e,
    min(list_dot_product(c.x, c.x) - 2 * list_dot_product(v.x, c.x)) AS d
  FROM v JOIN c{n} c ON c.p = v.p GROUP BY v.r, v.p
)""")
        if n < 4:
            steps.append(f"""s{n} AS (
  SELECT a.p, a.e, i, floor(sum(v.x[i]) / count(*)) AS y
  FROM a{n} a JOIN v ON v.r = a.r AND v.p = a.p, unnest(range(1, len(v.x) + 1)) AS u(i) GROUP BY a.p, a.e, i
), c{n + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x
  FROM c{n} c LEFT JOIN (SELECT p, e, list(y ORDER BY i) AS x FROM s{n} GROUP BY p, e) m ON m.p = c.p AND m.e = c.e
)""")
    steps.append("""f AS (
  SELECT v.r, any_value(v.vec_id) AS vec_id, any_value(v.label) AS label,
    string_agg(lower(printf('%02x', a.e::INT)), '' ORDER BY v.p) AS code, sum(a.d + list_dot_product(v.x, v.x))::BIGINT AS error
  FROM v JOIN a4 a ON a.r = v.r AND a.p = v.p GROUP BY v.r
), h AS (
  SELECT sha256(string_agg(list_aggregate(list_transform(x, lambda y: y::BIGINT::VARCHAR), 'string_agg', ','), ',' ORDER BY p, e)) AS h FROM c4
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT h FROM h) AS codebooks_sha256 FROM f""")
    return ",\n".join(steps)


def _op13() -> str:
    """Matches and what lies between them, their places by running sums; the two models by counts of pairs."""

    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def matches(kind: int, pattern: str, group: int, keep: str) -> str:
        return f"""SELECT r, {kind} AS kind, b - own AS a, b, value FROM (
    SELECT r, own, value, sum(gap + own) OVER (PARTITION BY r ORDER BY i) AS b FROM (
      SELECT r, i, len(x[i]) AS gap, len(f[i]) AS own, g[i] AS value FROM (
        SELECT r, string_split_regex(t, {text(pattern)}) AS x, regexp_extract_all(t, {text(pattern)}) AS f,
          regexp_extract_all(t, {text(pattern)}, {group}) AS g FROM d
      ), unnest(range(1, len(f) + 1)) AS u(i)
    )
  ) WHERE {keep}"""

    names = ", ".join(f"({text(n)})" for n in secret_scan.public_names())
    ruled = ", ".join(f"({text(r)}, 0, 'names', {secret_scan.RULE_WEIGHT})" for r in secret_scan.rules())
    characters = f"unnest(string_split({text(secret_scan.CHARACTERS)}, ''))"
    half, size = secret_scan.SMOOTHING, len(secret_scan.CHARACTERS)
    kinds = ", ".join(map(text, secret_scan.KINDS))
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
z AS (SELECT sha256(i::VARCHAR) AS h FROM unnest(range({secret_scan.DIGESTS})) AS u(i)),
q AS (SELECT h[1:40] AS h, to_base64(unhex(h)) AS c FROM z),
e AS (
  SELECT unnest([h, upper(h), replace(c, '=', ''), translate(replace(c, '=', ''), '+/', '-_'), regexp_replace(c, '[+/=]', '', 'g'),
    upper(regexp_replace(c, '[+/=]', '', 'g')), lower(regexp_replace(c, '[+/=]', '', 'g'))]) AS text, 1 AS label, 'random' AS part, 1 AS n FROM q
  UNION ALL
  SELECT unnest([x, upper(x), replace(x, '_', '-'), 'lib/python/site-packages/pyspark/sql/' || x]), 0, 'names', 1 FROM (VALUES {names}) AS v(x)
  UNION ALL FROM (VALUES {ruled})
  UNION ALL
  SELECT w, 0, 'words', count(*) FROM (
    SELECT unnest(regexp_extract_all(regexp_replace(t, {text(secret_scan.KNOWN)}, ' ', 'g'), {text(secret_scan.WORD)})) AS w FROM d
  ) WHERE len(w) BETWEEN {secret_scan.WORD_LEAST} AND {secret_scan.WORD_MOST} GROUP BY w
), p AS (
  SELECT label, part, pair, sum(n) AS n FROM (
    SELECT label, part, n, ('^' || text)[i : i + 1] AS pair FROM e, unnest(range(1, len(text) + 1)) AS u(i)
  ) GROUP BY ALL
), s AS (SELECT label, part, pair[1] AS x, sum(n) AS n FROM p GROUP BY ALL),
g AS (SELECT x || y AS pair, x FROM (SELECT {characters} AS x UNION ALL SELECT '^'), (SELECT {characters} AS y)),
m AS (
  SELECT g.pair, l.label, coalesce(sum(s.n / (s.n + {secret_scan.SUPPORT}::DOUBLE) * (coalesce(p.n, 0) + {half}::DOUBLE) / (s.n + {half * size}::DOUBLE))
    / sum(s.n / (s.n + {secret_scan.SUPPORT}::DOUBLE)), 1 / {size}::DOUBLE) AS prob
  FROM g CROSS JOIN (SELECT DISTINCT label, part FROM e) l
  LEFT JOIN p ON p.label = l.label AND p.part = l.part AND p.pair = g.pair
  LEFT JOIN s ON s.label = l.label AND s.part = l.part AND s.x = g.x GROUP BY g.pair, l.label
), ratio AS MATERIALIZED (
  SELECT a.pair, round(1000 * ln(a.prob / b.prob))::BIGINT AS ratio FROM m a JOIN m b ON a.pair = b.pair AND a.label = 1 AND b.label = 0
), k AS MATERIALIZED (
  {matches(0, secret_scan.ASSIGN, 1, f"len(value) >= {secret_scan.ASSIGN_LEAST}")}
  UNION ALL {matches(1, secret_scan.ACCESS, 0, "true")}
  UNION ALL {matches(2, secret_scan.HEX, 0, "true")}
), c AS ({matches(3, secret_scan.RUN, 0, "true")}
), f AS (
  SELECT r, kind, a, b, value FROM (
    SELECT c.*, unnest(list_transform(range(1, len(value) + 1), lambda i: ('^' || value)[i : i + 1])) AS pair FROM c
  ) JOIN ratio USING (pair) GROUP BY r, kind, a, b, value HAVING sum(ratio) >= {round(1000 * secret_scan.MARGIN)}
), y AS (
  FROM k UNION ALL
  SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.r = f.r AND k.a < f.b AND f.a < k.b)
), o AS (
  SELECT r, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
    string_agg([{kinds}][kind + 1] || ':' || a || ':' || b, ',' ORDER BY a, kind) FILTER (kind < 3) AS base,
    string_agg([{kinds}][kind + 1] || ':' || a || ':' || b, ',' ORDER BY a, kind) AS spans FROM y GROUP BY r
)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN o USING (r)"""


ORACLES: dict[str, str] = {
    "op1_mix_sources": OP1,
    "op5_ngram_jaccard_join": OP5,
    "op6_exact_dedup": OP6,
    "op12_vector_codes": _op12(),
    "op13_secret_scan": _op13(),
}
