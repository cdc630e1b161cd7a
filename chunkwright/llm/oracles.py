"""SQL for the registered queries of this subpackage, as DuckDB runs it on the given tables."""

#: Words of a text, lower-cased in A-Z only, with their positions from 1.
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS words, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
starts AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
),
hits AS (SELECT doc_id, i, s.n, item_id FROM starts s JOIN windows v ON s.words = v.words AND s.n = v.n),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_PLAIN = r"coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])"

OP4 = rf"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
starts AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) > 12)
),
later AS (SELECT doc_id, i FROM starts QUALIFY doc_id > min(doc_id) OVER (PARTITION BY s)),
gone AS (
  SELECT doc_id, p FROM (SELECT doc_id, unnest(generate_series(i, i + 12)) AS p FROM later) GROUP BY doc_id, p
),
places AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
),
counts AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: Each 100-byte string as hexadecimal digits, two a byte.
OP6 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 100)) AS i FROM d WHERE length(h) >= 200)
),
later AS (
  SELECT doc_id, i FROM starts QUALIFY row_number() OVER (PARTITION BY md5(s) ORDER BY doc_id, i) > 1
),
edges AS (
  SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
  FROM later
),
runs AS (
  SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS r
  FROM edges
),
spans AS (SELECT doc_id, r, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, r),
gaps AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS a, a AS b, r FROM spans
),
kept AS (
  SELECT g.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k
  FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id
),
totals AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last FROM spans GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(k, '') || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, text, source, {_PLAIN} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS words
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) > 8)
),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM again) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, source, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d) WHERE n > 0
),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM lines GROUP BY source),
frequent AS (
  SELECT source, lower(trim(line)) AS line FROM lines JOIN hosts USING (source)
  GROUP BY source, lower(trim(line)), docs HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > 0.01 * docs
),
gone AS (
  SELECT doc_id, count(*) AS n_gone_lines, sum(n) AS gone_words
  FROM lines l JOIN frequent f ON l.source = f.source AND lower(trim(l.line)) = f.line GROUP BY doc_id
),
figures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
         coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_gone_lines, 0)::BIGINT AS n_gone_lines,
         (len(w) - coalesce(gone_words, 0))::BIGINT AS n_left
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (n_left < 20 OR n_left < 0.5 * n_words) AS kept
FROM figures
"""

_NEAREST = """
a{r} AS MATERIALIZED (
  SELECT rid, vec_id, q, c, d FROM (
    SELECT rid, vec_id, v.q, c, list_sum(list_transform(list_zip(v.q, m.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM v, c{r} m
  ) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1
)"""

_MOVED = """
c{n} AS MATERIALIZED (
  SELECT c, coalesce(new, q) AS q FROM c{r} LEFT JOIN (
    SELECT c, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY i) AS new FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n
      FROM (SELECT c, unnest(q) AS x, unnest(generate_series(1, 64)) AS i FROM a{r}) GROUP BY c, i
    ) GROUP BY c
  ) USING (c)
)"""

OP11 = (
    """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, sha256('2:' || vec_id) AS h,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, q) - 1 AS c, q FROM v
  QUALIFY row_number() OVER (ORDER BY h NULLS LAST, q) <= 40
),"""
    + ",".join(_NEAREST.format(r=r) + "," + _MOVED.format(r=r, n=r + 1) for r in range(5))
    + ","
    + _NEAREST.format(r=5)
    + """
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance,
       (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c5.q, ',')) AS centroid_sha256
FROM a5 JOIN c5 USING (c)
"""
)

ORACLES: dict[str, str] = {"op1_decontaminate": OP1, "op4_recompression": OP4, "op6_suffix_dedup": OP6, "op9_line_rules": OP9, "op11_clusters": OP11}
