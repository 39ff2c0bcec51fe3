"""DuckDB twins of the llm queries that SQL can express on whole tables.

The classifier (op1) and the token operators (op5, op9) need code that SQL
does not have; the others are written from their definitions, without the
operators' hashing, chunk exchange, trees or tiles.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Words are the runs outside the fixed white-space characters.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op2_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, p, md5_number(array_to_string(w[p:p + 49], ' ')) AS k FROM win),
first AS (SELECT k, min(doc_id) AS least FROM h GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM h JOIN first USING (k) WHERE doc_id > least),
out AS (SELECT doc_id, list(p) AS g FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM
    (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) AS e
    ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN out USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE["op3_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
g AS (SELECT doc_id, no, l[no + 1] || chr(10) || l[no + 2] AS k FROM
      (SELECT doc_id, l, unnest(range(len(l) - 1)) AS no FROM d)),
f AS (SELECT doc_id, no, first(doc_id) OVER w AS fd, first(no) OVER w AS fn FROM g
      WINDOW w AS (PARTITION BY k ORDER BY doc_id, no)),
later AS (SELECT doc_id, no, no - row_number() OVER (PARTITION BY doc_id ORDER BY no) AS run FROM f
      WHERE fd < doc_id OR (fd = doc_id AND no >= fn + 2)),
c AS (SELECT doc_id, min(no) AS lo, max(no) + 1 AS hi FROM later GROUP BY doc_id, run),
line AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS p, len(l) AS n FROM d),
gone AS (SELECT doc_id, unnest(range(lo, hi + 1)) AS p FROM
      (SELECT doc_id, lo, hi FROM c JOIN line USING (doc_id) WHERE p BETWEEN lo AND hi GROUP BY doc_id, lo, hi
       HAVING sum(length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))) >= 40 OR hi - lo + 1 = max(n))),
kept AS (SELECT doc_id, count(*) AS m, string_agg(x, chr(10) ORDER BY p) AS t FROM
      (SELECT * FROM line ANTI JOIN gone USING (doc_id, p)) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(l), 0) AS n_lines, coalesce(len(l), 0) - coalesce(m, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

ORACLE["op7_decontaminate"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS k
        FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM pat),
win AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS k
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d JOIN sizes ON len(w) >= n)),
hit AS (SELECT doc_id, win.n, p, item_id FROM win JOIN pat ON win.n = pat.n AND win.k = pat.k),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM
        (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
who AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM
        (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN who USING (doc_id)
"""

ORACLE["op8_near_vectors"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS s FROM v),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.s * b.s) >= 0.98),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN many ON vec_id = many.a
"""

ORACLE["op10_jaccard_join"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS k FROM
      (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
same AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id
         GROUP BY ALL),
link AS (SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * o >= 85 * (x.n + y.n - o)),
pairs AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, l.b FROM reach r JOIN pairs l ON r.b = l.a),
least AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON d.doc_id = least.a
"""

ORACLE["op12_filter_audit"] = r"""
WITH RECURSIVE f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
ord(o) AS (SELECT f FROM f UNION ALL SELECT o || f FROM ord JOIN f ON strpos(o, f) = 0 WHERE len(o) < 5),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM ord WHERE len(o) = 5),
first AS (SELECT coalesce(text, '') AS t, min(doc_id) AS least FROM documents GROUP BY ALL),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fail AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
      CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
      || CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
      || CASE WHEN d.doc_id > least THEN 'E' ELSE '' END AS bad
      FROM d JOIN first USING (t) LEFT JOIN l ON l.doc_id = d.doc_id),
kinds AS (SELECT part, bad, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM fail GROUP BY ALL),
cell AS (SELECT part, o, step, o[step] AS f,
      coalesce(sum(n) FILTER (translate(bad, o[1:step], '') = bad), 0) AS kept,
      coalesce(sum(n) FILTER (here AND NOT earlier), 0) AS removed,
      coalesce(sum(n) FILTER (here AND earlier), 0) AS redundant,
      coalesce(sum(n) FILTER (bad = o[step]), 0) AS unique_fails,
      coalesce(sum(good) FILTER (here AND NOT earlier), 0) AS good_lost,
      coalesce(sum(toxic) FILTER (here AND NOT earlier), 0) AS toxic_lost
      FROM (SELECT *, strpos(bad, o[step]) > 0 AS here, translate(bad, o[1:step - 1], '') <> bad AS earlier
            FROM kinds, steps) GROUP BY part, o, step)
SELECT part, o AS filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM cell
"""

_ROUND = """
d{n} AS MATERIALIZED (SELECT id, v.part, entry, sum((x - c) * (x - c)) AS d FROM v JOIN b{n} AS b ON v.part = b.part AND v.place = b.place
      GROUP BY id, v.part, entry),
a{n} AS MATERIALIZED (SELECT id, part, min(d)::BIGINT AS d, arg_min(entry, (d, entry)) AS entry FROM d{n} GROUP BY id, part),
b{m} AS MATERIALIZED (SELECT b.part, b.place, b.entry, coalesce(s.c, b.c) AS c FROM b{n} AS b LEFT JOIN
      (SELECT v.part, v.place, a.entry, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS c
       FROM v JOIN a{n} AS a USING (id, part) GROUP BY ALL) AS s
      ON s.part = b.part AND s.place = b.place AND s.entry = b.entry),
"""

ORACLE["op13_vector_codes"] = """
WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e,
      row_number() OVER (ORDER BY vec_id) AS id FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
v AS MATERIALIZED (SELECT id, (p - 1) // (n // 16) AS part, (p - 1) % (n // 16) AS place, x FROM
      (SELECT id, len(e) AS n, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS p FROM k)),
b0 AS MATERIALIZED (SELECT part, place, id - 1 AS entry, x AS c FROM v WHERE id <= 64),
""" + "".join(_ROUND.format(n=n, m=n + 1) for n in range(3)) + """
code AS (SELECT id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
      FROM a2 GROUP BY id),
digest AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY part, entry, place)) AS s FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256
FROM k JOIN code USING (id), digest
"""
