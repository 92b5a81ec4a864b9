"""SQL for the operators on lines, shingles and windows, by direct comparison instead of their methods."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Edits at the two ends of what differs between two lines: words that the first and the second line have more there.
_ENDS = " OR ".join(f"x[p + 1 + {a} : n - q - {c}] = y[p + 1 + {b} : m - q - {d}]" for a, b in ((1, 1), (1, 0), (0, 1)) for c, d in ((1, 1), (1, 0), (0, 1)))

LINES = rf"""
WITH d AS (
  SELECT doc_id, text, coalesce(doc_id, -9223372036854775808) AS o, string_split(text, chr(10)) AS ls FROM documents
), l AS (
  SELECT o, k, ls[k] AS line FROM (SELECT o, ls, unnest(range(1, len(ls) + 1)) AS k FROM d)
), w AS (
  SELECT o, k, array_to_string(w, ' ') AS s, w, len(w) AS n FROM (
    SELECT o, k, list_filter(string_split_regex({_LOWER.replace('text', 'line')}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM l) WHERE len(w) > 0
), firsts AS (
  SELECT s, any_value(w) AS w, any_value(n) AS n, min({{'o': o, 'k': k}}) AS place FROM w GROUP BY s
), pairs AS (
  SELECT a.s, a.w AS x, a.n, b.w AS y, b.n AS m FROM firsts a JOIN firsts b ON b.n BETWEEN a.n - 2 AND a.n + 2 AND b.place < a.place WHERE a.n >= 8 AND b.n >= 8
), same AS (
  SELECT *, coalesce(list_position(list_transform(range(1, least(n, m) + 1), lambda i: x[i] = y[i]), false) - 1, least(n, m)) AS p FROM pairs
), ends AS (
  SELECT *, coalesce(list_position(list_transform(range(0, least(n, m) - p), lambda i: x[n - i] = y[m - i]), false) - 1, least(n, m) - p) AS q FROM same
), gone AS (
  SELECT DISTINCT s FROM ends WHERE greatest(n, m) - p - q <= 2 OR {_ENDS}
), kept AS (
  SELECT place.o AS o, place.k AS k, s FROM firsts WHERE s NOT IN (SELECT s FROM gone)
), marked AS (
  SELECT l.o, l.k, l.line, w.s IS NULL OR kept.s IS NOT NULL AS stays FROM l LEFT JOIN w ON w.o = l.o AND w.k = l.k LEFT JOIN kept ON kept.o = l.o AND kept.k = l.k AND kept.s = w.s
), g AS (
  SELECT o, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (stays), '') AS t FROM marked GROUP BY o
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(t) AS kept_sha256 FROM d LEFT JOIN g ON g.o = d.o
"""

CLASSES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shares AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM shares JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)
), reach AS (
  SELECT a AS doc_id, b AS r FROM link UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.r
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.r, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id) m USING (doc_id)
"""

WINDOWS = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item_id::VARCHAR AS item, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b)
), dw AS (
  SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k)
), m AS (
  SELECT rid, i, dw.k AS k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g
), hit AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM m) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""
