"""SQL for op2: figures of each document, hosts' shrunk failure rates, and the verdicts."""

SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), win AS (
  SELECT rid, i, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
), long_rules AS (
  SELECT source, unnest([{'r': 'base', 'x': base_failed::INT}, {'r': 'symbols', 'x': (10 * n_symbols > 3 * n_words)::INT}, {'r': 'lines', 'x': (10 * n_dup_lines > 5 * n_lines)::INT}], recursive := true) FROM f
), h AS (
  SELECT source, r, count(*)::DOUBLE AS n, sum(x)::DOUBLE AS bad FROM long_rules GROUP BY source, r
), tot AS (
  SELECT r, count(*) AS hosts, sum(n) AS n, sum(n * n) AS nn, sum(bad) / sum(n) AS mu, sum(bad * bad / n) AS sq FROM h GROUP BY r
), prior AS (
  SELECT r, least(greatest(mu, 1e-6), 1 - 1e-6) AS mu,
         CASE WHEN mu * (1 - mu) > 0 AND n - nn / n - (hosts - 1) > 0
              THEN least(greatest(((sq - n * mu * mu) / (mu * (1 - mu)) - (hosts - 1)) / (n - nn / n - (hosts - 1)), 1e-6), 1 - 1e-6) ELSE 1e-6 END AS rho FROM tot
), failing AS (
  SELECT DISTINCT source, true AS bad_host FROM h JOIN prior USING (r) WHERE (bad + mu * (1 / rho - 1)) / (n + (1 / rho - 1)) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(bad_host, false) AS host_failed, NOT base_failed AND NOT coalesce(bad_host, false) AS kept
FROM f LEFT JOIN failing ON f.source IS NOT DISTINCT FROM failing.source
"""
