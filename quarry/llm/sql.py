"""DuckDB SQL for the queries whose rows SQL can express."""

_WORDS = r"""list_filter(string_split_regex(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(t="coalesce(text, '')")} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(t="coalesce(text, '')")} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item, ws[i:i + 9] AS w FROM (
    SELECT item, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT len(w) AS n FROM win),
grams AS (
  SELECT doc_id, i, n, ws[i:i + n - 1] AS w FROM (
    SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lens WHERE len(ws) >= n)),
hits AS (SELECT DISTINCT doc_id, i, n, item FROM grams JOIN win USING (w)),
words_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_HOST = r"coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"

OP3 = rf"""
WITH RECURSIVE
rules(action, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rows_ AS (SELECT page_id, url, {_HOST} AS host, {_PATH} AS path FROM pages),
urls AS (
  SELECT url, max(host) AS host, max(path) AS path FROM (SELECT coalesce(url, '') AS url, host, path FROM rows_) GROUP BY url),
ruled AS (
  SELECT url, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY url),
judged AS (SELECT url, action = 'allow' AS ok, substr(md5(url), 1, 1) < '3' AS held FROM ruled WHERE url <> ''),
asked AS (SELECT url FROM urls WHERE url <> '' AND url NOT IN (SELECT url FROM ruled)
  UNION ALL SELECT url FROM judged WHERE held),
train AS (
  SELECT ok, substr(s, greatest(1, p - 4), least(4, p - 1)) AS ctx, substr(s, p, 1) AS ch FROM (
    SELECT ok, chr(2) || url AS s, unnest(range(2, length(url) + 2)) AS p FROM judged WHERE NOT held)),
top AS (SELECT ctx, ch, count(*) FILTER (WHERE ok) AS na, count(*) FILTER (WHERE NOT ok) AS nr FROM train GROUP BY ctx, ch),
g AS (
  SELECT c, ch, sum(na) AS na, sum(nr) AS nr FROM (
    SELECT substr(ctx, length(ctx) - k + 1) AS c, ch, na, nr FROM (
      SELECT ctx, ch, na, nr, unnest(range(0, length(ctx) + 1)) AS k FROM top)) GROUP BY c, ch),
t AS (SELECT c, sum(na) AS sa, count(*) FILTER (WHERE na > 0) AS ta, sum(nr) AS sr, count(*) FILTER (WHERE nr > 0) AS tr FROM g GROUP BY c),
pos AS (
  SELECT url, substr(s, greatest(1, p - 4), least(4, p - 1)) AS ctx, substr(s, p, 1) AS ch FROM (
    SELECT url, chr(2) || url AS s, unnest(range(2, length(url) + 2)) AS p FROM asked)),
want AS (SELECT DISTINCT ctx, ch FROM pos),
ll(ctx, ch, k, pa, pr) AS (
  SELECT ctx, ch, -1, CAST(1.0 / 256 AS DOUBLE), CAST(1.0 / 256 AS DOUBLE) FROM want
  UNION ALL
  SELECT ll.ctx, ll.ch, k + 1,
    CASE WHEN coalesce(sa, 0) = 0 THEN pa ELSE (coalesce(na, 0) + ta * pa) / (sa + ta) END,
    CASE WHEN coalesce(sr, 0) = 0 THEN pr ELSE (coalesce(nr, 0) + tr * pr) / (sr + tr) END
  FROM ll LEFT JOIN t ON t.c = substr(ll.ctx, length(ll.ctx) - k)
    LEFT JOIN g ON g.c = substr(ll.ctx, length(ll.ctx) - k) AND g.ch = ll.ch
  WHERE k < length(ll.ctx)),
llr AS (SELECT ctx, ch, ln(pa) - ln(pr) AS llr FROM ll WHERE k = length(ctx)),
scored AS (SELECT url, round(avg(llr), 9) AS score FROM pos JOIN llr USING (ctx, ch) GROUP BY url),
cal AS (SELECT CAST(floor(score * 100) AS BIGINT) AS b, ok FROM scored JOIN judged USING (url) WHERE held),
totals AS (SELECT count(*) FILTER (WHERE ok) AS n_a, count(*) FILTER (WHERE NOT ok) AS n_r FROM cal),
edges AS (SELECT DISTINCT b FROM cal UNION SELECT max(b) + 1 FROM cal),
err AS (
  SELECT e.b, count(*) FILTER (WHERE ok AND cal.b < e.b) * any_value(n_r) + count(*) FILTER (WHERE NOT ok AND cal.b >= e.b) * any_value(n_a) AS e
  FROM edges e, cal, totals GROUP BY e.b),
cut AS (SELECT (min(b) + max(b)) / 200.0 AS cut FROM err, totals WHERE e = (SELECT min(e) FROM err) AND n_a > 0 AND n_r > 0)
SELECT page_id, rows_.host, rows_.path, rule,
  CASE WHEN action IS NOT NULL THEN action WHEN (SELECT cut FROM cut) IS NULL THEN 'allow'
    WHEN coalesce(score, 0) >= (SELECT cut FROM cut) THEN 'allow' ELSE 'block' END AS verdict
FROM rows_ LEFT JOIN ruled ON coalesce(rows_.url, '') = ruled.url LEFT JOIN scored ON coalesce(rows_.url, '') = scored.url
"""

OP4 = """
WITH d AS (
  SELECT doc_id, source, text, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
    CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id) - 1 AS rk, count(*) OVER (PARTITION BY source) AS c FROM d),
f AS (SELECT *, row_number() OVER (ORDER BY (rk + 0.5::DOUBLE) / c, source NULLS FIRST) - 1 AS p, count(*) OVER () AS total FROM r)
SELECT doc_id, n + 1 AS size, CRC AS text_crc32, 'rows' AS law, CAST((p * 16) // total AS INTEGER) AS shard,
  CAST(p - (((p * 16) // total) * total + 15) // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM f
"""

OP5 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT r, p, md5(substr(x, 2 * p + 1, 400)) AS m FROM (
  SELECT r, x, unnest(range(0, length(x) // 2 - 199)) AS p FROM d WHERE length(x) >= 400)),
dup AS (SELECT r, p FROM s WHERE m IN (SELECT m FROM s GROUP BY m HAVING count(*) > 1)),
e AS (SELECT r, p, p + 200 AS q, max(p + 200) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM dup),
i AS (SELECT r, p, q, sum(CASE WHEN before >= p THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS run FROM e),
runs AS (SELECT r, min(p) AS lo, max(q) AS hi FROM i GROUP BY r, run),
gaps AS (
  SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS since, row_number() OVER (PARTITION BY r ORDER BY lo DESC) AS back FROM runs),
cut AS (
  SELECT r, count(*) AS n_spans, sum(hi - lo) AS n_removed, string_agg(substr(x, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo)
    || substr(any_value(x), 2 * max(hi) + 1) AS kept FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

_KEY = r"translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7 = f"""
WITH l AS (
  SELECT doc_id, i, ls[i] AS line FROM (
    SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (
      SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
k AS (SELECT doc_id, i, line, {_KEY} AS key FROM l),
often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_SPACED = r"regexp_replace({x}, '[\x20\x09-\x0D]+', ' ', 'g')"
_AZ = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce('h' || source, '') AS host FROM documents),
w AS (SELECT r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
one AS (SELECT r, unnest(ws) AS x, unnest(range(len(ws))) AS i FROM w),
win AS (SELECT * FROM (SELECT r, i, x, lead(x, 1) OVER o AS y, lead(x, 2) OVER o AS z FROM one
  WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE z IS NOT NULL),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x, y, z) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM twice, range(3) t(k) GROUP BY r),
cut AS (SELECT r, host, text, unnest(string_split(text, chr(10))) AS raw FROM d),
lines AS (SELECT r, host, text, raw, {_AZ.format(x=f"trim({_SPACED.format(x='raw')})")} AS line
  FROM cut WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT raw) AS n_dup FROM lines GROUP BY r),
hosts AS (SELECT host, count(DISTINCT text) AS host_docs FROM d GROUP BY host),
freq AS (SELECT host, line FROM lines JOIN hosts USING (host) GROUP BY host, line, host_docs
  HAVING count(DISTINCT text) > greatest(20, 0.01 * host_docs)),
gone AS (SELECT r, sum(len(string_split(line, ' '))) AS n_gone FROM lines JOIN freq USING (host, line) GROUP BY r),
s AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
    coalesce(n_repeat, 0) AS n_repeat_words, coalesce(n_gone, 0) AS n_gone
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_gone > 0 AND (n_words - n_gone < 25 OR n_words - n_gone < 0.5 * n_words)) AS kept
FROM f
"""


def _kmeans_sql(k: int = 16, rounds: int = 3) -> str:
    """Rounds written out one after the other, every distance computed."""
    near = """
a{r} AS (SELECT r, arg_min(num, (dist, num)) AS cluster, min(dist) AS dist FROM (
  SELECT k.r, c.num, list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist
  FROM kept k, c{r} c) GROUP BY r)"""
    move = """
s{r} AS (SELECT cluster, i, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (
  SELECT a.cluster, unnest(k.v) AS x, unnest(range(64)) AS i FROM a{r} a JOIN kept k USING (r)) GROUP BY cluster, i),
m{r} AS (SELECT cluster AS num, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY cluster),
c{n} AS (SELECT c.num, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (num))"""
    steps = [(near + "," + move).format(r=r, n=r + 1) for r in range(rounds)] + [near.format(r=rounds)]
    return f"""
WITH raw AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(e, lambda x: CAST(floor(64 * x) AS BIGINT)) AS v FROM raw
  WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS num, v FROM kept QUALIFY num < {k}),
{",".join(steps)},
per AS (SELECT cluster, sum(dist)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY cluster)
SELECT k.vec_id, a.cluster::INTEGER AS cluster, a.dist AS distance, p.cluster_inertia,
  (SELECT sum(cluster_inertia)::BIGINT FROM per) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (r) JOIN per p USING (cluster) JOIN c{rounds} c ON c.num = a.cluster
"""


ORACLES = {
    "op2_decontaminate": OP2, "op3_url_filter": OP3, "op5_suffix_dedup": OP5, "op7_line_dedup": OP7,
    "op11_line_frequency": OP11, "op12_ptolemaic_kmeans": _kmeans_sql(),
}
