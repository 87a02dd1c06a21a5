"""SQL fragments for the reference (oracle) queries.

These build plain ANSI/DuckDB SQL strings over the input tables; they state
the same computation as the DataFrame plans so results can be compared row by
row. Nothing here runs on Spark.
"""

from __future__ import annotations

from quarry.config import PUNCT_FROM, PUNCT_TO, STOPWORDS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(xs) -> str:
    return "[" + ", ".join(lit(x) for x in xs) + "]"


STOP_LIST = str_list(STOPWORDS)
WS = "'[ \\t\\n\\r\\f]+'"


def basic_tokens(text: str) -> str:
    """T1, T5, T6, T7 as a list expression."""
    return (f"list_filter(regexp_split_to_array(translate(lower({text}), {lit(PUNCT_FROM)}, "
            f"{lit(PUNCT_TO)}), {WS}), lambda w: length(w) > 1 AND NOT list_contains({STOP_LIST}, w))")


def corpus_ctes(docs: str = "documents", where: str = "") -> str:
    """CTEs ``toks, lens, terms, stats, dfs, idf`` for the basic profile."""
    w = f" WHERE {where}" if where else ""
    return f"""
toks AS (SELECT doc_id, {basic_tokens('text')} AS tokens FROM {docs}{w}),
lens AS (SELECT doc_id, CAST(len(tokens) AS BIGINT) AS doc_len FROM toks),
terms AS (
  SELECT t.doc_id, t.word, CAST(count(*) AS BIGINT) AS tf, l.doc_len
  FROM (SELECT doc_id, unnest(tokens) AS word FROM toks) t JOIN lens l USING (doc_id)
  GROUP BY t.doc_id, t.word, l.doc_len),
stats AS (SELECT CAST(count(*) AS BIGINT) AS corpus_size, avg(doc_len) AS avg_doc_len FROM lens),
dfs AS (SELECT word, CAST(count(*) AS BIGINT) AS num_docs FROM terms GROUP BY word),
idf AS (SELECT word, ln(corpus_size / num_docs) AS idf FROM dfs, stats)"""


def query_ctes(source: str = "benchmark") -> str:
    """CTE ``qterms(query_id, word, qtf)`` for a query batch."""
    if source == "benchmark":
        q = "SELECT item_id AS query_id, text AS query FROM benchmark"
    elif source == "conversations":
        q = ("SELECT conv_id * 1000 + turn AS query_id, text AS query FROM conversations "
             "WHERE role = 'user'")
    else:
        q = source
    return f"""
qs AS ({q}),
qtoks AS (SELECT query_id, {basic_tokens('query')} AS tokens FROM qs),
qterms AS (
  SELECT query_id, word, CAST(count(*) AS BIGINT) AS qtf
  FROM (SELECT query_id, unnest(tokens) AS word FROM qtoks) GROUP BY query_id, word)"""


def bm25(tf: str, idf: str, dl: str, avg: str, k1: float, b: float) -> str:
    return f"({idf} * {tf} * {k1 + 1!r} / ({tf} + {k1!r} * (1 - {b!r} + {b!r} * {dl} / {avg})))"


def bm25_scores_sql(k1: float, b: float, source: str = "benchmark") -> str:
    """CTEs through ``scores(query_id, doc_id, score)``."""
    return f"""WITH {corpus_ctes().strip()},
{query_ctes(source).strip()},
scores AS (
  SELECT q.query_id, t.doc_id,
         round(sum({bm25('t.tf', 'i.idf', 't.doc_len', 's.avg_doc_len', k1, b)}), 6) AS score
  FROM qterms q JOIN terms t ON t.word = q.word JOIN idf i ON i.word = q.word CROSS JOIN stats s
  GROUP BY q.query_id, t.doc_id)"""


def tfidf_scores_sql(source: str = "benchmark") -> str:
    return f"""WITH {corpus_ctes().strip()},
{query_ctes(source).strip()},
qw AS (
  SELECT q.query_id, q.word, q.qtf * coalesce(i.idf, ln(2 * s.corpus_size + 1)) AS qw
  FROM qterms q LEFT JOIN idf i ON i.word = q.word CROSS JOIN stats s),
qnorm AS (SELECT query_id, sqrt(sum(qw * qw)) AS qnorm FROM qw GROUP BY query_id),
agg AS (
  SELECT q.query_id, t.doc_id, sum(q.qw * t.tf * i.idf) AS dot,
         sum((t.tf * i.idf) * (t.tf * i.idf)) AS dnorm2
  FROM qw q JOIN terms t ON t.word = q.word JOIN idf i ON i.word = q.word
  GROUP BY q.query_id, t.doc_id),
scores AS (
  SELECT a.query_id, a.doc_id,
         round(CASE WHEN n.qnorm * sqrt(a.dnorm2) > 0 THEN a.dot / (n.qnorm * sqrt(a.dnorm2)) END, 6) AS score
  FROM agg a JOIN qnorm n USING (query_id))"""


def top_k_sql(k: int, score_order: str = "score DESC NULLS LAST", key: str = "doc_id",
              scores: str = "scores", cols: str = "query_id, rank, doc_id, score") -> str:
    return f"""
SELECT {cols} FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY {score_order}, {key}) AS BIGINT) AS rank
  FROM {scores}) WHERE rank <= {k}"""


def bm25_scores_cte(name: str, k1: float, b: float, qterms: str = "qterms") -> str:
    """``name(query_id, doc_id, score)``; needs the corpus CTEs and ``qterms``."""
    return f"""
{name} AS (
  SELECT q.query_id, t.doc_id,
         round(sum({bm25('t.tf', 'i.idf', 't.doc_len', 's.avg_doc_len', k1, b)}), 6) AS score
  FROM {qterms} q JOIN terms t ON t.word = q.word JOIN idf i ON i.word = q.word CROSS JOIN stats s
  GROUP BY q.query_id, t.doc_id)"""


def tfidf_scores_cte(name: str, qterms: str = "qterms") -> str:
    return f"""
{name}_qw AS (
  SELECT q.query_id, q.word, q.qtf * coalesce(i.idf, ln(2 * s.corpus_size + 1)) AS qw
  FROM {qterms} q LEFT JOIN idf i ON i.word = q.word CROSS JOIN stats s),
{name}_qn AS (SELECT query_id, sqrt(sum(qw * qw)) AS qnorm FROM {name}_qw GROUP BY query_id),
{name}_agg AS (
  SELECT q.query_id, t.doc_id, sum(q.qw * t.tf * i.idf) AS dot,
         sum((t.tf * i.idf) * (t.tf * i.idf)) AS dnorm2
  FROM {name}_qw q JOIN terms t ON t.word = q.word JOIN idf i ON i.word = q.word
  GROUP BY q.query_id, t.doc_id),
{name} AS (
  SELECT a.query_id, a.doc_id,
         round(CASE WHEN n.qnorm * sqrt(a.dnorm2) > 0 THEN a.dot / (n.qnorm * sqrt(a.dnorm2)) END, 6) AS score
  FROM {name}_agg a JOIN {name}_qn n USING (query_id))"""


def top_k_cte(name: str, scores: str, k: int, order: str = "score DESC NULLS LAST, doc_id") -> str:
    return f"""
{name} AS (SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS BIGINT) AS rank
  FROM {scores}) WHERE rank <= {k})"""


def qterms_cte(name: str, source_sql: str) -> str:
    """``name(query_id, word, qtf)`` from ``source_sql`` with columns query_id, query."""
    return f"""
{name}_toks AS (SELECT query_id, {basic_tokens('query')} AS tokens FROM ({source_sql})),
{name} AS (
  SELECT query_id, word, CAST(count(*) AS BIGINT) AS qtf
  FROM (SELECT query_id, unnest(tokens) AS word FROM {name}_toks) GROUP BY query_id, word)"""


def uniform_sql(*parts: str) -> str:
    """Hashed uniform in (0, 1) from md5 of the ':'-joined parts."""
    key = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"((CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) + 0.5) / 4294967296.0)"
