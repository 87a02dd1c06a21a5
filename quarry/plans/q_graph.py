"""Registered graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.functions import html as H
from quarry.functions import text as T
from quarry.operators import graph as G
from quarry.operators import rerank as RR
from quarry.operators import search as S
from quarry.operators import terms as TM
from quarry.plans.catalog import register
from quarry.plans.q_dense import sql_passages, sql_vectors
from quarry.plans.q_text import sql_html_text, sql_lines, sql_strip
from quarry.plans.sql import bm25_scores_cte, corpus_ctes, lit, query_ctes, top_k_cte
from quarry.sources import tables

P = DEFAULT
DEPTH, LINKS = P.max_depth, P.links_per_page

EDGES_SQL = f"""
links AS (SELECT DISTINCT url AS src, unnest(list_transform(regexp_extract_all(html, {lit(H.HREF)}, 1), lambda x: x[2:len(x) - 1])) AS dst FROM pages),
edges AS (SELECT src, dst FROM links UNION SELECT dst AS src, src AS dst FROM links),
capped AS (SELECT src, dst FROM (
  SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS r FROM edges) WHERE r <= {LINKS})"""


def _edges(spark, sf_dir):
    return G.bipartite_edges(G.page_links(tables.pages(spark, sf_dir)))


@register("g2_page_links", f"""
WITH {EDGES_SQL.strip()}
SELECT src, dst FROM links""")
def g2_page_links(spark, sf_dir):
    return G.page_links(tables.pages(spark, sf_dir))


@register("w8_capped_links", f"""
WITH {EDGES_SQL.strip()}
SELECT src, dst FROM capped""")
def w8_capped_links(spark, sf_dir):
    return G.capped_edges(_edges(spark, sf_dir), LINKS)


@register("g1_bfs", f"""
WITH RECURSIVE {EDGES_SQL.strip()},
bfs(query_id, node, depth) AS (
  SELECT page_id, url, 0 FROM pages
  UNION
  SELECT b.query_id, c.dst, b.depth + 1 FROM bfs b JOIN capped c ON c.src = b.node WHERE b.depth < {DEPTH})
SELECT query_id, node, CAST(min(depth) AS BIGINT) AS depth FROM bfs GROUP BY 1, 2""")
def g1_bfs(spark, sf_dir):
    starts = tables.pages(spark, sf_dir).select(F.col("page_id").alias("query_id"), F.col("url").alias("node"))
    return G.bfs(starts, _edges(spark, sf_dir), DEPTH, LINKS)


@register("g3_merge_graphs", f"""
WITH a AS (SELECT trim({sql_html_text("regexp_extract(html, " + lit(H.TITLE) + ", 1)")}) AS title,
                  0 AS source, page_id AS ord, CAST(length({sql_html_text('html')}) AS BIGINT) AS text_len FROM pages),
b AS (SELECT coalesce(list_filter({sql_lines('text')}, lambda x: {sql_strip('x')} <> '')[1], '') AS title,
             1 AS source, doc_id AS ord, CAST(length(text) AS BIGINT) AS text_len FROM documents),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT title, CAST(source AS INTEGER) AS source, ord, text_len FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY source DESC, ord DESC) AS r FROM u) WHERE r = 1""")
def g3_merge_graphs(spark, sf_dir):
    pg = tables.pages(spark, sf_dir)
    a = pg.select(F.trim(H.html_title("html")).alias("title"), F.col("page_id").alias("ord"),
                  F.length(H.html_to_text("html")).cast("long").alias("text_len"))
    d = tables.documents(spark, sf_dir)
    b = d.select(T.title("text").alias("title"), F.col("doc_id").alias("ord"),
                 F.length("text").cast("long").alias("text_len"))
    return G.merge_graphs(a, b, key="title", order_col="ord").select("title", "source", "ord", "text_len")


PAGE_DOCS = f"page_docs AS (SELECT page_id AS doc_id, url, {sql_html_text('html')} AS text FROM pages)"


def _r13_sql() -> str:
    corpus = corpus_ctes("page_docs").strip()
    return f"""
WITH RECURSIVE {EDGES_SQL.strip()},
{PAGE_DOCS},
{corpus},
{query_ctes().strip()},{bm25_scores_cte('scores', P.k1, P.b)},{top_k_cte('stage1', 'scores', P.top_k)},
bfs(query_id, node, depth) AS (
  SELECT s.query_id, p.url, 0 FROM stage1 s JOIN page_docs p USING (doc_id)
  UNION
  SELECT b.query_id, c.dst, b.depth + 1 FROM bfs b JOIN capped c ON c.src = b.node WHERE b.depth < {DEPTH}),
cand AS (SELECT DISTINCT b.query_id, p.doc_id FROM bfs b JOIN page_docs p ON p.url = b.node),
{sql_vectors('page_docs', 'WHERE doc_id IN (SELECT doc_id FROM cand)')}{sql_passages('cand', P.top_k)}"""


@register("r13_graph_rerank", _r13_sql())
def r13_graph_rerank(spark, sf_dir):
    """Stage 1: BM25 over page texts; start nodes = urls of the hits; BFS over
    the page-href-page graph; passages of the reached pages ranked by vector
    distance to the query."""
    pg = tables.pages(spark, sf_dir)
    docs = pg.select(F.col("page_id").alias("doc_id"), F.col("url").alias("file"),
                     F.col("page_id").alias("entry_id"), H.html_to_text("html").alias("text"))
    queries = tables.benchmark_queries(spark, sf_dir).cache()
    nq = queries.count()
    s1 = S.search_bm25(queries, TM.SparseIndex(docs, "basic", P), P)
    starts = s1.join(pg.select(F.col("page_id").alias("doc_id"), F.col("url").alias("node")), "doc_id") \
               .select("query_id", "node")
    reached = G.bfs(starts, _edges(spark, sf_dir), DEPTH, LINKS)
    cand = reached.join(pg.select(F.col("url").alias("node"), F.col("page_id").alias("doc_id")), "node") \
                  .select("query_id", "doc_id").distinct()
    bound = nq * P.top_k * (1 + LINKS + LINKS ** 2)
    return RR.passage_search(queries, cand, docs, bound, P)
