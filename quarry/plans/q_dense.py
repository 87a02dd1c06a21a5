"""Registered dense-vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.functions import html as H
from quarry.functions import text as T
from quarry.operators import dense as D
from quarry.operators import rerank as RR
from quarry.operators import terms as TM
from quarry.plans.catalog import register
from quarry.plans.q_chunk import sql_direct, sql_hash_tokens
from quarry.plans.q_text import sql_html_text, sql_lines, sql_strip
from quarry.plans.sql import bm25_scores_sql, lit, top_k_cte
from quarry.sources import tables

P = DEFAULT
K = P.top_k

CENTROIDS_SQL = """
e AS (SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
el AS (SELECT label, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM e),
cen AS (SELECT label, list(ax ORDER BY pos) AS c
        FROM (SELECT label, pos, avg(x) AS ax FROM el GROUP BY 1, 2) GROUP BY 1)"""


def centroids(spark, sf_dir):
    """Per-label mean vector: ``query_id (= label), vector``."""
    e = tables.embeddings(spark, sf_dir)
    per_dim = (e.select(F.col("label").cast("long").alias("label"), F.posexplode("embedding").alias("pos", "x"))
                .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("ax")))
    return (per_dim.groupBy("label")
                   .agg(F.sort_array(F.collect_list(F.struct("pos", "ax"))).alias("s"))
                   .select(F.col("label").alias("query_id"), F.transform("s", lambda t: t["ax"]).alias("vector")))


@register("r9_knn_centroids", f"""
WITH {CENTROIDS_SQL.strip()},
d AS (SELECT cen.label AS query_id, e.vec_id,
             round(list_sum(list_transform(list_zip(e.v, cen.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS distance
      FROM e CROSS JOIN cen)
SELECT query_id, rank, vec_id, distance FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS BIGINT) AS rank FROM d)
WHERE rank <= {K}""")
def r9_knn_centroids(spark, sf_dir):
    items = tables.embeddings(spark, sf_dir).select("vec_id", F.col("embedding").alias("vector"))
    return D.knn_exact(items, centroids(spark, sf_dir), K, P, item_key="vec_id")


@register("r3_cosine_dense", f"""
WITH {CENTROIDS_SQL.strip()}
SELECT e.vec_id, e.label, round(list_cosine_similarity(e.v, cen.c), 6) AS cos
FROM e JOIN cen USING (label)""")
def r3_cosine_dense(spark, sf_dir):
    e = tables.embeddings(spark, sf_dir).select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    c = centroids(spark, sf_dir).withColumnRenamed("query_id", "label")
    # one centroid row per label: bounded by the label count
    j = e.join(F.broadcast(c), "label")
    return j.select("vec_id", "label", F.round(D.cosine(F.col("embedding"), F.col("vector")), 6).alias("cos"))


def sql_hashed(tokens: str, positions: str) -> str:
    """Signed feature hashing of a list of token ids; ``positions`` divides."""
    codes = (f"list_transform(list_filter({tokens}, lambda t: t <> {P.pad_token_id}), lambda t: "
             f"CAST(('0x' || substr(md5(CAST(t AS VARCHAR)), 1, 8)) AS BIGINT) % {2 * P.dims})")
    return (f"list_transform(range({P.dims}), lambda i: CAST((len(list_filter({codes}, lambda c: c = 2 * i + 1)) - "
            f"len(list_filter({codes}, lambda c: c = 2 * i))) / {positions} AS FLOAT))")


BREAK = "chr(10) || chr(10)"


def sql_vectors(source: str = "documents", having: str = "") -> str:
    """CTEs through ``vecs(doc_id, piece_no, win_no, text_idx, text_len, vector)``."""
    direct = sql_direct(BREAK).replace("FROM documents", f"FROM {source}").split("WITH ", 1)[1]
    return f"""{direct},
vecs AS (SELECT doc_id, piece_no, win_no, text_idx, text_len, {sql_hashed('ch', f'{P.context_length}.0')} AS vector
         FROM chunks {having})"""


VECTORS = "SELECT doc_id, piece_no, win_no, text_idx, text_len, vector FROM vecs"
CHUNK_VECTORS_SQL = f"WITH {sql_vectors()}\n{VECTORS}"


def sql_passages(candidates: str, k: int) -> str:
    """CTEs and the final select of passages near each query among ``candidates``."""
    return f""",
qvec AS (SELECT query_id, {sql_hashed('toks', f'greatest(len(toks), {P.context_length}.0)')} AS qv
         FROM (SELECT item_id AS query_id, {sql_hash_tokens('text')} AS toks FROM benchmark)),
dist AS (
  SELECT c.query_id, v.*, round(list_sum(list_transform(list_zip(q.qv, v.vector), lambda p:
           (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))), 6) AS distance
  FROM {candidates} c JOIN vecs v USING (doc_id) JOIN qvec q USING (query_id))
SELECT query_id, rank, doc_id, piece_no, win_no, text_idx AS span_start, text_idx + text_len AS span_end, distance FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id, piece_no, win_no) AS BIGINT) AS rank
  FROM dist) WHERE rank <= {k}"""


@register("r7_embed_chunks", CHUNK_VECTORS_SQL)
def r7_embed_chunks(spark, sf_dir):
    return RR.embed_chunks(tables.documents(spark, sf_dir).select("doc_id", "text"), P)


@register("u3_embedding_plugin", CHUNK_VECTORS_SQL)
def u3_embedding_plugin(spark, sf_dir):
    """The plug-in path: a model built once per worker, fed Arrow batches. The
    stand-in computes the hashed vectors in numpy."""
    docs = tables.documents(spark, sf_dir).select("doc_id", "text")
    return RR.embed_chunks(docs, P, lambda: D.hashing_fn(P.dims, P.pad_token_id))


SUMMARIES_SQL = f"""
heads AS (SELECT page_id AS doc_id, {sql_html_text('html')} AS body,
                 trim({sql_html_text("regexp_extract(html, " + lit(H.TITLE) + ", 1)")}) AS title FROM pages),
summaries AS (
  SELECT doc_id, coalesce(list_filter(
           list_transform(list_slice(ls, coalesce(list_position(ls, title), 0) + 1, len(ls)), lambda x: {sql_strip('x')}),
           lambda x: x <> '' AND x <> title)[1], title) AS text
  FROM (SELECT doc_id, title, {sql_lines('body')} AS ls FROM heads))"""


@register("r8_summary_vectors", f"WITH {SUMMARIES_SQL.strip()},\n{sql_vectors('summaries')}\n{VECTORS}")
def r8_summary_vectors(spark, sf_dir):
    """First paragraph of each page (after its title) -> chunks -> vectors."""
    pg = tables.pages(spark, sf_dir)
    txt = pg.select(F.col("page_id").alias("doc_id"), H.html_to_text("html").alias("body"),
                    F.trim(H.html_title("html")).alias("title"))
    summ = txt.select("doc_id", T.first_paragraph("body", "title").alias("text"))
    return RR.embed_chunks(summ, P)


STAGE1 = 50


@register("r12_rerank", bm25_scores_sql(P.k1, P.b) + "," + top_k_cte("stage1", "scores", STAGE1) + ",\n"
          + sql_vectors(having="WHERE doc_id IN (SELECT doc_id FROM stage1)") + sql_passages("stage1", K))
def r12_rerank(spark, sf_dir):
    docs = tables.documents(spark, sf_dir)
    idx = TM.SparseIndex(docs, "basic", P)
    return RR.rerank(tables.benchmark_queries(spark, sf_dir), docs, idx, P.with_(top_k=K), stage1_k=STAGE1)


def _items(spark, sf_dir):
    return tables.embeddings(spark, sf_dir).select("vec_id", F.col("embedding").alias("vector"))


@register("r9_knn_lsh")
def r9_knn_lsh(spark, sf_dir):
    """Approximate kNN of the label centroids through LSH buckets."""
    return D.knn_lsh(_items(spark, sf_dir), centroids(spark, sf_dir), K, P, item_key="vec_id")


@register("r9_lsh_recall")
def r9_lsh_recall(spark, sf_dir):
    """Recall@K of the LSH result against the exact one, per query."""
    c = centroids(spark, sf_dir).cache()
    exact = D.knn_exact(_items(spark, sf_dir), c, K, P, item_key="vec_id").select("query_id", "vec_id")
    approx = D.knn_lsh(_items(spark, sf_dir), c, K, P, item_key="vec_id").select("query_id", "vec_id")
    hit = exact.join(approx, ["query_id", "vec_id"], "left_semi").groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"))
    return (exact.select("query_id").distinct().join(hit, "query_id", "left")
                 .select("query_id", (F.coalesce("hits", F.lit(0)) / K).alias("recall_at_k")))
