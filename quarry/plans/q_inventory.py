"""One registered query per remaining inventory ID.

Operators that are already exercised inside a larger registered query get
their own key here too: either a query that isolates the operator, or the
same plan registered under the operator's ID (``alias``)."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from quarry.config import DEFAULT, MISSING_ARTICLE_TEXT
from quarry.functions import text as T
from quarry.functions.lemmas import EXCEPTIONS, RULES, noun_lemmas
from quarry.functions.vocab import read_map, update_map
from quarry.operators import chunk as C
from quarry.operators import dense as D
from quarry.operators import graph as G
from quarry.operators import search as S
from quarry.operators import terms as TM
from quarry.plans import sql_full as SF
from quarry.plans.catalog import REGISTRY, register
from quarry.plans.q_index import _batch, _few
from quarry.plans.q_chunk import sql_hash_tokens
from quarry.plans.q_dense import CENTROIDS_SQL, centroids
from quarry.plans.q_graph import EDGES_SQL
from quarry.plans.util import bounded_broadcast, partitions_for
from quarry.plans.sql import (bm25_scores_cte, corpus_ctes, lit, qterms_cte, query_ctes,
                              top_k_cte)
from quarry.session import scratch_path
from quarry.sources import docstore as DS
from quarry.sources import tables

P = DEFAULT
K = P.top_k
BENCH_Q = "SELECT item_id AS query_id, text AS query FROM benchmark"


def alias(new: str, old: str):
    e = REGISTRY[old]
    register(new, e.sql)(e.build)


for _new, _old in [
    ("f1_redirect_filter", "s1_article_scan"), ("f3_flatten_map", "s7_json_map_roundtrip"),
    ("f7_word_in_range", "j8_word_chunk_range"), ("f10_doc_idf_mass", "i5_weighted_doc_idf"),
    ("j6_oov_idf", "r2_query_vectors"), ("j9_text_after_topk", "r14_results_with_text"),
    ("j11_knn_join", "r9_knn_centroids"), ("j14_length_default", "e6_article_lengths"),
    ("w1_top_k", "r5_bm25_search"), ("w2_vector_limit", "r9_knn_centroids"),
    ("w3_result_order", "r4_tfidf_search"), ("w10_hit_position", "e3_hit_positions"),
    ("o1_or_union", "i2_or_candidates"), ("o5_distinct_sorted", "e5_all_articles"),
    ("o6_merge_last_wins", "g3_merge_graphs"), ("c4_low_level_split", "c5_recursive_chunks"),
    ("r11_passage_spans", "r12_rerank"),
]:
    alias(_new, _old)


def _docs(spark, sf_dir):
    return tables.documents(spark, sf_dir)


def _index(spark, sf_dir):
    return TM.SparseIndex(_docs(spark, sf_dir), "basic", P)


TOPK_SQL = (f"WITH {corpus_ctes().strip()}," + qterms_cte("qterms", BENCH_Q) + ","
            + bm25_scores_cte("bm", P.k1, P.b) + "," + top_k_cte("top", "bm", K))


@register("s12_text_lookup", TOPK_SQL + f""",
keys AS (SELECT t.query_id, t.rank, d.source AS file, t.doc_id FROM top t JOIN documents d USING (doc_id)
  UNION ALL SELECT item_id, 0, 'gone', -1 - item_id FROM benchmark)
SELECT k.query_id, k.rank, k.file, k.doc_id AS entry_id,
       coalesce(d.text, replace(replace({lit(MISSING_ARTICLE_TEXT)}, '{{id}}', CAST(k.doc_id AS VARCHAR)),
                                '{{path}}', k.file)) AS text
FROM keys k LEFT JOIN documents d ON d.doc_id = k.doc_id AND d.source = k.file""")
def s12_text_lookup(spark, sf_dir):
    """Text of (file, entry_id) keys in result order from the document store,
    default text when missing (one key per query has no article)."""
    q = tables.benchmark_queries(spark, sf_dir)
    nq = q.count()
    d = _docs(spark, sf_dir).select("file", F.col("doc_id").alias("entry_id"), "text")
    path = scratch_path(spark, f"documents-{uuid.uuid4().hex}")
    DS.build(d, path)
    top = S.search_bm25(q, _index(spark, sf_dir), P.with_(top_k=K)).select("query_id", "rank", F.col("doc_id").alias("entry_id")).persist()
    ids = bounded_broadcast(top.select("entry_id").distinct(), nq * K, P.broadcast_max_rows)
    known = d.select("file", "entry_id").join(ids, "entry_id", "left_semi")
    keys = top.join(known, "entry_id").select("query_id", "rank", "file", "entry_id").unionByName(
        q.select("query_id", F.lit(0).cast("long").alias("rank"), F.lit("gone").alias("file"), (-1 - F.col("query_id")).alias("entry_id")))
    j = keys.join(DS.lookup(spark, path, keys), ["file", "entry_id"], "left")
    default = F.replace(F.replace(F.lit(MISSING_ARTICLE_TEXT), F.lit("{id}"), F.col("entry_id").cast("string")),
                        F.lit("{path}"), F.col("file"))
    return j.select("query_id", "rank", "file", "entry_id", F.coalesce("text", default).alias("text"))


@register("f4_membership_filter", f"WITH {corpus_ctes().strip()},{query_ctes().strip()}" + """,
cand AS (SELECT DISTINCT q.query_id, t.doc_id FROM qterms q JOIN terms t USING (word))
SELECT c.query_id, t.doc_id, t.word, round(t.tf * i.idf, 6) AS tf_idf
FROM cand c JOIN terms t ON t.doc_id = c.doc_id JOIN qterms q ON q.query_id = c.query_id AND q.word = t.word
JOIN idf i ON i.word = t.word""")
def f4_membership_filter(spark, sf_dir):
    """Sparse-vector rows with word in the query AND doc among its candidates."""
    q = tables.benchmark_queries(spark, sf_dir)
    idx = _index(spark, sf_dir)
    qw = S.query_terms(q).select("query_id", "word")
    v = idx.vectors.select("doc_id", "word", "tf_idf")
    cand = qw.join(idx.terms.select("doc_id", "word"), "word").select("query_id", "doc_id").distinct()
    rows = qw.join(v, "word").join(cand, ["query_id", "doc_id"], "left_semi")
    return rows.select("query_id", "doc_id", "word", F.round("tf_idf", 6).alias("tf_idf"))


@register("f5_word_length_cap", f"""
WITH {corpus_ctes().strip()}
SELECT word, CAST(length(word) AS BIGINT) AS len FROM dfs WHERE length(word) <= {P.max_word_len}""")
def f5_word_length_cap(spark, sf_dir):
    return _index(spark, sf_dir).df.filter(F.length("word") <= P.max_word_len) \
               .select("word", F.length("word").cast("long").alias("len"))


@register("f6_char_bucket", f"""
WITH {corpus_ctes().strip()}
SELECT word, CASE WHEN regexp_matches(substr(word, 1, 1), '^[0-9a-z]$') THEN substr(word, 1, 1) ELSE 'other' END AS bucket,
       CASE WHEN regexp_matches(substr(word, 1, 1), '^[a-z]$') THEN substr(word, 1, 1) ELSE 'other' END AS alpha_bucket
FROM dfs""")
def f6_char_bucket(spark, sf_dir):
    return _index(spark, sf_dir).df.select("word", TM.first_char_bucket("word").alias("bucket"),
                                           TM.first_char_bucket("word", digits=False).alias("alpha_bucket"))


@register("f8_skip_empty", """
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_pieces, CAST(sum(CASE WHEN p = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_empty
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p FROM documents) GROUP BY doc_id""")
def f8_skip_empty(spark, sf_dir):
    p = _docs(spark, sf_dir).select("doc_id", F.explode(F.split("text", "\n")).alias("p"))
    return p.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pieces"),
                                   F.sum(F.when(F.col("p") == "", 1).otherwise(0)).cast("long").alias("n_empty"))


@register("f9_query_idf_filter", f"""
WITH {corpus_ctes().strip()},{query_ctes().strip()}
SELECT q.query_id, q.word, round(i.idf, 6) AS idf FROM qterms q JOIN idf i USING (word) WHERE i.idf < {P.word_idf_max}""")
def f9_query_idf_filter(spark, sf_dir):
    qw = S.query_weights(S.query_terms(tables.benchmark_queries(spark, sf_dir)), _index(spark, sf_dir))
    return qw.filter(F.col("idf") < P.word_idf_max).select("query_id", "word", F.round("idf", 6).alias("idf"))


_RULE_ROWS = ", ".join(f"({lit(x)}, {lit(y)})" for x, y in RULES)
_ODD_ROWS = ", ".join(f"({lit(x)}, {lit(y)})" for x, y in EXCEPTIONS.items())


@register("t9_lemmatize", f"""
WITH {corpus_ctes().strip()},
rules(tail, put) AS (VALUES {_RULE_ROWS}),
odd(word, cand) AS (VALUES {_ODD_ROWS}),
cands AS (
  SELECT word, 1 AS p, word AS cand FROM dfs
  UNION ALL SELECT word, 0, odd.cand FROM dfs JOIN odd USING (word)
  UNION ALL SELECT word, 1, cand FROM (
    SELECT word, substr(word, 1, length(word) - length(tail)) || put AS cand FROM dfs JOIN rules ON ends_with(word, tail)
    WHERE length(word) > 2 AND NOT ends_with(word, 'ss')) WHERE cand IN (SELECT word FROM dfs))
SELECT word, (list(cand ORDER BY p, length(cand), cand))[1] AS lemma FROM cands GROUP BY word""")
def t9_lemmatize(spark, sf_dir):
    """The vocabulary and its noun lemmas."""
    return noun_lemmas(_index(spark, sf_dir).df)


@register("a10_bm25_sum", f"WITH {corpus_ctes().strip()}," + qterms_cte("qterms", BENCH_Q) + ","
          + bm25_scores_cte("bm", P.k1, P.b) + "\nSELECT query_id, doc_id, score FROM bm")
def a10_bm25_sum(spark, sf_dir):
    return S.bm25_scores(tables.benchmark_queries(spark, sf_dir), _index(spark, sf_dir), P)


@register("a11_idf_mass", f"""
WITH {corpus_ctes().strip()},{query_ctes().strip()}
SELECT q.query_id, t.doc_id, round(sum(i.idf), 6) AS idf_mass
FROM qterms q JOIN terms t USING (word) JOIN idf i ON i.word = q.word GROUP BY 1, 2""")
def a11_idf_mass(spark, sf_dir):
    qt, n, idx = _batch(spark, sf_dir)
    qw = _few(qt.select("query_id", "word"), n)
    j = qw.join(idx.terms.select("doc_id", "word"), "word").join(_few(idx.idf, n), "word")
    return j.groupBy("query_id", "doc_id").agg(F.round(F.sum("idf"), 6).alias("idf_mass"))


@register("j1_doc_length_join", f"""
WITH {corpus_ctes().strip()}
SELECT t.doc_id, t.word, t.tf, l.doc_len FROM terms t LEFT JOIN lens l USING (doc_id)""")
def j1_doc_length_join(spark, sf_dir):
    idx = _index(spark, sf_dir)
    return idx.terms.select("doc_id", "word", "tf").join(idx.lengths, "doc_id", "left") \
                    .select("doc_id", "word", "tf", "doc_len")


@register("j2_idf_join", f"""
WITH {corpus_ctes().strip()}
SELECT t.doc_id, t.word, round(i.idf, 6) AS idf FROM terms t LEFT JOIN idf i USING (word)""")
def j2_idf_join(spark, sf_dir):
    idx = _index(spark, sf_dir)
    return idx.terms.select("doc_id", "word").join(idx.idf, "word", "left") \
                    .select("doc_id", "word", F.round("idf", 6).alias("idf"))


@register("j7_valid_docs", """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def j7_valid_docs(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id").join(tables.excluded_docs(spark, sf_dir), "doc_id", "left_anti")


@register("o2_difference", """
SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels WHERE toxic = 1""")
def o2_difference(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id").exceptAll(tables.excluded_docs(spark, sf_dir))


@register("o4_append_union", f"""
WITH qs AS (SELECT 'benchmark' AS batch, item_id AS query_id, text AS query FROM benchmark
            UNION ALL
            SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations WHERE role = 'user')
SELECT batch, query_id, CAST(length(query) AS BIGINT) AS n_chars FROM qs""")
def o4_append_union(spark, sf_dir):
    b = tables.benchmark_queries(spark, sf_dir).withColumn("batch", F.lit("benchmark"))
    c = tables.conversation_queries(spark, sf_dir).withColumn("batch", F.lit("conversations"))
    u = b.unionByName(c)
    return u.select("batch", "query_id", F.length("query").cast("long").alias("n_chars"))


@register("j12_bfs_step", f"""
WITH {EDGES_SQL.strip()}
SELECT DISTINCT p.page_id AS query_id, c.dst AS node FROM pages p JOIN capped c ON c.src = p.url
WHERE c.dst <> p.url""")
def j12_bfs_step(spark, sf_dir):
    """One BFS level from every page: capped neighbours minus the visited start."""
    pg = tables.pages(spark, sf_dir)
    edges = G.capped_edges(G.bipartite_edges(G.page_links(pg)), P.links_per_page)
    starts = pg.select(F.col("page_id").alias("query_id"), F.col("url").alias("node"))
    nxt = starts.join(edges, starts.node == edges.src).select("query_id", F.col("dst").alias("node")).distinct()
    return nxt.join(starts, ["query_id", "node"], "left_anti")


@register("c6_padding", f"""
WITH pieces AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS piece FROM documents),
tok AS (SELECT doc_id, {sql_hash_tokens('piece')} AS toks FROM pieces WHERE piece <> ''),
w AS (SELECT doc_id, toks, unnest(generate_series(0, greatest(len(toks) - {P.overlap} - 1, 0),
                                                  {P.context_length - P.overlap})) AS start FROM tok)
SELECT doc_id, CAST(start AS BIGINT) AS start,
       CAST({P.context_length} - len(list_slice(toks, start + 1, start + {P.context_length})) AS BIGINT) AS n_pad
FROM w""")
def c6_padding(spark, sf_dir):
    """Padding added to each window (context length minus real tokens)."""
    pieces = C.split_pieces(_docs(spark, sf_dir).select("doc_id", "text"), "\n\n")
    t = pieces.select("doc_id", C.hash_tokenizer(F.col("piece")).alias("toks"))
    w = t.select("doc_id", "toks", F.explode(C.windows(F.col("toks"), P.context_length, P.overlap)).alias("start"))
    chunk = F.slice("toks", F.col("start") + 1, F.lit(P.context_length))
    return w.select("doc_id", F.col("start").cast("long"),
                    (F.lit(P.context_length) - F.size(chunk)).cast("long").alias("n_pad"))


@register("u4_tokenizer_plugin", f"""
SELECT doc_id, {sql_hash_tokens('text')} AS tokens FROM documents""")
def u4_tokenizer_plugin(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", C.hash_tokenizer(F.col("text")).alias("tokens"))


@register("u2_vocabulary_map", SF.MAP_SQL)
def u2_vocabulary_map(spark, sf_dir):
    """Every distinct raw token of the corpus and the words it becomes, as a
    stored map: built from some sources, brought up to date with all, and then
    found to need nothing."""
    docs = _docs(spark, sf_dir)
    mine = docs.repartition(partitions_for(spark, docs.count(), TM.DOCS_PER_TASK), "doc_id")
    # the text is cut into tokens once for the three runs
    docs = mine.select("file", F.explode(T.raw_tokens("text")).alias("token")).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    path = scratch_path(spark, f"vocabulary-{uuid.uuid4().hex}")
    update_map(docs.filter(F.crc32(F.col("file").cast("binary")) % 2 == 0), path)
    update_map(docs, path)
    assert update_map(docs, path) == 0, "a map that is up to date gets no token"
    return read_map(spark, path)


@register("r10_candidate_restriction", f"""
WITH {CENTROIDS_SQL.strip()},
d AS (SELECT e.label AS query_id, e.vec_id,
             round(list_sum(list_transform(list_zip(e.v, cen.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS distance
      FROM e JOIN cen USING (label))
SELECT query_id, rank, vec_id, distance FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS BIGINT) AS rank FROM d)
WHERE rank <= {K}""")
def r10_candidate_restriction(spark, sf_dir):
    """kNN where each query (a label centroid) may only match its own
    candidates (the vectors of that label): one candidate pair per vector."""
    e = tables.embeddings(spark, sf_dir).select("vec_id", F.col("label").cast("long").alias("query_id"),
                                                F.col("embedding").alias("vector"))
    c = centroids(spark, sf_dir).withColumnRenamed("vector", "qvec")
    pairs = e.join(F.broadcast(c), "query_id")   # one centroid row per label
    top = D.knn_candidates(pairs, K, key=("vec_id",))
    return top.select("query_id", "rank", "vec_id", "distance")


