"""Registered sampling and evaluation queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quarry.config import BOILERPLATE_MARKERS, DEFAULT
from quarry.operators import evaluate as EV
from quarry.operators import search as S
from quarry.operators import terms as TM
from quarry.plans.catalog import register
from quarry.plans.q_text import sql_strip
from quarry.plans.sql import (bm25_scores_cte, corpus_ctes, lit, qterms_cte, tfidf_scores_cte,
                              top_k_cte, uniform_sql)
from quarry.sources import tables

P = DEFAULT
SEED, N = P.seed, P.sample_size


def _docs(spark, sf_dir):
    return tables.documents(spark, sf_dir)


def _index(spark, sf_dir):
    return TM.SparseIndex(_docs(spark, sf_dir), "basic", P)


E1_CTE = f"""
e1_keys AS (SELECT doc_id, -ln({uniform_sql(str(SEED), 'doc_id')}) / ln(doc_len) AS k FROM lens WHERE doc_len > 1),
e1 AS (SELECT doc_id, CAST(row_number() OVER (ORDER BY k, doc_id) AS BIGINT) AS sample_rank
       FROM (SELECT * FROM e1_keys ORDER BY k, doc_id LIMIT {N}))"""

_BP = " OR ".join(f"contains(paragraph, {lit(m)})" for m in BOILERPLATE_MARKERS) or "false"
E2_CTE = f"""
e2_p AS (
  SELECT doc_id, CAST(generate_subscripts(ps, 1) - 1 AS BIGINT) AS para_no, unnest(ps) AS raw
  FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10) || chr(10)),
               lambda x: {sql_strip('x')}), lambda x: x <> '') AS ps FROM documents)),
e2_s AS (SELECT doc_id, para_no,
                regexp_replace(regexp_replace(raw, '\\{{\\{{[^\\n]*?\\}}\\}}', '', 'g'), '<[^\\n]*?>', '', 'g') AS paragraph
         FROM e2_p),
e2_w AS (SELECT *, CAST(CASE WHEN {_BP} THEN ceil(length(paragraph) * 0.01) ELSE length(paragraph) END AS DOUBLE) AS weight
         FROM e2_s),
e2_k AS (SELECT *, -ln({uniform_sql(str(SEED), 'doc_id', 'para_no')}) / weight AS k FROM e2_w WHERE weight > 0),
e2 AS (SELECT doc_id, para_no, paragraph FROM (
         SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k, para_no) AS r FROM e2_k) WHERE r = 1)"""


@register("e1_weighted_sample", f"WITH {corpus_ctes().strip()},{E1_CTE}\nSELECT doc_id, sample_rank FROM e1")
def e1_weighted_sample(spark, sf_dir):
    return EV.weighted_sample(TM.doc_lengths(_docs(spark, sf_dir).select("doc_id", "text")), N, SEED)


@register("e2_sample_paragraph", f"WITH {E2_CTE.strip()}\nSELECT doc_id, para_no, paragraph FROM e2")
def e2_sample_paragraph(spark, sf_dir):
    return EV.sample_paragraph(_docs(spark, sf_dir), SEED)


def _shared_index(spark, sf_dir, queries):
    """One pass over the text for both engines: the index restricted to the
    batch's words, reused by the BM25 and the TF-IDF search."""
    words = S.query_terms(queries).select("word").distinct().cache()
    return _index(spark, sf_dir).restrict(words, words.count())


TRUTH_CTE = """
truth AS (SELECT DISTINCT b.item_id AS query_id, d.doc_id
          FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""


@register("e4_known_item_truth", f"WITH {TRUTH_CTE.strip()}\nSELECT query_id, doc_id FROM truth")
def e4_known_item_truth(spark, sf_dir):
    return EV.known_item_truth(tables.benchmark_queries(spark, sf_dir), _docs(spark, sf_dir), P)


def _recall_sql(results: str) -> str:
    return f"""
SELECT CAST(count(*) AS BIGINT) AS n_queries,
       round(avg(CASE WHEN hit_rank <= 5 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_5,
       round(avg(CASE WHEN hit_rank <= 10 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_10,
       round(avg(CASE WHEN hit_rank <= 25 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_25,
       round(avg(CASE WHEN hit_rank IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS recall_at_all
FROM (SELECT t.query_id, min(r.rank) AS hit_rank
      FROM (SELECT DISTINCT query_id FROM truth) t
      LEFT JOIN (SELECT r.query_id, r.rank FROM {results} r JOIN truth x USING (query_id, doc_id)) r
      USING (query_id) GROUP BY t.query_id)"""


KNOWN_ITEM_SQL = (f"WITH {corpus_ctes().strip()},"
                  + qterms_cte("qterms", "SELECT item_id AS query_id, text AS query FROM benchmark") + ","
                  + bm25_scores_cte("bm", P.k1, P.b) + "," + tfidf_scores_cte("tf") + ","
                  + top_k_cte("bm_top", "bm", P.top_k) + "," + top_k_cte("tf_top", "tf", P.top_k) + ","
                  + TRUTH_CTE)


@register("e3_hit_positions", KNOWN_ITEM_SQL + """
SELECT t.query_id, min(r.rank) AS hit_rank
FROM (SELECT DISTINCT query_id FROM truth) t
LEFT JOIN (SELECT b.query_id, b.rank FROM bm_top b JOIN truth x USING (query_id, doc_id)) r USING (query_id)
GROUP BY t.query_id""")
def e3_hit_positions(spark, sf_dir):
    q = tables.benchmark_queries(spark, sf_dir)
    res = S.search_bm25(q, _index(spark, sf_dir), P)
    return EV.hit_positions(res, EV.known_item_truth(q, _docs(spark, sf_dir), P))


@register("e4_known_item_eval", KNOWN_ITEM_SQL + "\nSELECT 'bm25' AS engine, * FROM (" + _recall_sql("bm_top")
          + ")\nUNION ALL\nSELECT 'tfidf' AS engine, * FROM (" + _recall_sql("tf_top") + ")")
def e4_known_item_eval(spark, sf_dir):
    """E4 on the driver's benchmark: exact passages as queries, truth = the
    documents containing them, recall@5/10/25/all for BM25 and TF-IDF."""
    q = tables.benchmark_queries(spark, sf_dir).cache()
    idx = _shared_index(spark, sf_dir, q)
    truth = EV.known_item_truth(q, _docs(spark, sf_dir), P).cache()
    out = None
    for name, fn in (("bm25", S.search_bm25), ("tfidf", S.search_tfidf)):
        r = EV.recall(fn(q, idx, P), truth).select(F.lit(name).alias("engine"), "*")
        out = r if out is None else out.unionByName(r)
    return out


QUESTION_SQL = f"""
questions AS (SELECT e1.doc_id AS query_id, regexp_extract(e2.paragraph, '^[^.!?]*[.!?]?', 0) AS query
              FROM e1 JOIN e2 USING (doc_id))"""


@register("u5_generated_questions", f"WITH {corpus_ctes().strip()},{E1_CTE},{E2_CTE},{QUESTION_SQL}\n"
          "SELECT query_id, query FROM questions")
def u5_generated_questions(spark, sf_dir):
    """Through the plug-in: a stand-in model that asks with the first sentence."""
    return _questions(spark, sf_dir, lambda: lambda texts: [FIRST_SENTENCE.match(t)[0] for t in texts])


FIRST_SENTENCE = re.compile("[^.!?]*[.!?]?")


def _questions(spark, sf_dir, build=None):
    docs = _docs(spark, sf_dir)
    sample = EV.weighted_sample(TM.doc_lengths(_docs(spark, sf_dir).select("doc_id", "text")), N, SEED)
    para = EV.sample_paragraph(docs.join(sample.select("doc_id"), "doc_id", "left_semi"), SEED)
    asked = EV.generate_questions(para.select("doc_id", "paragraph"), "paragraph", build)
    return asked.select(F.col("doc_id").alias("query_id"), "query")


@register("e4_generated_question_eval", f"WITH {corpus_ctes().strip()},{E1_CTE},{E2_CTE},{QUESTION_SQL},"
          + qterms_cte("qterms", "SELECT query_id, query FROM questions") + ","
          + bm25_scores_cte("bm", P.k1, P.b) + "," + tfidf_scores_cte("tf") + ","
          + top_k_cte("bm_top", "bm", P.top_k) + "," + top_k_cte("tf_top", "tf", P.top_k) + ","
          + "\ntruth AS (SELECT query_id, query_id AS doc_id FROM questions)"
          + "\nSELECT 'bm25' AS engine, * FROM (" + _recall_sql("bm_top")
          + ")\nUNION ALL\nSELECT 'tfidf' AS engine, * FROM (" + _recall_sql("tf_top") + ")")
def e4_generated_question_eval(spark, sf_dir):
    """E1 -> E2 -> U5 -> search -> E3: the sampled document is the truth."""
    q = _questions(spark, sf_dir).cache()
    truth = q.select("query_id", F.col("query_id").alias("doc_id"))
    idx = _shared_index(spark, sf_dir, q)
    out = None
    for name, fn in (("bm25", S.search_bm25), ("tfidf", S.search_tfidf)):
        r = EV.recall(fn(q, idx, P), truth).select(F.lit(name).alias("engine"), "*")
        out = r if out is None else out.unionByName(r)
    return out


@register("e5_all_articles", """
SELECT DISTINCT d.source AS file, d.doc_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)""")
def e5_all_articles(spark, sf_dir):
    """E5 + J7 + O2 + O5: every article minus the exclusion list, distinct, sorted."""
    d = _docs(spark, sf_dir).select("file", "doc_id")
    return (d.join(tables.excluded_docs(spark, sf_dir), "doc_id", "left_anti")
             .distinct().orderBy("file", "doc_id"))


@register("e6_article_lengths", f"""
WITH {corpus_ctes().strip()}
SELECT l.doc_id, CAST(coalesce(n.doc_len, 0) AS BIGINT) AS doc_len
FROM labels l LEFT JOIN lens n USING (doc_id)""")
def e6_article_lengths(spark, sf_dir):
    """E6 + J14: lengths for a list of articles (the labelled ones), default 0."""
    lens = TM.doc_lengths(_docs(spark, sf_dir).select("doc_id", "text"))
    lst = tables.table(spark, sf_dir, "labels").select("doc_id")
    return lst.join(lens, "doc_id", "left").select("doc_id", F.coalesce("doc_len", F.lit(0)).cast("long").alias("doc_len"))
