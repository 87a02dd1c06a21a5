"""Registered term-statistics queries (A*, J1, J2, J7, R1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.operators import terms as TM
from quarry.plans.catalog import register
from quarry.plans.sql import bm25, corpus_ctes
from quarry.sources import tables

P = DEFAULT


def _index(spark, sf_dir):
    return TM.SparseIndex(tables.documents(spark, sf_dir), "basic", P)


@register("a1_term_frequency", f"""
WITH {corpus_ctes().strip()}
SELECT doc_id, word, tf FROM terms""")
def a1_term_frequency(spark, sf_dir):
    return _index(spark, sf_dir).terms.select("doc_id", "word", "tf")


@register("a2_document_frequency", f"""
WITH {corpus_ctes().strip()}
SELECT word, num_docs FROM dfs""")
def a2_document_frequency(spark, sf_dir):
    return _index(spark, sf_dir).df


@register("a4_document_length", f"""
WITH {corpus_ctes().strip()}
SELECT doc_id, doc_len FROM lens""")
def a4_document_length(spark, sf_dir):
    return TM.doc_lengths(tables.documents(spark, sf_dir).select("doc_id", "text"))


@register("a5_corpus_stats", f"""
WITH {corpus_ctes().strip()}
SELECT corpus_size, round(avg_doc_len, 6) AS avg_doc_len FROM stats""")
def a5_corpus_stats(spark, sf_dir):
    s = TM.corpus_stats(TM.doc_lengths(tables.documents(spark, sf_dir).select("doc_id", "text")))
    return s.select("corpus_size", F.round("avg_doc_len", 6).alias("avg_doc_len"))


@register("a6_distinct_documents", f"""
WITH {corpus_ctes().strip()}
SELECT CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs FROM terms""")
def a6_distinct_documents(spark, sf_dir):
    return _index(spark, sf_dir).terms.agg(F.countDistinct("doc_id").alias("n_docs"))


@register("a7_idf", f"""
WITH {corpus_ctes().strip()}
SELECT word, round(idf, 6) AS idf FROM idf""")
def a7_idf(spark, sf_dir):
    return _index(spark, sf_dir).idf.select("word", F.round("idf", 6).alias("idf"))


@register("r1_sparse_vectors", f"""
WITH {corpus_ctes().strip()}
SELECT t.doc_id, t.word, t.tf, t.doc_len, round(i.idf, 6) AS idf,
       round(t.tf * i.idf, 6) AS tf_idf,
       round({bm25('t.tf', 'i.idf', 't.doc_len', 's.avg_doc_len', P.k1, P.b)}, 6) AS bm25
FROM terms t LEFT JOIN idf i USING (word) CROSS JOIN stats s""")
def r1_sparse_vectors(spark, sf_dir):
    v = _index(spark, sf_dir).vectors
    return v.select("doc_id", "word", "tf", "doc_len", F.round("idf", 6).alias("idf"),
                    F.round("tf_idf", 6).alias("tf_idf"), F.round("bm25", 6).alias("bm25"))
