"""Registered queries for the remaining scans, filters, joins and search
variants (S1, S5, S12, S13, S15, F1, F2, F11, F12, F14, A3, A8, A12, A13,
A16, J5, J10, J13, O3, I7, R2, R6, R14, W9, T8, T10, full-profile search)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.functions import html as H
from quarry.functions import text as T
from quarry.functions.numwords import spelt, spelt_sql
from quarry.functions.vocab import read_map, update_map
from quarry.operators import search as S
from quarry.operators import terms as TM
from quarry.plans import sql_full as SF
from quarry.plans.catalog import register
from quarry.plans.q_index import CHUNK_WORDS, CHUNKS_CTE, BUCKET_SQL, _batch, _few
from quarry.plans.q_text import sql_html_text, sql_lines, sql_strip
from quarry.plans.sql import (bm25_scores_cte, corpus_ctes, lit, qterms_cte, query_ctes,
                              tfidf_scores_cte, top_k_cte, top_k_sql)
from quarry.plans.util import partitions_for
from quarry.session import scratch_path
from quarry.sources import docstore as DS
from quarry.sources import tables

P = DEFAULT
K = P.top_k
REDIRECT = '(?i)<meta[^>]*http-equiv="?refresh'
KEY_RE = "^(.*\\.zim)(.*)$"


def _docs(spark, sf_dir):
    return tables.documents(spark, sf_dir)


def _index(spark, sf_dir):
    return TM.SparseIndex(_docs(spark, sf_dir), "basic", P)


# ---- scans and filters --------------------------------------------------------------

TITLE_SQL = f"trim({sql_html_text('regexp_extract(html, ' + lit(H.TITLE) + ', 1)')})"


@register("s1_article_scan", f"""
SELECT page_id, url, title FROM (
  SELECT page_id, url, nullif({TITLE_SQL}, '') AS title,
         regexp_matches(html, {lit(REDIRECT)}) AS is_redirect FROM pages)
WHERE NOT is_redirect AND coalesce(title <> 'null', true)""")
def s1_article_scan(spark, sf_dir):
    """S1 + F1: real articles only (not a redirect, title not the string 'null')."""
    pg = tables.pages(spark, sf_dir)
    a = pg.select("page_id", "url", F.nullif(F.trim(H.html_title("html")), F.lit("")).alias("title"),
                  F.col("html").rlike(REDIRECT).alias("is_redirect"))
    return a.filter(~F.col("is_redirect") & F.coalesce(F.col("title") != "null", F.lit(True))) \
            .select("page_id", "url", "title")


@register("f2_path_filter", f"""
SELECT page_id, url FROM pages
WHERE NOT regexp_matches(html, {lit(REDIRECT)}) AND coalesce(url <> 'null', true)""")
def f2_path_filter(spark, sf_dir):
    pg = tables.pages(spark, sf_dir)
    return pg.filter(~F.col("html").rlike(REDIRECT) & F.coalesce(F.col("url") != "null", F.lit(True))) \
             .select("page_id", "url")


@register("s5_parquet_read", "SELECT doc_id, lang, source, n_chars FROM documents")
def s5_parquet_read(spark, sf_dir):
    """Column-pruned scan of the whole table."""
    return tables.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


KEYS_SQL = "SELECT source || '.zim' || CAST(doc_id AS VARCHAR) AS key FROM documents"


@register("f12_key_split", f"""
SELECT key, regexp_extract(key, {lit(KEY_RE)}, 1) AS file,
       TRY_CAST(regexp_extract(key, {lit(KEY_RE)}, 2) AS BIGINT) AS entry_id
FROM ({KEYS_SQL})""")
def f12_key_split(spark, sf_dir):
    k = _docs(spark, sf_dir).select(F.concat("file", F.lit(".zim"), F.col("doc_id").cast("string")).alias("key"))
    return k.select("key", F.regexp_extract("key", KEY_RE, 1).alias("file"),
                    F.regexp_extract("key", KEY_RE, 2).try_cast("long").alias("entry_id"))


@register("s13_bulk_lookup", f"""
WITH keys AS ({KEYS_SQL} UNION ALL SELECT url AS key FROM pages),
split AS (SELECT key, regexp_extract(key, {lit(KEY_RE)}, 1) AS file,
                 TRY_CAST(regexp_extract(key, {lit(KEY_RE)}, 2) AS BIGINT) AS entry_id FROM keys)
SELECT s.key, coalesce(d.source, '') AS file, coalesce(CAST(d.doc_id AS VARCHAR), '') AS entry,
       coalesce(list_filter({sql_lines('d.text')}, lambda x: {sql_strip('x')} <> '')[1], '') AS title
FROM split s LEFT JOIN documents d ON d.source || '.zim' = s.file AND d.doc_id = s.entry_id""")
def s13_bulk_lookup(spark, sf_dir):
    """S13 + F12 + S12: keys -> (file, entry, title) from the document store;
    malformed keys get ''."""
    d = _docs(spark, sf_dir)
    path = scratch_path(spark, f"documents-{uuid.uuid4().hex}")
    DS.build(d.select("file", "entry_id", "doc_id", "text"), path)
    keys = d.select(F.concat("file", F.lit(".zim"), F.col("doc_id").cast("string")).alias("key")) \
            .unionByName(tables.pages(spark, sf_dir).select(F.col("url").alias("key")))
    split = keys.select("key", F.regexp_replace(F.regexp_extract("key", KEY_RE, 1), "[.]zim$", "").alias("file"),
                        F.regexp_extract("key", KEY_RE, 2).try_cast("long").alias("entry_id"))
    found = DS.lookup(spark, path, split).select("file", "entry_id", "doc_id", F.lit(True).alias("hit"), T.title("text").alias("title"))
    j = split.join(found, ["file", "entry_id"], "left")
    return j.select("key", F.when(F.col("hit"), F.col("file")).otherwise("").alias("file"),
                    F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("entry"),
                    F.coalesce("title", F.lit("")).alias("title"))


@register("s15_latest_release", """
SELECT regexp_extract(url, '^[a-z]+://([^/]+)/', 1) AS target, max(url) AS latest
FROM pages WHERE contains(url, '/') GROUP BY 1""")
def s15_latest_release(spark, sf_dir):
    """Latest (lexicographically greatest) name per target."""
    pg = tables.pages(spark, sf_dir)
    return (pg.filter(F.col("url").contains("/"))
              .groupBy(F.regexp_extract("url", "^[a-z]+://([^/]+)/", 1).alias("target"))
              .agg(F.max("url").alias("latest")))


# ---- aggregates ----------------------------------------------------------------------

MERGE_BLOCK = 512


@register("a3_merge_partial_counts", f"""
WITH {corpus_ctes().strip()}
SELECT word, CAST(floor(doc_id / {MERGE_BLOCK}) AS BIGINT) AS block, CAST(sum(tf) AS BIGINT) AS total_tf,
       CAST(count(*) AS BIGINT) AS num_docs, list(doc_id ORDER BY doc_id) AS docs, list(tf ORDER BY doc_id) AS tfs
FROM terms GROUP BY 1, 2""")
def a3_merge_partial_counts(spark, sf_dir):
    """Per-file partial maps of words to counts, documents and vectors,
    merged across files: counts add up, maps unite, vectors are put together
    document by document."""
    d = _docs(spark, sf_dir)
    t = _index(spark, sf_dir).terms.join(d.select("doc_id", "file"), "doc_id")
    return TM.merge_maps(TM.partial_maps(t, MERGE_BLOCK)).select("word", "block", "total_tf", "num_docs", "docs", "tfs")


@register("a8_first_per_group", f"""
WITH {corpus_ctes().strip()}
SELECT doc_id, max(doc_len) AS doc_len FROM terms GROUP BY doc_id""")
def a8_first_per_group(spark, sf_dir):
    return _index(spark, sf_dir).vectors.groupBy("doc_id").agg(F.max("doc_len").alias("doc_len"))


@register("a13_exclusions_per_file", """
SELECT d.source AS file, CAST(count(*) AS BIGINT) AS n_excluded
FROM documents d JOIN labels l ON l.doc_id = d.doc_id AND l.toxic = 1 GROUP BY 1""")
def a13_exclusions_per_file(spark, sf_dir):
    ex = tables.excluded_docs(spark, sf_dir)
    return _docs(spark, sf_dir).join(ex, "doc_id", "left_semi").groupBy("file") \
                               .agg(F.count(F.lit(1)).alias("n_excluded"))


@register("j13_exclusion_keys", """
SELECT d.source AS file, d.source || '.zim' || CAST(d.doc_id AS VARCHAR) AS key
FROM documents d JOIN labels l ON l.doc_id = d.doc_id AND l.toxic = 1""")
def j13_exclusion_keys(spark, sf_dir):
    ex = tables.excluded_docs(spark, sf_dir)
    d = _docs(spark, sf_dir).join(ex, "doc_id", "left_semi")
    return d.select("file", F.concat("file", F.lit(".zim"), F.col("doc_id").cast("string")).alias("key"))


@register("a16_normalised_tf", f"""
WITH {corpus_ctes().strip()}
SELECT doc_id, word, round(tf / doc_len, 6) AS ntf FROM terms""")
def a16_normalised_tf(spark, sf_dir):
    t = TM.normalised_tf(_index(spark, sf_dir).terms)
    return t.select("doc_id", "word", F.round("ntf", 6).alias("ntf"))


# ---- joins / set operations ------------------------------------------------------------

@register("j10_resume_anti", """
SELECT d.source AS file, d.doc_id AS entry_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def j10_resume_anti(spark, sf_dir):
    """Entries not yet processed (processed = present in ``labels``)."""
    done = tables.table(spark, sf_dir, "labels").select("doc_id")
    return _docs(spark, sf_dir).join(done, "doc_id", "left_anti").select("file", F.col("doc_id").alias("entry_id"))


@register("o3_intersection", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def o3_intersection(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id").intersect(tables.table(spark, sf_dir, "labels").select("doc_id"))


@register("w9_idf_dedup", f"""
WITH {corpus_ctes().strip()}
SELECT word, round(idf, 6) AS idf FROM idf""")
def w9_idf_dedup(spark, sf_dir):
    """IDF rows read from two copies, deduplicated on word (values are equal per word)."""
    i = _index(spark, sf_dir).idf
    return i.unionByName(i).dropDuplicates(["word"]).select("word", F.round("idf", 6).alias("idf"))


# ---- search variants -----------------------------------------------------------------------

BENCH_Q = "SELECT item_id AS query_id, text AS query FROM benchmark"


@register("r2_query_vectors", f"""
WITH {corpus_ctes().strip()},{query_ctes().strip()}
SELECT q.query_id, q.word, q.qtf, round(coalesce(i.idf, ln(2 * s.corpus_size + 1)), 6) AS idf,
       round(q.qtf * coalesce(i.idf, ln(2 * s.corpus_size + 1)), 6) AS qw
FROM qterms q LEFT JOIN idf i USING (word) CROSS JOIN stats s""")
def r2_query_vectors(spark, sf_dir):
    qw = S.query_weights(S.query_terms(tables.benchmark_queries(spark, sf_dir)), _index(spark, sf_dir))
    return qw.select("query_id", "word", "qtf", F.round("idf", 6).alias("idf"), F.round("qw", 6).alias("qw"))


@register("r6_bm25_recompute", f"WITH {corpus_ctes().strip()}," + qterms_cte("qterms", BENCH_Q)
          + "," + bm25_scores_cte("bm", 1.0, 0.0) + "," + top_k_cte("top", "bm", P.top_k)
          + "\nSELECT query_id, rank, doc_id, score FROM top")
def r6_bm25_recompute(spark, sf_dir):
    """BM25 with k1/b other than the stored index's (1.2/0.75): recomputed."""
    return S.search_bm25(tables.benchmark_queries(spark, sf_dir), _index(spark, sf_dir), P.with_(k1=1.0, b=0.0))


@register("r5_bm25_conversations", f"WITH {corpus_ctes().strip()}," + qterms_cte(
    "qterms", "SELECT conv_id * 1000 + turn AS query_id, text AS query FROM conversations WHERE role = 'user'")
          + "," + bm25_scores_cte("bm", P.k1, P.b) + "," + top_k_cte("top", "bm", K)
          + "\nSELECT query_id, rank, doc_id, score FROM top")
def r5_bm25_conversations(spark, sf_dir):
    """The second query batch: every user turn of the conversations."""
    return S.search_bm25(tables.conversation_queries(spark, sf_dir), _index(spark, sf_dir), P.with_(top_k=K))


@register("f11_similarity_threshold", f"WITH {corpus_ctes().strip()}," + qterms_cte("qterms", BENCH_Q)
          + "," + tfidf_scores_cte("tf") + ", thr AS (SELECT * FROM tf WHERE score >= 0.5),"
          + top_k_cte("top", "thr", P.top_k) + "\nSELECT query_id, rank, doc_id, score FROM top")
def f11_similarity_threshold(spark, sf_dir):
    return S.search_tfidf(tables.benchmark_queries(spark, sf_dir), _index(spark, sf_dir), P.with_(srt=0.5))


@register("r14_results_with_text", f"WITH {corpus_ctes().strip()}," + qterms_cte("qterms", BENCH_Q)
          + "," + bm25_scores_cte("bm", P.k1, P.b) + "," + top_k_cte("top", "bm", K) + """
SELECT t.query_id, t.rank, t.doc_id, t.score, d.source AS file, d.doc_id AS entry_id,
       CAST(0 AS BIGINT) AS span_start, CAST(length(d.text) AS BIGINT) AS span_end, d.text
FROM top t LEFT JOIN documents d USING (doc_id)""")
def r14_results_with_text(spark, sf_dir):
    q = tables.benchmark_queries(spark, sf_dir)
    nq = q.count()
    res = S.search_bm25(q, _index(spark, sf_dir), P.with_(top_k=K))
    return S.attach_text(res, _docs(spark, sf_dir), P, bound_rows=nq * K)


@register("f14_group_by_file", f"WITH {corpus_ctes().strip()}," + qterms_cte("qterms", BENCH_Q)
          + "," + bm25_scores_cte("bm", P.k1, P.b) + "," + top_k_cte("top", "bm", K) + """
SELECT t.query_id, d.source AS file, list(d.doc_id ORDER BY d.doc_id) AS entry_ids
FROM top t JOIN documents d USING (doc_id) GROUP BY 1, 2""")
def f14_group_by_file(spark, sf_dir):
    """Top-k results grouped per file (each list bounded by k)."""
    q = tables.benchmark_queries(spark, sf_dir)
    nq = q.count()
    res = S.attach_text(S.search_bm25(q, _index(spark, sf_dir), P.with_(top_k=K)),
                        _docs(spark, sf_dir), P, bound_rows=nq * K)
    return res.groupBy("query_id", "file").agg(F.sort_array(F.collect_list("entry_id")).alias("entry_ids"))


@register("a12_aligned_vectors", f"WITH {corpus_ctes().strip()}," + qterms_cte("qterms", BENCH_Q)
          + "," + bm25_scores_cte("bm", P.k1, P.b) + "," + top_k_cte("top", "bm", K) + """
SELECT t.query_id, t.doc_id,
       list(round(coalesce(x.tf * i.idf, 0.0), 6) ORDER BY q.word) AS vector
FROM top t JOIN qterms q USING (query_id)
LEFT JOIN terms x ON x.doc_id = t.doc_id AND x.word = q.word
LEFT JOIN idf i ON i.word = q.word
GROUP BY 1, 2""")
def a12_aligned_vectors(spark, sf_dir):
    """Per (query, top doc): tf-idf over the sorted query words, 0.0 if absent."""
    q = tables.benchmark_queries(spark, sf_dir)
    idx = _index(spark, sf_dir)
    top = S.search_bm25(q, idx, P.with_(top_k=K)).select("query_id", "doc_id")
    qt = S.query_terms(q).select("query_id", "word")
    grid = top.join(qt, "query_id")      # bounded: k docs x query words per query
    v = (grid.join(idx.vectors.select("doc_id", "word", "tf_idf"), ["doc_id", "word"], "left")
             .select("query_id", "doc_id", "word", F.round(F.coalesce("tf_idf", F.lit(0.0)), 6).alias("v")))
    return v.groupBy("query_id", "doc_id").agg(F.sort_array(F.collect_list(F.struct("word", "v"))).alias("s")) \
            .select("query_id", "doc_id", F.transform("s", lambda x: x["v"]).alias("vector"))


@register("j5_candidate_bm25", f"WITH {corpus_ctes().strip()}," + qterms_cte("qterms", BENCH_Q) + f""",
cand AS (SELECT q.query_id, t.doc_id FROM qterms q JOIN terms t USING (word) JOIN idf i ON i.word = q.word
         WHERE length(q.word) <= {P.max_word_len}
         GROUP BY 1, 2 HAVING sum(i.idf) > {P.doc_idf_mass_min}),
{bm25_scores_cte('bm_all', P.k1, P.b).strip()},
bm AS (SELECT b.* FROM bm_all b JOIN cand c USING (query_id, doc_id)),""" + top_k_cte("top", "bm", K)
          + "\nSELECT query_id, rank, doc_id, score FROM top")
def j5_candidate_bm25(spark, sf_dir):
    """BM25 scored only on the weighted_doc_idf candidates (semi join)."""
    q = tables.benchmark_queries(spark, sf_dir)
    qt, n, idx = _batch(spark, sf_dir)
    qw = qt.select("query_id", "word").filter(F.length("word") <= P.max_word_len)
    cand = (_few(qw, n).join(idx.terms.select("doc_id", "word"), "word").join(_few(idx.idf, n), "word")
              .groupBy("query_id", "doc_id").agg(F.sum("idf").alias("m"))
              .filter(F.col("m") > P.doc_idf_mass_min).select("query_id", "doc_id"))
    return S.search_bm25(q, idx, P.with_(top_k=K), candidates=cand)


@register("i7_candidates_dispatch", f"WITH {corpus_ctes().strip()},{query_ctes().strip()},{CHUNKS_CTE}" + f"""
SELECT DISTINCT 'trie' AS strategy, q.query_id, t.doc_id
FROM (SELECT query_id, word, {BUCKET_SQL} AS bucket FROM qterms WHERE length(word) <= {P.max_word_len}) q
JOIN chunks c ON c.bucket = q.bucket AND q.word >= c.lo AND q.word <= c.hi
JOIN terms t ON t.word = q.word
UNION ALL
SELECT 'weighted_doc_idf', q.query_id, t.doc_id FROM qterms q JOIN terms t USING (word) JOIN idf i ON i.word = q.word
WHERE length(q.word) <= {P.max_word_len} GROUP BY 2, 3 HAVING sum(i.idf) > {P.doc_idf_mass_min}
UNION ALL
SELECT DISTINCT 'word_idf_filter', q.query_id, t.doc_id
FROM qterms q JOIN idf i USING (word) JOIN terms t ON t.word = q.word WHERE i.idf < {P.word_idf_max}""")
def i7_candidates_dispatch(spark, sf_dir):
    from quarry.operators.candidates import candidates
    q = tables.benchmark_queries(spark, sf_dir)
    idx = _index(spark, sf_dir)
    out = None
    for s in ("trie", "weighted_doc_idf", "word_idf_filter"):
        c = candidates(q, idx, s, P, chunk_words=CHUNK_WORDS).select(F.lit(s).alias("strategy"), "query_id", "doc_id")
        out = c if out is None else out.unionByName(c)
    return out


# ---- full normalisation profile (once per distinct token) -----------------------------------

@register("t10_full_profile_terms", SF.TERMS_SQL)
def t10_full_profile_terms(spark, sf_dir):
    """T2-T11 'full' chain: doc_id, word, tf (stemmed, numbers spelt)."""
    return TM.SparseIndex(_docs(spark, sf_dir), "full", P).terms.select("doc_id", "word", "tf")


@register("t8_number_words", f"""
WITH {SF.DOC_TOKENS}
SELECT token, {spelt_sql('token')} AS words FROM (
  SELECT DISTINCT token FROM doc_tokens WHERE regexp_matches(token, '^[0-9]+$'))""")
def t8_number_words(spark, sf_dir):
    """Every distinct digit token of the corpus, spelt out."""
    toks = _docs(spark, sf_dir).select(F.explode(T.raw_tokens("text")).alias("token")) \
                               .filter(F.col("token").rlike("^[0-9]+$")).distinct()
    return toks.select("token", spelt(F.col("token")).alias("words"))


@register("r5_bm25_search_full", SF.SEARCH_CTES + "," + bm25_scores_cte("scores", P.k1, P.b) + top_k_sql(K))
def r5_bm25_search_full(spark, sf_dir):
    """A stored vocabulary map is brought up to date, then the search reads only
    the tokens that become a word of the batch."""
    docs, queries = _docs(spark, sf_dir), tables.benchmark_queries(spark, sf_dir)
    path = scratch_path(spark, f"vocabulary-{uuid.uuid4().hex}")
    mine = docs.repartition(partitions_for(spark, docs.count(), TM.DOCS_PER_TASK), "doc_id")
    update_map(mine.select(F.explode(T.raw_tokens("text")).alias("token")), path)
    idx = TM.SparseIndex(docs, "full", P, words=read_map(spark, path))
    return S.search_bm25(queries, idx, P.with_(top_k=K))
