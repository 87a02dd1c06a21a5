"""Registered inverted-index queries.

The reference caps (df 1,000,000 per shard, 100,000 words per chunk) are
the library defaults; the registered queries use smaller caps (``SHARD_CAP``,
``CHUNK_WORDS``) so that the test corpora (10^3-10^4 documents) actually
produce several shards and chunks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.operators import index as IX
from quarry.operators import search as S
from quarry.operators import terms as TM
from quarry.plans.catalog import register
from quarry.plans.sql import corpus_ctes, query_ctes
from quarry.plans.util import bounded_broadcast, partitions_for
from quarry.session import scratch_path
from quarry.sources import tables

P = DEFAULT
SHARD_CAP = 10_000
CHUNK_WORDS = 1_000
BLOCK = 256

BUCKET_SQL = ("CASE WHEN regexp_matches(substr(word, 1, 1), '^[0-9a-z]$') "
              "THEN substr(word, 1, 1) ELSE 'other' END")


def _index(spark, sf_dir):
    return TM.SparseIndex(tables.documents(spark, sf_dir), "basic", P)


def _ids(spark, sf_dir):
    return IX.doc_ids(tables.documents(spark, sf_dir, with_text=False))


DOC_IDS_CTE = """
doc_ids AS (SELECT doc_id, source AS file,
                   CAST(row_number() OVER (ORDER BY source, doc_id) AS BIGINT) AS doc_int
            FROM documents)"""

SHARDS_CTE = f"""
hist AS (SELECT num_docs AS d, count(*) AS n, row_number() OVER (ORDER BY num_docs DESC) AS k FROM dfs GROUP BY num_docs),
-- per distinct df, in order: words before it, the open shard, its df sum before and after
fold(k, d, n, before, shard, total, room, shard2, total2) AS (
  SELECT k, d, n, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), greatest(1, {SHARD_CAP} // d),
    CASE WHEN n <= greatest(1, {SHARD_CAP} // d) THEN 0 ELSE (n - greatest(1, {SHARD_CAP} // d) + greatest(1, {SHARD_CAP} // d) - 1) // greatest(1, {SHARD_CAP} // d) END,
    CASE WHEN n <= greatest(1, {SHARD_CAP} // d) THEN n * d ELSE ((n - 1) % greatest(1, {SHARD_CAP} // d) + 1) * d END
  FROM hist WHERE k = 1
  UNION ALL
  SELECT h.k, h.d, h.n, f.before + f.n, f.shard2, f.total2, greatest(0, ({SHARD_CAP} - f.total2) // h.d),
    CASE WHEN h.n <= greatest(0, ({SHARD_CAP} - f.total2) // h.d) THEN f.shard2 ELSE f.shard2 +
      (h.n - greatest(0, ({SHARD_CAP} - f.total2) // h.d) + greatest(1, {SHARD_CAP} // h.d) - 1) // greatest(1, {SHARD_CAP} // h.d) END,
    CASE WHEN h.n <= greatest(0, ({SHARD_CAP} - f.total2) // h.d) THEN f.total2 + h.n * h.d
      ELSE ((h.n - greatest(0, ({SHARD_CAP} - f.total2) // h.d) - 1) % greatest(1, {SHARD_CAP} // h.d) + 1) * h.d END
  FROM fold f JOIN hist h ON h.k = f.k + 1),
nth AS (SELECT word, num_docs, row_number() OVER (ORDER BY num_docs DESC, word) - 1 AS r FROM dfs),
shards AS (SELECT word, num_docs, CAST(CASE WHEN r - before < room THEN shard
  ELSE shard + 1 + (r - before - room) // greatest(1, {SHARD_CAP} // d) END AS BIGINT) AS shard
  FROM nth JOIN fold ON num_docs = d)"""

CHUNKS_CTE = f"""
bucketed AS (SELECT word, {BUCKET_SQL} AS bucket FROM dfs),
ranked AS (SELECT word, bucket, row_number() OVER (PARTITION BY bucket ORDER BY word) AS rn FROM bucketed),
chunks AS (SELECT bucket, CAST(floor((rn - 1) / {CHUNK_WORDS}) AS BIGINT) AS chunk,
                  min(word) AS lo, max(word) AS hi, CAST(count(*) AS BIGINT) AS n_words
           FROM ranked GROUP BY 1, 2)"""


def _few(df, n):
    return bounded_broadcast(df, n, P.broadcast_max_rows)


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes)


@register("w7_doc_ids", _with(DOC_IDS_CTE) + "\nSELECT doc_id, file, doc_int FROM doc_ids")
def w7_doc_ids(spark, sf_dir):
    return _ids(spark, sf_dir)


@register("w4_vocab_by_df", _with(corpus_ctes()) + """
SELECT word, num_docs, CAST(row_number() OVER (ORDER BY num_docs DESC, word) AS BIGINT) AS df_rank FROM dfs""")
def w4_vocab_by_df(spark, sf_dir):
    return IX.vocabulary_by_df(_index(spark, sf_dir).df)


@register("a15_df_curve", _with(corpus_ctes()) + """
SELECT word, num_docs, CAST(row_number() OVER (ORDER BY num_docs DESC, word) AS BIGINT) AS df_rank FROM dfs""")
def a15_df_curve(spark, sf_dir):
    return TM.df_curve(_index(spark, sf_dir).df)


@register("w5_df_shards", _with(corpus_ctes(), SHARDS_CTE) + "\nSELECT word, num_docs, shard FROM shards")
def w5_df_shards(spark, sf_dir):
    return IX.shard_by_df(_index(spark, sf_dir).df, SHARD_CAP)


@register("w6_vocab_chunks", _with(corpus_ctes(), CHUNKS_CTE) + "\nSELECT bucket, chunk, lo, hi, n_words FROM chunks")
def w6_vocab_chunks(spark, sf_dir):
    return IX.vocab_chunks(_index(spark, sf_dir).df, CHUNK_WORDS)


@register("a14_vocab_profile", _with(corpus_ctes()) + f"""
SELECT {BUCKET_SQL} AS bucket, CAST(count(*) AS BIGINT) AS n_words,
       CAST(sum(CASE WHEN regexp_matches(word, '^[0-9]') THEN 1 ELSE 0 END) AS BIGINT) AS n_digit_start,
       CAST(sum(CASE WHEN regexp_matches(word, '^[a-z]') THEN 1 ELSE 0 END) AS BIGINT) AS n_alpha_start
FROM dfs GROUP BY 1""")
def a14_vocab_profile(spark, sf_dir):
    return TM.vocabulary_profile(_index(spark, sf_dir).df)


@register("j3_doc_int_terms", _with(corpus_ctes(), DOC_IDS_CTE) + """
SELECT d.doc_int, t.word, t.tf FROM terms t JOIN doc_ids d USING (doc_id)""")
def j3_doc_int_terms(spark, sf_dir):
    t = _index(spark, sf_dir).terms
    return t.join(_ids(spark, sf_dir), "doc_id").select("doc_int", "word", "tf")


@register("a9_postings", _with(corpus_ctes(), DOC_IDS_CTE) + f"""
SELECT word, CAST(floor(doc_int / {BLOCK}) AS BIGINT) AS block,
       list(doc_int ORDER BY doc_int) AS docs, CAST(count(*) AS BIGINT) AS n
FROM terms JOIN doc_ids USING (doc_id) GROUP BY 1, 2""")
def a9_postings(spark, sf_dir):
    rows = IX.postings_rows(_index(spark, sf_dir).terms, _ids(spark, sf_dir))
    return IX.postings_blocks(rows, BLOCK)


@register("i1_sharded_postings", _with(corpus_ctes(), DOC_IDS_CTE, SHARDS_CTE) + """
SELECT s.shard, t.word, d.doc_int FROM terms t JOIN doc_ids d USING (doc_id) JOIN shards s USING (word)""")
def i1_sharded_postings(spark, sf_dir):
    idx = _index(spark, sf_dir)
    rows = IX.postings_rows(idx.terms, _ids(spark, sf_dir))
    return IX.sharded_postings(rows, IX.shard_by_df(idx.df, SHARD_CAP))


def _qwords(spark, sf_dir):
    return S.query_terms(tables.benchmark_queries(spark, sf_dir)).select("query_id", "word")


def _batch(spark, sf_dir):
    """The batch's query terms, their number, and the index limited to their
    words: the postings stay clustered by document, so sums over (query,
    document) are local to tasks of a bounded number of documents."""
    qt = S.query_terms(tables.benchmark_queries(spark, sf_dir)).cache()
    n = qt.count()
    return qt, n, _index(spark, sf_dir).restrict(qt.select("word"), n)


CAND_SQL = _with(corpus_ctes(), query_ctes(), DOC_IDS_CTE) + """
SELECT DISTINCT q.query_id, d.doc_id, d.file, d.doc_int
FROM qterms q JOIN terms t USING (word) JOIN doc_ids d ON d.doc_id = t.doc_id"""


def _decoded(c, ids):
    return IX.decode(c, ids).select("query_id", "doc_id", "file", "doc_int")


@register("i2_or_candidates", CAND_SQL)
def i2_or_candidates(spark, sf_dir):
    ids = _ids(spark, sf_dir)
    rows = IX.postings_rows(_index(spark, sf_dir).terms, ids)
    return _decoded(IX.or_candidates(_qwords(spark, sf_dir), rows), ids)


@register("i3_sorted_index_query", CAND_SQL)
def i3_sorted_index_query(spark, sf_dir):
    """The stored shards are read in df order until every word is found (words
    that the vocabulary lacks are not looked for)."""
    from quarry.sources import builds, storage
    idx = _index(spark, sf_dir)
    ids = _ids(spark, sf_dir)
    path = scratch_path(spark, f"shards-{uuid.uuid4().hex}")
    shards = IX.shard_by_df(idx.df, SHARD_CAP)
    storage.write_shards(IX.sharded_postings(IX.postings_rows(idx.terms, ids), shards), path)
    qw = _qwords(spark, sf_dir)
    known = qw.select("word").distinct().join(idx.df.select("word"), "word", "left_semi")
    post, _ = IX.sorted_walk(known, builds.read_build(spark, path))
    c = qw.join(post, "word").select("query_id", "doc_int").distinct()
    return _decoded(c, ids)


@register("j4_decode_doc_ints", _with(corpus_ctes(), DOC_IDS_CTE) + """
SELECT d.doc_int, d.doc_id, d.file, CAST(count(*) AS BIGINT) AS n_words
FROM terms t JOIN doc_ids d USING (doc_id) GROUP BY 1, 2, 3""")
def j4_decode_doc_ints(spark, sf_dir):
    ids = _ids(spark, sf_dir)
    rows = IX.postings_rows(_index(spark, sf_dir).terms, ids)
    per_int = rows.groupBy("doc_int").agg(F.count(F.lit(1)).alias("n_words"))
    return IX.decode(per_int, ids).select("doc_int", "doc_id", "file", "n_words")


@register("j8_word_chunk_range", _with(corpus_ctes(), query_ctes(), CHUNKS_CTE) + f"""
SELECT q.query_id, q.word, c.bucket, c.chunk
FROM (SELECT query_id, word, {BUCKET_SQL} AS bucket FROM qterms) q
JOIN chunks c ON c.bucket = q.bucket AND q.word >= c.lo AND q.word <= c.hi""")
def j8_word_chunk_range(spark, sf_dir):
    chunks = IX.vocab_chunks(_index(spark, sf_dir).df, CHUNK_WORDS)
    return IX.words_to_chunks(_qwords(spark, sf_dir), chunks).select("query_id", "word", "bucket", "chunk")


@register("i4_trie_lookup", _with(corpus_ctes(), query_ctes(), CHUNKS_CTE, DOC_IDS_CTE) + f"""
SELECT DISTINCT q.query_id, d.doc_id, d.file, d.doc_int
FROM (SELECT query_id, word, {BUCKET_SQL} AS bucket FROM qterms WHERE length(word) <= {P.max_word_len}) q
JOIN chunks c ON c.bucket = q.bucket AND q.word >= c.lo AND q.word <= c.hi
JOIN terms t ON t.word = q.word JOIN doc_ids d ON d.doc_id = t.doc_id""")
def i4_trie_lookup(spark, sf_dir):
    idx = _index(spark, sf_dir)
    ids = _ids(spark, sf_dir)
    qw = _qwords(spark, sf_dir).filter(F.length("word") <= P.max_word_len)       # F5
    located = IX.words_to_chunks(qw, IX.vocab_chunks(idx.df, CHUNK_WORDS))      # F6 + F7/J8
    rows = IX.postings_rows(idx.terms, ids)
    c = IX.or_candidates(located.select("query_id", "word"), rows)
    return _decoded(c, ids)


@register("i5_weighted_doc_idf", _with(corpus_ctes(), query_ctes()) + f"""
SELECT q.query_id, t.doc_id, round(sum(i.idf), 6) AS idf_mass
FROM qterms q JOIN terms t USING (word) JOIN idf i ON i.word = q.word
WHERE length(q.word) <= {P.max_word_len}
GROUP BY 1, 2 HAVING sum(i.idf) > {P.doc_idf_mass_min}""")
def i5_weighted_doc_idf(spark, sf_dir):
    qt, n, idx = _batch(spark, sf_dir)
    qw = qt.select("query_id", "word").filter(F.length("word") <= P.max_word_len)
    j = _few(qw, n).join(idx.terms.select("doc_id", "word"), "word").join(_few(idx.idf, n), "word")
    agg = j.groupBy("query_id", "doc_id").agg(F.sum("idf").alias("mass"))               # A11
    return agg.filter(F.col("mass") > P.doc_idf_mass_min) \
              .select("query_id", "doc_id", F.round("mass", 6).alias("idf_mass"))      # F10


@register("i6_word_idf_filter", _with(corpus_ctes(), query_ctes()) + f"""
SELECT DISTINCT q.query_id, t.doc_id
FROM qterms q JOIN idf i USING (word) JOIN terms t ON t.word = q.word
WHERE i.idf < {P.word_idf_max}""")
def i6_word_idf_filter(spark, sf_dir):
    qt, n, idx = _batch(spark, sf_dir)
    qw = S.query_weights(qt, idx, n, P)
    kept = qw.filter(F.col("idf") < P.word_idf_max).select("query_id", "word")          # F9
    return _few(kept, n).join(idx.terms.select("doc_id", "word"), "word").select("query_id", "doc_id").distinct()


@register("i8_prefix_lookup", _with(corpus_ctes(), query_ctes()) + """
, voc AS (SELECT DISTINCT word FROM terms), pre AS (SELECT DISTINCT word AS prefix FROM qterms),
hit AS (SELECT prefix, voc.word FROM pre JOIN voc ON starts_with(voc.word, prefix)),
n AS (SELECT prefix, count(DISTINCT word) AS n_words, count(DISTINCT doc_id) AS n_docs FROM hit JOIN terms USING (word) GROUP BY 1)
SELECT DISTINCT query_id, prefix, CAST(n_words AS BIGINT) AS n_words, CAST(n_docs AS BIGINT) AS n_docs
FROM (SELECT query_id, word AS prefix FROM qterms) JOIN n USING (prefix)""")
def i8_prefix_lookup(spark, sf_dir):
    """Every query word as a prefix: vocabulary words and documents it reaches,
    from postings stored in word order. Only the prefixes' word ranges are read."""
    from quarry.operators.candidates import prefix_matches
    path = scratch_path(spark, f"postings-{uuid.uuid4().hex}")
    IX.write_by_word(_index(spark, sf_dir).terms.select("word", "doc_id"), path)
    p = _qwords(spark, sf_dir).select("query_id", F.col("word").alias("prefix")).distinct()
    each = p.select("prefix").distinct()
    stored = spark.read.parquet(path)
    near = IX.prefix_scan(stored, [r["prefix"] for r in each.collect()])   # words of one batch
    # one row per prefix and word, so the words are counted without the postings
    hit = prefix_matches(each, near.select("word").distinct()).cache()
    n_words = hit.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_words"))
    # a document's rows meet in one of many small tasks, whatever words they come from
    parts = partitions_for(spark, stored.count(), 1_000_000)
    reached = hit.join(near, "word").select("prefix", "doc_id").repartition(parts, "doc_id").distinct()
    n_docs = reached.groupBy("prefix").agg(F.count("doc_id").alias("n_docs"))
    return p.join(n_words, "prefix").join(n_docs, "prefix").select("query_id", "prefix", "n_words", "n_docs")


@register("i9_index_roundtrip", _with(corpus_ctes(), DOC_IDS_CTE) + """
SELECT t.word, d.doc_int FROM terms t JOIN doc_ids d USING (doc_id)""")
def i9_index_roundtrip(spark, sf_dir):
    """The packed postings, written, read back and unpacked."""
    rows = IX.postings_rows(_index(spark, sf_dir).terms, _ids(spark, sf_dir))
    path = scratch_path(spark, f"postings-{uuid.uuid4().hex}")
    IX.postings_blocks(rows, BLOCK).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select("word", F.explode("docs").alias("doc_int"))
