"""Registered search queries."""

from __future__ import annotations

from quarry.config import DEFAULT
from quarry.operators import search as S
from quarry.operators import terms as TM
from quarry.plans.catalog import register
from quarry.plans.sql import bm25_scores_sql, tfidf_scores_sql, top_k_sql
from quarry.sources import tables

P = DEFAULT


def _index(spark, sf_dir):
    return TM.SparseIndex(tables.documents(spark, sf_dir), "basic", P)


@register("r5_bm25_search", bm25_scores_sql(P.k1, P.b) + top_k_sql(P.top_k))
def r5_bm25_search(spark, sf_dir):
    return S.search_bm25(tables.benchmark_queries(spark, sf_dir), _index(spark, sf_dir), P)


@register("r4_tfidf_search", tfidf_scores_sql() + top_k_sql(P.top_k))
def r4_tfidf_search(spark, sf_dir):
    return S.search_tfidf(tables.benchmark_queries(spark, sf_dir), _index(spark, sf_dir), P)


@register("r5_bm25_stored_index", bm25_scores_sql(P.k1, P.b) + top_k_sql(P.top_k))
def r5_bm25_stored_index(spark, sf_dir):
    """Build the word-sharded index from the documents, then search it."""
    import uuid

    from quarry.operators import stored
    from quarry.session import scratch_path
    path = scratch_path(spark, f"index-{uuid.uuid4().hex}")
    stored.build(_index(spark, sf_dir), path, n_shards=16)
    idx = stored.StoredIndex(spark, path, P)
    return S.search_bm25(tables.benchmark_queries(spark, sf_dir), idx, P)


@register("r4_tfidf_stored_index", tfidf_scores_sql() + top_k_sql(P.top_k))
def r4_tfidf_stored_index(spark, sf_dir):
    import uuid

    from quarry.operators import stored
    from quarry.session import scratch_path
    path = scratch_path(spark, f"index-{uuid.uuid4().hex}")
    stored.build(_index(spark, sf_dir), path, n_shards=16)
    return S.search_tfidf(tables.benchmark_queries(spark, sf_dir), stored.StoredIndex(spark, path, P), P)


def _stored(spark, sf_dir):
    import uuid

    from quarry.operators import stored
    from quarry.session import scratch_path
    path = scratch_path(spark, f"index-{uuid.uuid4().hex}")
    stored.build(_index(spark, sf_dir), path, n_shards=16)
    return stored.StoredIndex(spark, path, P)


@register("r6_bm25_stored_reuse", bm25_scores_sql(P.k1, P.b) + top_k_sql(P.top_k))
def r6_bm25_stored_reuse(spark, sf_dir):
    """Same k1/b as the stored index: the stored per-row scores are summed."""
    return S.search_bm25(tables.benchmark_queries(spark, sf_dir), _stored(spark, sf_dir), P)


@register("r6_bm25_stored_recompute", bm25_scores_sql(1.0, 0.0) + top_k_sql(P.top_k))
def r6_bm25_stored_recompute(spark, sf_dir):
    """Other k1/b than stored: scores recomputed from tf, doc_len and idf."""
    return S.search_bm25(tables.benchmark_queries(spark, sf_dir), _stored(spark, sf_dir), P.with_(k1=1.0, b=0.0))


@register("r5_bm25_maxscore", bm25_scores_sql(P.k1, P.b) + top_k_sql(P.top_k))
def r5_bm25_maxscore(spark, sf_dir):
    """BM25 top-k with exact MaxScore pruning (same answer as r5_bm25_search)."""
    return S.search_bm25_maxscore(tables.benchmark_queries(spark, sf_dir), _index(spark, sf_dir), P)
