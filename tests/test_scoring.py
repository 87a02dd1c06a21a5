"""Sparse scoring goldens (FIXTURES 3.1) and search invariants."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.operators import search as S
from quarry.operators.terms import SparseIndex

DOCS = [(1, "appl appl banana"), (2, "appl cherri cherri cherri"), (3, "banana")]


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    return SparseIndex(docs, "basic", DEFAULT)


def rows(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_stats_and_idf(index):
    st = index.stats.first()
    assert st.corpus_size == 3 and abs(st.avg_doc_len - 8 / 3) < 1e-9
    idf = {r.word: r.idf for r in index.idf.collect()}
    assert abs(idf["appl"] - 0.405465) < 1e-6 and abs(idf["cherri"] - 1.098612) < 1e-6


@pytest.mark.parametrize("k1,b,expect", [
    (1.2, 0.75, {(1, "appl"): 0.538580, (1, "banana"): 0.385740, (2, "appl"): 0.336613,
                 (2, "cherri"): 1.559321, (3, "banana"): 0.544747}),
    (1.0, 0.0, {(1, "appl"): 0.540620, (2, "cherri"): 1.647918, (3, "banana"): 0.405465}),
])
def test_bm25_matrix(spark, k1, b, expect):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    v = SparseIndex(docs, "basic", DEFAULT.with_(k1=k1, b=b)).vectors
    got = {(r.doc_id, r.word): r.bm25 for r in v.collect()}
    for k, val in expect.items():
        assert abs(got[k] - val) < 1e-6


def test_tfidf_and_bm25_search(spark, index):
    q = spark.createDataFrame([(7, "appl cherri zzz")], "query_id long, query string")
    tf = {r.doc_id: r.score for r in S.search_tfidf(q, index, DEFAULT).collect()}
    assert tf == pytest.approx({2: 0.501914, 1: 0.178532}, abs=1e-6)
    bm = S.search_bm25(q, index, DEFAULT).collect()
    assert [r.doc_id for r in bm] == [2, 1]
    assert bm[0].score == pytest.approx(1.895933, abs=1e-6) and bm[0].rank == 1
    bm0 = {r.doc_id: r.score for r in S.search_bm25(q, index, DEFAULT.with_(k1=1.0, b=0.0)).collect()}
    assert bm0 == pytest.approx({2: 2.053384, 1: 0.540620}, abs=1e-6)


def test_single_term_cosine_ties(spark, index):
    q = spark.createDataFrame([(1, "appl")], "query_id long, query string")
    r = S.search_tfidf(q, index, DEFAULT).orderBy("rank").collect()
    assert [(x.doc_id, x.score) for x in r] == [(1, 1.0), (2, 1.0)]


def test_idf_filters(spark, index):
    from quarry.operators.candidates import candidates
    q = spark.createDataFrame([(1, "appl cherri")], "query_id long, query string")
    w = rows(candidates(q, index, "word_idf_filter"), "doc_id")
    assert w == {(1,), (2,)}             # only 'appl' (idf < 1) kept
    m = rows(candidates(q, index, "weighted_doc_idf"), "doc_id")
    assert m == {(2,)}                   # d1 mass 0.405 dropped, d2 1.504 kept


def test_top_k_prefix_and_batch_equals_singles(spark):
    from quarry.sources import tables
    docs = tables.documents(spark, "/root/testdata/sf0.001")
    idx = SparseIndex(docs, "basic", DEFAULT)
    qs = tables.benchmark_queries(spark, "/root/testdata/sf0.001")
    batch = S.search_bm25(qs, idx, DEFAULT.with_(top_k=10))
    first = qs.orderBy("query_id").limit(3).collect()
    b = {(r.query_id, r.rank): (r.doc_id, r.score) for r in batch.collect()}
    for row in first:
        one = spark.createDataFrame([(row.query_id, row.query)], "query_id long, query string")
        single = {(r.query_id, r.rank): (r.doc_id, r.score) for r in S.search_bm25(one, idx, DEFAULT.with_(top_k=10)).collect()}
        assert all(b[k] == v for k, v in single.items())
    top5 = {(r.query_id, r.rank): r.doc_id for r in S.search_bm25(qs, idx, DEFAULT.with_(top_k=5)).collect()}
    assert all(b[k][0] == v for k, v in top5.items())


def test_invariants(spark):
    from quarry.sources import tables
    idx = SparseIndex(tables.documents(spark, "/root/testdata/sf0.001"), "basic", DEFAULT)
    per_doc = idx.terms.groupBy("doc_id").agg(F.sum("tf").alias("s"), F.max("doc_len").alias("l"))
    assert per_doc.filter(F.col("s") != F.col("l")).count() == 0            # sum tf = doc_len
    assert idx.df.agg(F.sum("num_docs")).first()[0] == idx.terms.count()     # sum df = postings
    assert not math.isnan(idx.stats.first().avg_doc_len)


def test_bad_arguments(spark, index):
    q = spark.createDataFrame([(1, "appl")], "query_id long, query string")
    with pytest.raises(ValueError):
        S.search_bm25(q, index, DEFAULT.with_(top_k=0))
    with pytest.raises(ValueError):
        S.search_tfidf(q, index, DEFAULT.with_(srt=2.0))


def test_stored_index_equals_in_plan(spark):
    import uuid

    from quarry.operators import stored
    from quarry.session import scratch_path
    from quarry.sources import tables
    sf = "/root/testdata/sf0.001"
    qs = tables.benchmark_queries(spark, sf)
    for profile in ("basic", "full"):
        idx = SparseIndex(tables.documents(spark, sf), profile, DEFAULT)
        path = scratch_path(spark, f"t-index-{uuid.uuid4().hex}")
        stored.build(idx, path, n_shards=8)
        st = stored.StoredIndex(spark, path, DEFAULT)
        p = DEFAULT.with_(top_k=10)
        a = {(r.query_id, r.rank, r.doc_id, r.score) for r in S.search_bm25(qs, idx, p).collect()}
        b = {(r.query_id, r.rank, r.doc_id, r.score) for r in S.search_bm25(qs, st, p).collect()}
        assert a == b and len(a) > 0


def test_maxscore_and_shared_index_equal_exhaustive(spark):
    from quarry.sources import tables
    sf = "/root/testdata/sf0.01"
    idx = SparseIndex(tables.documents(spark, sf), "basic", DEFAULT)
    q = tables.conversation_queries(spark, sf)
    p = DEFAULT.with_(top_k=10)
    full = {tuple(r) for r in S.search_bm25(q, idx, p).collect()}
    assert {tuple(r) for r in S.search_bm25_maxscore(q, idx, p).collect()} == full
    words = S.query_terms(q).select("word").distinct()
    shared = idx.restrict(words, words.count())
    assert {tuple(r) for r in S.search_bm25(q, shared, p).collect()} == full
    t_full = {tuple(r) for r in S.search_tfidf(q, idx, p).collect()}
    assert {tuple(r) for r in S.search_tfidf(q, shared, p).collect()} == t_full


def test_knn_paths_agree_with_brute_force(spark):
    """Queries sent to the tasks, and queries dealt to item blocks; ties go to the smaller key."""
    import numpy as np
    from quarry.config import DEFAULT
    from quarry.operators.dense import knn_exact
    rng = np.random.default_rng(3)
    x = rng.integers(-2, 3, size=(300, 5)).astype(float)
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "item_id long, vector array<double>").repartition(3)
    q = spark.createDataFrame([(i, x[i].tolist()) for i in range(0, 300, 7)], "query_id long, vector array<double>")
    want = {(i, r + 1, int(n)) for i in range(0, 300, 7)
            for r, n in enumerate(np.lexsort((np.arange(300), ((x - x[i]) ** 2).sum(axis=1)))[:6])}
    for p in (DEFAULT, DEFAULT.with_(knn_query_bytes=0, knn_block_rows=50), DEFAULT.with_(knn_query_bytes=0, knn_block_rows=4)):
        assert {tuple(r)[:3] for r in knn_exact(items, q, 6, p).collect()} == want
    assert knn_exact(items, q.limit(0), 6).collect() == []
