"""Two-stage search (R12) and graph-expanded rerank.

Stage 1 is a sparse top-k (BM25 or TF-IDF) for the whole query batch.
Stage 2 chunks and embeds only the stage-1 documents (a semi join against
at most queries x k1 ids, broadcast behind that bound), then scores each
query only against the chunks of its own candidates — the candidate pairs
are bounded by k1 documents per query — and keeps the k nearest passages.
An empty stage 1 gives an empty result for that query.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.operators import chunk as C
from quarry.operators import dense as D
from quarry.operators import search as S
from quarry.operators.terms import SparseIndex
from quarry.plans.util import bounded_broadcast


def embed_chunks(docs: DataFrame, params: Params = DEFAULT, embed_fn: Callable | None = None,
                 splitter: str = "\n\n", tokenizer: C.Tokenizer = C.hash_tokenizer) -> DataFrame:
    """``doc_id, piece_no, win_no, text_idx, text_len, vector``.

    ``embed_fn``: a function without arguments that loads a model and returns
    its ``list of token arrays -> vectors``; without it vectors are hashed.
    """
    ch = C.direct_split(docs, params, splitter, tokenizer)
    return ch.select("doc_id", "piece_no", "win_no", "text_idx", "text_len",
                     D.embedding(F.col("tokens"), params, embed_fn).alias("vector"))


def embed_queries(queries: DataFrame, params: Params = DEFAULT, embed_fn: Callable | None = None) -> DataFrame:
    """``query_id, qvec``: whole queries, padded to the context length as chunks are."""
    tokens = C.hash_tokenizer(F.col("query"))
    padded = F.concat(tokens, F.array_repeat(F.lit(params.pad_token_id).cast("long"),
                                             F.greatest(F.lit(params.context_length) - F.size(tokens), F.lit(0))))
    return queries.select("query_id", D.embedding(padded, params, embed_fn).alias("qvec"))


def passage_search(queries: DataFrame, candidates: DataFrame, docs: DataFrame, bound_rows: int,
                   params: Params = DEFAULT, embed_fn: Callable | None = None) -> DataFrame:
    """R9-R11 restricted to ``candidates(query_id, doc_id)``:
    ``query_id, rank, doc_id, piece_no, win_no, span_start, span_end, distance``."""
    cand_docs = bounded_broadcast(candidates.select("doc_id").distinct(), bound_rows,
                                  params.broadcast_max_rows)
    d = docs.select("doc_id", "text").join(cand_docs, "doc_id", "left_semi")
    chunks = embed_chunks(d, params, embed_fn)
    qv = bounded_broadcast(embed_queries(queries, params, embed_fn), bound_rows, params.broadcast_max_rows)
    pairs = candidates.select("query_id", "doc_id").join(chunks, "doc_id").join(qv, "query_id")
    top = D.knn_candidates(pairs, params.top_k, key=("doc_id", "piece_no", "win_no"))
    return top.select("query_id", "rank", "doc_id", "piece_no", "win_no",
                      F.col("text_idx").alias("span_start"),
                      (F.col("text_idx") + F.col("text_len")).alias("span_end"), "distance")


def rerank(queries: DataFrame, docs: DataFrame, index: SparseIndex, params: Params = DEFAULT,
           stage1_k: int = 50, use_tfidf: bool = False, embed_fn: Callable | None = None) -> DataFrame:
    """Sparse top-``stage1_k`` then passage kNN over those documents."""
    queries = queries.cache()
    nq = queries.count()
    p1 = params.with_(top_k=stage1_k)
    s1 = (S.search_tfidf if use_tfidf else S.search_bm25)(queries, index, p1)
    s1 = s1.select("query_id", "doc_id").cache()   # bounded: queries x stage1_k rows
    return passage_search(queries, s1, docs, nq * stage1_k, params, embed_fn)
