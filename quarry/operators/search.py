"""Sparse search over a batch of queries.

A search is one plan for the whole query batch:

    queries -> query terms -> (left) idf with OOV default -> join postings on word
            -> aggregate per (query_id, doc) -> per-query top-k -> attach text

The query side is broadcast behind a row-count check, so the index side is
streamed once and never shuffled for the join; the per-query top-k runs as a
partial/final ``WindowGroupLimit`` so at most k rows per query and partition
cross the network. Text is joined only after the top-k (late
materialisation), so it is read for k rows per query.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.operators.terms import DOCS_PER_TASK, SparseIndex, bm25_expr, corpus_stats, doc_terms, idf
from quarry.plans.util import bounded_broadcast, checked_broadcast, partitions_for
from quarry.session import scratch_path, shuffles_removed

BATCH_TERMS = 20_000         # query words above which a batch is scored block by block
SLICE_TERMS = 500_000        # query words of a slice
SLICE_RESULTS = 2_000_000    # results a slice has of a block
BLOCK_POSTINGS = 8_000_000   # postings of a block of documents
ROUND_POSTINGS = 160_000_000  # postings that a round of slices moves, if one slice moves fewer


def query_terms(queries: DataFrame, profile: str = "basic") -> DataFrame:
    """``query_id, word, qtf`` (the query run through the same normalisation)."""
    q = queries.select("query_id", F.col("query").alias("text"))
    return (doc_terms(q.withColumnRenamed("query_id", "doc_id"), profile)
            .select(F.col("doc_id").alias("query_id"), "word", F.col("tf").alias("qtf")))


def query_weights(qterms: DataFrame, index: SparseIndex, bound_rows: int | None = None,
                  params: Params = DEFAULT) -> DataFrame:
    """J6 + R2: ``query_id, word, qtf, idf, qw``; OOV idf = ln(2N + 1).
    ``bound_rows`` bounds the idf side (an index restricted to the batch's
    words), which is then broadcast."""
    n = index.stats.select("corpus_size").scalar()   # one-row scalar subquery
    idf = (bounded_broadcast(index.idf, bound_rows, params.broadcast_max_rows)
           if bound_rows is not None else index.idf)
    j = qterms.join(idf, "word", "left")
    idf_c = F.coalesce(F.col("idf"), F.log(2 * n + 1))
    return j.select("query_id", "word", "qtf", idf_c.alias("idf"),
                    (F.col("qtf") * idf_c).alias("qw"))


def _restricted(index, words: DataFrame, n: int):
    """The index limited to the batch's words. An index the caller already
    restricted (to a superset of the batch's words, e.g. shared by several
    engines over one batch) is used as it is."""
    if getattr(index, "vocabulary", None) is None:
        return index.restrict(words, n)
    if not words.join(index.vocabulary.select("word").distinct(), "word", "left_anti").isEmpty():
        raise ValueError("the index is restricted to a vocabulary that lacks words of this batch")
    return index


def _by_doc(index, post: DataFrame) -> DataFrame:
    """Postings clustered by document before they meet the query batch.

    Each posting row fans out to every query containing its word, so the
    per-(query, doc) sums are much larger than the postings. With postings
    already clustered by document (an index built in the same plan from the
    key-partitioned corpus) the sums need no shuffle; postings read from a
    word-sharded store are moved once, before the fan-out, instead, into tasks
    of a bounded number of documents."""
    if getattr(index, "doc_clustered", True):
        return post
    size = index.stats.first()["corpus_size"]
    return post.repartition(partitions_for(post.sparkSession, size, DOCS_PER_TASK), "doc_id")


def _round(c, digits):
    return F.round(c, digits) if digits is not None else c


def top_k(scored: DataFrame, k: int, score: str = "score", key: str = "doc_id",
          partition: str = "query_id", ascending: bool = False) -> DataFrame:
    """``rank`` 1..k per query; ties broken by ``key`` ascending."""
    order = F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(partition).orderBy(order, *[F.col(c).asc() for c in keys])
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
                 .withColumn("rank", F.col("rank").cast("long"))


def _threshold(df: DataFrame, params: Params) -> DataFrame:
    # srt = -1 disables; else keep scores >= srt.
    if params.srt is not None and params.srt != -1.0:
        if not 0.0 <= params.srt <= 1.0:
            raise ValueError("srt must be -1 or in [0, 1]")
        return df.filter(F.col("score") >= params.srt)
    return df


def _check_k(params: Params):
    if not isinstance(params.top_k, int) or params.top_k <= 0:
        raise ValueError("max_results must be a positive int")


def bm25_scores(queries: DataFrame, index: SparseIndex, params: Params = DEFAULT,
                candidates: DataFrame | None = None, score_digits: int | None = 6) -> DataFrame:
    """R5 without the top-k: ``query_id, doc_id, score`` = Σ bm25 over distinct query words.

    ``candidates`` (``query_id, doc_id``) restricts the documents (J5).
    """
    qt = query_terms(queries, index.profile).select("query_id", "word").cache()
    n = qt.count()
    qt = bounded_broadcast(qt, n, params.broadcast_max_rows)
    index = _restricted(index, qt.select("word"), n)
    # An index stored with the same k1/b already holds each row's score
    reuse = (getattr(index, "stored_k1", None) == params.k1 and getattr(index, "stored_b", None) == params.b
             and hasattr(index, "vectors"))
    cols = ["doc_id", "word", "bm25"] if reuse else ["doc_id", "word", "tf", "doc_len"]
    post = _by_doc(index, (index.vectors if reuse else index.terms).select(*cols))
    j = qt.join(post, "word")
    if reuse:
        contrib = F.col("bm25")
    else:
        # restricted idf has at most one row per query word
        j = j.join(bounded_broadcast(index.idf, n, params.broadcast_max_rows), "word")
        avg = index.stats.select("avg_doc_len").scalar()   # one-row scalar subquery
        contrib = bm25_expr("tf", "idf", "doc_len", avg, params.k1, params.b)
    scored = j.groupBy("query_id", "doc_id").agg(F.sum(contrib).alias("score"))
    if candidates is not None:
        scored = _among(scored, candidates)
    return scored.withColumn("score", _round(F.col("score"), score_digits))


def _among(scored: DataFrame, candidates: DataFrame) -> DataFrame:
    """The rows of ``scored`` whose (query, document) is a candidate. Both meet
    by document, where the postings already are; a document's candidate queries
    are one list, bounded by the batch."""
    mine = (candidates.filter(F.col("query_id").isNotNull()).groupBy("doc_id")
                      .agg(F.collect_set("query_id").alias("_queries")))
    return (scored.join(mine, "doc_id").filter(F.array_contains("_queries", F.col("query_id")))
                  .select("query_id", "doc_id", "score"))


def _block_kernel(k: int, k1: float, b: float, digits: int | None):
    """``cogroup`` function: the ``k`` best documents of one block per query of one slice."""
    def score(docs, queries):
        import numpy as np
        import pyarrow as pa

        def flat(table, col, kind):
            return table[col].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)

        def sizes(table, col):
            return np.asarray(table[col].combine_chunks().value_lengths())

        got_q, got_d, got_s = [], [], []
        if docs.num_rows and queries.num_rows:
            # documents in the order of ties: null first, then by id; repeated ids are one document
            null = docs["doc_id"].is_null().to_numpy()
            ids = docs["doc_id"].fill_null(0).to_numpy()
            order = np.lexsort((ids, ~null))
            new = np.ones(len(ids), bool)
            new[1:] = (ids[order][1:] != ids[order][:-1]) | (null[order][1:] != null[order][:-1])
            n_docs, first_row = int(new.sum()), order[new]
            place = np.empty(len(ids), np.int32)
            place[order] = np.cumsum(new) - 1
            row = np.repeat(np.arange(len(ids), dtype=np.int32), sizes(docs, "wids"))
            tf = flat(docs, "tfs", np.float64)
            share = docs["doc_len"].to_numpy() / docs["avg"].to_numpy()
            weight = tf * (k1 + 1) / (tf + (k1 * (1 - b + b * share))[row])
            word, doc = flat(docs, "wids", np.int64), place[row]
            by_word = np.argsort(word, kind="stable")
            word, doc, weight = word[by_word], doc[by_word], weight[by_word]
            if n_docs < len(ids):   # rows of one (word, document) add up
                key, at = np.unique(word * n_docs + doc, return_inverse=True)
                weight = np.bincount(at, weights=weight, minlength=len(key))
                word, doc = key // n_docs, (key % n_docs).astype(np.int32)
            known, begin = np.unique(word, return_index=True)
            end = np.append(begin[1:], len(word))

            qword, qidf = flat(queries, "wids", np.int64), flat(queries, "idfs", np.float64)
            at = np.searchsorted(known, qword)
            hit = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == qword)
            stops = np.cumsum(sizes(queries, "wids"))
            # a frequent word's weights as one array over all documents of the block
            often = np.flatnonzero((end - begin) * 4 >= n_docs)
            whole = {}
            for w in often:
                whole[w] = np.zeros(n_docs)
                whole[w][doc[begin[w]:end[w]]] = weight[begin[w]:end[w]]
            lanes = n_docs // 64
            tie = 0.0 if digits is None else 1.01 * 10.0 ** -digits
            acc, start = np.zeros(n_docs), 0
            for i, stop in enumerate(stops):
                mine, idf = at[start:stop][hit[start:stop]], qidf[start:stop][hit[start:stop]]
                start = stop
                if not len(mine):
                    continue
                for w, x in zip(mine, idf):
                    if w in whole:
                        acc += x * whole[w]
                    else:
                        acc[doc[begin[w]:end[w]]] += x * weight[begin[w]:end[w]]
                if not idf.min() > 0:   # a document that was hit may have a sum of zero
                    found = np.unique(np.concatenate([doc[begin[w]:end[w]] for w in mine]))
                elif lanes >= k:        # at least k documents have the k-th best of the lanes' maxima or more
                    best = np.partition(acc[:lanes * 64].reshape(lanes, 64).max(axis=1), lanes - k)[lanes - k]
                    found = np.flatnonzero(acc >= best - tie if best > tie else acc)
                else:
                    found = np.flatnonzero(acc)
                s = acc[found]
                acc.fill(0.0)
                if len(s) > k:
                    near = s >= np.partition(s, len(s) - k)[len(s) - k] - tie
                    found, s = found[near], s[near]
                if digits is not None:
                    s = np.floor(s * 10.0 ** digits + 0.5) / 10.0 ** digits
                best = np.lexsort((found, -s))[:k]
                got_q.append(np.full(len(best), i))
                got_d.append(first_row[found[best]])
                got_s.append(s[best])
        if not got_q:
            return pa.table({"query_id": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        return pa.table({"query_id": queries["query_id"].take(pa.array(np.concatenate(got_q))),
                         "doc_id": docs["doc_id"].take(pa.array(np.concatenate(got_d))),
                         "score": pa.array(np.concatenate(got_s))})
    return score


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _packed(index, qt: DataFrame, n: int, words: DataFrame, n_words: int, params: Params):
    """``doc_id, doc_len, wids, tfs`` of the documents, stored; ``word, idf``; and the average length."""
    if isinstance(index, SparseIndex) and index.vocabulary is None and index.profile == "basic":
        docs = _stored(index.packed(words, n_words), "bm25-documents")
        stats = corpus_stats(docs)
        dfs = docs.select(F.explode("wids").alias("wid")).groupBy("wid").agg(F.count(F.lit(1)).alias("num_docs"))
        return docs, idf(words.join(dfs, "wid"), stats), stats.first()["avg_doc_len"]
    index = _restricted(index, qt.select("word"), n)
    docs = (index.terms.select("doc_id", "doc_len", "word", F.col("tf").cast("int").alias("tf"))
            .join(bounded_broadcast(words, n_words, params.broadcast_max_rows), "word")
            .groupBy("doc_id", "doc_len").agg(F.collect_list(F.struct(F.col("wid").cast("int").alias("wid"), "tf")).alias("p"))
            .select("doc_id", "doc_len", F.col("p.wid").alias("wids"), F.col("p.tf").alias("tfs")))
    return _stored(docs, "bm25-documents"), index.idf, index.stats.first()["avg_doc_len"]


def bm25_best_by_block(qt: DataFrame, n: int, index: SparseIndex, params: Params = DEFAULT,
                       score_digits: int | None = 6) -> DataFrame:
    """R5 for a large batch: ``query_id, doc_id, score``, for every query a superset
    of its ``top_k`` documents.

    Queries and documents that share a word are pairs in the square of the
    input, so none is stored: the documents lie in blocks of a bounded number of
    postings, the queries in slices of a bounded number of words and results,
    and a task scores one slice against one block, a query at a time, and keeps
    its ``top_k`` documents of the block. What moves are the postings once per
    slice, the query words once per block, and those results: in the square of
    the input too, so the slices are taken in rounds that move about the
    postings once. A round leaves ``top_k`` rows a query and its shuffle files
    go before the next; the last is the caller's."""
    from quarry.operators.index import sequential_ids
    spark, k = qt.sparkSession, params.top_k
    words = sequential_ids(qt.select("word").distinct(), [F.col("word")], "wid")
    n_words = words.count()
    with shuffles_removed(spark):
        docs, idfs, avg = _packed(index, qt, n, words, n_words, params)
        known = _stored(words.join(idfs, "word").select("word", F.col("wid").cast("int"), "idf"), "bm25-words")
        size = docs.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum(F.size("wids")), F.lit(0)).alias("postings")).first()
        n_results = qt.select("query_id").distinct().count() * min(k, size["docs"])
        slices = max(1, -(-n // SLICE_TERMS), -(-n_results // SLICE_RESULTS))
        blocks = max(1, -(-size["postings"] // BLOCK_POSTINGS))
        mine = (qt.join(bounded_broadcast(known, n_words, params.broadcast_max_rows), "word")
                  .groupBy("query_id").agg(F.collect_list(F.struct("wid", "idf")).alias("p"))
                  .select("query_id", F.col("p.wid").alias("wids"), F.col("p.idf").alias("idfs"),
                          F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int").alias("slice")))
        dealt = docs.filter(F.size("wids") > 0).select(
            "doc_id", F.col("doc_len").cast("double").alias("doc_len"), "wids", "tfs",
            F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(avg).cast("double").alias("avg"))

        def scored(begin: int, end: int) -> DataFrame:
            # as many partitions as there are pairs, and not fewer for being small: the work is in the pairs
            parts = partitions_for(spark, blocks * (end - begin), 1)
            d = dealt.withColumn("slice", F.explode(F.sequence(F.lit(begin), F.lit(end - 1))))
            q = mine.filter(F.col("slice").between(begin, end - 1)).withColumn(
                "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            d, q = (x.repartition(parts, "block", "slice").groupBy("block", "slice") for x in (d, q))
            return d.cogroup(q).applyInArrow(_block_kernel(k, params.k1, params.b, score_digits),
                                             "query_id long, doc_id long, score double")

        each = max(1, ROUND_POSTINGS // max(1, size["postings"]))
        rounds = [(i, min(i + each, slices)) for i in range(0, slices, each)]
        if len(rounds) > 1:
            mine = _stored(mine, "bm25-queries")
        best = [_stored(top_k(scored(*r), k).select("query_id", "doc_id", "score"), "bm25-best") for r in rounds[:-1]]
    return reduce(DataFrame.unionByName, [*best, scored(*rounds[-1])])


def search_bm25(queries: DataFrame, index: SparseIndex, params: Params = DEFAULT,
                candidates: DataFrame | None = None, score_digits: int | None = 6) -> DataFrame:
    """Top-k BM25 per query, best first (B1 fixed): ``query_id, rank, doc_id, score``.
    A large batch is scored block by block (see ``bm25_best_by_block``)."""
    _check_k(params)
    if candidates is None:
        qt = query_terms(queries, index.profile).select("query_id", "word").cache()
        n = qt.count()
        if n > BATCH_TERMS:
            s = _threshold(bm25_best_by_block(qt, n, index, params, score_digits), params)
            return top_k(s, params.top_k).select("query_id", "rank", "doc_id", "score")
    s = _threshold(bm25_scores(queries, index, params, candidates, score_digits), params)
    return top_k(s, params.top_k).select("query_id", "rank", "doc_id", "score")


def tfidf_scores(queries: DataFrame, index: SparseIndex, params: Params = DEFAULT,
                 candidates: DataFrame | None = None, score_digits: int | None = 6) -> DataFrame:
    """R4 without the top-k: cosine of query vector and the doc vector restricted
    to the query's words (doc norm over matched words; query norm over all
    query words incl. OOV). Zero norm -> NULL score."""
    qterms = query_terms(queries, index.profile).cache()
    n = qterms.count()
    index = _restricted(index, qterms.select("word"), n)
    qw = query_weights(qterms, index, n, params)
    qw = bounded_broadcast(qw.select("query_id", "word", "qw"), n, params.broadcast_max_rows)
    qnorm = qw.groupBy("query_id").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
    post = _by_doc(index, index.terms.select("doc_id", "word", "tf"))
    j = qw.join(post, "word")
    if candidates is not None:
        j = j.join(checked_broadcast(candidates.select("query_id", "doc_id"), params.broadcast_max_rows),
                   ["query_id", "doc_id"], "left_semi")
    j = j.join(bounded_broadcast(index.idf, n, params.broadcast_max_rows), "word") \
         .withColumn("tf_idf", F.col("tf") * F.col("idf"))
    agg = j.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("qw") * F.col("tf_idf")).alias("dot"),
        F.sum(F.col("tf_idf") * F.col("tf_idf")).alias("dnorm2"))
    denom = F.col("qnorm") * F.sqrt("dnorm2")
    score = F.when(denom > 0, F.col("dot") / denom)
    return (agg.join(F.broadcast(qnorm), "query_id")
               .select("query_id", "doc_id", _round(score, score_digits).alias("score")))


def search_tfidf(queries: DataFrame, index: SparseIndex, params: Params = DEFAULT,
                 candidates: DataFrame | None = None, score_digits: int | None = 6) -> DataFrame:
    """Top-k TF-IDF cosine per query: ``query_id, rank, doc_id, score``."""
    _check_k(params)
    s = _threshold(tfidf_scores(queries, index, params, candidates, score_digits), params)
    return top_k(s, params.top_k).select("query_id", "rank", "doc_id", "score")


def attach_text(results: DataFrame, docs: DataFrame, params: Params = DEFAULT,
                bound_rows: int | None = None) -> DataFrame:
    """J9 + R14: add ``file, entry_id, text`` and span ``[0, len(text)]`` after top-k.

    ``bound_rows`` (e.g. queries x k) lets the result side be broadcast without
    running the search twice; without it AQE decides from measured sizes.
    """
    d = docs.select("doc_id", "file", "entry_id", "text")
    if bound_rows is not None:
        # the wanted ids can be the build side of a semi join (a left join's
        # left side cannot), so only k texts per query leave their partition;
        # the k rows per query are kept, the search runs once
        results = results.persist(StorageLevel.MEMORY_AND_DISK)
        ids = bounded_broadcast(results.select("doc_id").distinct(), bound_rows, params.broadcast_max_rows)
        d = d.join(ids, "doc_id", "left_semi")
    out = results.join(d, "doc_id", "left")
    return out.select(*results.columns, "file", "entry_id",
                      F.lit(0).cast("long").alias("span_start"),
                      F.length("text").cast("long").alias("span_end"), "text")


def _bm25_postings(qt_words: DataFrame, n: int, index, params: Params) -> DataFrame:
    """``doc_id, word, c`` — each posting of the batch's words with its BM25
    contribution, clustered by document (see ``_by_doc``)."""
    index = index.restrict(qt_words, n)
    reuse = (getattr(index, "stored_k1", None) == params.k1 and getattr(index, "stored_b", None) == params.b
             and hasattr(index, "vectors"))
    if reuse:
        return _by_doc(index, index.vectors.select("doc_id", "word", F.col("bm25").alias("c")))
    avg = index.stats.select("avg_doc_len").scalar()
    post = index.terms.select("doc_id", "word", "tf", "doc_len").join(
        bounded_broadcast(index.idf, n, params.broadcast_max_rows), "word")
    return _by_doc(index, post.select("doc_id", "word",
                                      bm25_expr("tf", "idf", "doc_len", avg, params.k1, params.b).alias("c")))


def search_bm25_maxscore(queries: DataFrame, index: SparseIndex, params: Params = DEFAULT,
                         score_digits: int | None = 6) -> DataFrame:
    """R5 with exact MaxScore pruning; same result as ``search_bm25``.

    A word's contribution to any document is at most ``ub(word)`` (its largest
    posting score). For each query a lower bound ``theta`` on its k-th best
    score comes from exactly scoring the documents of its highest-``ub`` word.
    Words whose ``ub`` values, taken from the smallest up, add up to less than
    ``theta`` are *non-essential*: a document holding only such words scores
    below ``theta`` and cannot enter the top k. So only the postings of the
    essential (rare, high-idf) words fan out to the queries; frequent words
    are read only for the surviving candidates. This removes the Zipf-head
    fan-out that dominates large batches. A margin covers score rounding.
    """
    _check_k(params)
    k = params.top_k
    qt = query_terms(queries, index.profile).select("query_id", "word").cache()
    n = qt.count()
    post = _bm25_postings(qt.select("word"), n, index, params).persist(StorageLevel.MEMORY_AND_DISK)
    ub = post.groupBy("word").agg(F.max("c").alias("ub"))                   # <= batch words
    qub = bounded_broadcast(qt, n, params.broadcast_max_rows).join(
        bounded_broadcast(ub, n, params.broadcast_max_rows), "word")        # query words without postings drop out
    qub = qub.cache()
    qw_b = bounded_broadcast(qub.select("query_id", "word"), n, params.broadcast_max_rows)

    def exact(cands: DataFrame) -> DataFrame:
        # (query, doc, word) for the query's own words, then a lookup of those
        # postings: rows = candidates x query length, no other fan-out
        j = cands.join(qw_b, "query_id").join(post, ["doc_id", "word"])
        s = j.groupBy("query_id", "doc_id").agg(F.sum("c").alias("score"))
        return s.withColumn("score", _round(F.col("score"), score_digits))

    # 1. probe: documents of each query's highest-ub word, scored exactly
    w_top = Window.partitionBy("query_id").orderBy(F.col("ub").desc(), F.col("word"))
    top_word = qub.withColumn("_r", F.row_number().over(w_top)).filter(F.col("_r") == 1).select("query_id", "word")
    probe = bounded_broadcast(top_word, n, params.broadcast_max_rows).join(post.select("doc_id", "word"), "word") \
        .select("query_id", "doc_id")
    ps = exact(probe)
    w_s = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id"))
    theta = (ps.withColumn("_r", F.row_number().over(w_s)).filter(F.col("_r") <= k)
               .groupBy("query_id").agg(F.min("score").alias("theta"), F.count(F.lit(1)).alias("_n"))
               .filter(F.col("_n") >= k).select("query_id", "theta"))
    # 2. essential words: drop the smallest-ub prefix whose sum stays below theta
    w_up = (Window.partitionBy("query_id").orderBy(F.col("ub").asc(), F.col("word"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    margin = 10.0 ** -(score_digits or 9)
    pref = qub.withColumn("_cum", F.sum("ub").over(w_up)).join(theta, "query_id", "left")
    essential = pref.filter(F.col("theta").isNull() | (F.col("_cum") >= F.col("theta") - margin)) \
                    .select("query_id", "word")
    # 3. candidates = documents with an essential word; exact scores; top-k
    cands = bounded_broadcast(essential, n, params.broadcast_max_rows).join(post.select("doc_id", "word"), "word") \
        .select("query_id", "doc_id").distinct()
    s = _threshold(exact(cands), params)
    return top_k(s, k).select("query_id", "rank", "doc_id", "score")
