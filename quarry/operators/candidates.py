"""Candidate generation strategies.

``candidates(queries, index, strategy)`` returns ``query_id, doc_id``:

* ``inverted_index``   — every document with any query word (OR).
* ``trie``             — the same for words of at most ``max_word_len``
  characters, located through the vocabulary chunk ranges (bucket + range).
* ``weighted_doc_idf`` — documents whose matched query words' idf sum
  exceeds ``doc_idf_mass_min``.
* ``word_idf_filter``  — OR over the query words with idf below
  ``word_idf_max`` (the common words).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.operators import index as IX
from quarry.operators import search as S
from quarry.operators.terms import SparseIndex
from quarry.plans.util import bounded_broadcast

def prefix_matches(prefixes: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """I8: ``prefix, word`` for every word of ``vocabulary(word)`` that begins
    with one of ``prefixes(prefix)``.

    Each vocabulary word offers its own prefixes of the lengths asked for, so
    the match is an equality join on vocabulary-sized rows (no range or
    nested-loop join), whatever the length of the prefixes.
    """
    lengths = prefixes.agg(F.array_sort(F.collect_set(F.length("prefix"))).alias("n")).scalar()
    own = vocabulary.select("word", F.explode(lengths).alias("n")).filter("n > 0 and n <= length(word)").select("word", F.expr("left(word, n)").alias("prefix"))
    return prefixes.filter("prefix <> ''").join(own, "prefix").select("prefix", "word")


STRATEGIES = ("inverted_index", "trie", "weighted_doc_idf", "word_idf_filter")


def candidates(queries: DataFrame, index: SparseIndex, strategy: str = "inverted_index",
               params: Params = DEFAULT, chunk_words: int | None = None) -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; one of {STRATEGIES}")
    qt = S.query_terms(queries, index.profile).cache()
    n = qt.count()
    qw = bounded_broadcast(qt.select("query_id", "word"), n, params.broadcast_max_rows)
    # postings of the batch's words only (tf/df of a word need only its rows)
    small = index.restrict(qt.select("word"), n)
    post = small.terms.select("doc_id", "word")
    if strategy == "inverted_index":
        return qw.join(post, "word").select("query_id", "doc_id").distinct()
    if strategy == "trie":
        short = qw.filter(F.length("word") <= params.max_word_len)
        # chunk boundaries come from the whole vocabulary (the stored shard map)
        chunks = IX.vocab_chunks(index.df, chunk_words or params.vocab_chunk_words)
        located = IX.words_to_chunks(short, chunks).select("query_id", "word")
        return bounded_broadcast(located, n, params.broadcast_max_rows).join(post, "word") \
            .select("query_id", "doc_id").distinct()
    if strategy == "weighted_doc_idf":
        short = qw.filter(F.length("word") <= params.max_word_len)
        idf = bounded_broadcast(small.idf, n, params.broadcast_max_rows)
        mass = (short.join(post, "word").join(idf, "word")
                     .groupBy("query_id", "doc_id").agg(F.sum("idf").alias("idf_mass")))
        return mass.filter(F.col("idf_mass") > params.doc_idf_mass_min).select("query_id", "doc_id")
    weights = S.query_weights(qt, small, bound_rows=n, params=params)
    common = weights.filter(F.col("idf") < params.word_idf_max).select("query_id", "word")
    return bounded_broadcast(common, n, params.broadcast_max_rows).join(post, "word") \
        .select("query_id", "doc_id").distinct()
