"""Sampling and retrieval evaluation.

Randomness is a hash of (seed, key): ``u = (md5 prefix + 0.5) / 2^32``, so a
sample is reproducible, independent of partitioning, and the same numbers can
be produced by any SQL engine with md5.

Weighted sampling without replacement (Efraimidis-Spirakis): each item gets
the key ``-ln(u) / w`` and the n smallest keys win; a global
``orderBy(key).limit(n)`` runs as a per-partition top-n plus a final merge.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarry.config import BOILERPLATE_MARKERS, DEFAULT, Params, WS_PATTERN
from quarry.functions import text as T


def hashed_uniform(seed: int, *cols) -> Column:
    key = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0


def es_key(seed: int, weight: Column, *cols) -> Column:
    return -F.log(hashed_uniform(seed, *cols)) / weight


def weighted_sample(lengths: DataFrame, n: int, seed: int, key: str = "doc_id",
                    length_col: str = "doc_len") -> DataFrame:
    """N documents without replacement, p ~ ln(length); length <= 1 has
    weight 0 and is never drawn. ``key, sample_rank``."""
    w = F.log(F.col(length_col))
    cand = lengths.filter(F.col(length_col) > 1).withColumn("_k", es_key(seed, w, key))
    top = cand.orderBy(F.col("_k").asc(), F.col(key).asc()).limit(n)
    # n rows: a window over them is tiny
    return top.select(key, F.row_number().over(Window.orderBy(F.col("_k").asc(), F.col(key).asc()))
                      .cast("long").alias("sample_rank"))


def paragraph_weights(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """T16 + T15 + weights: ``doc_id, para_no, paragraph, weight``; boilerplate
    paragraphs get ``ceil(len * 0.01)``."""
    p = docs.select("doc_id", F.posexplode(T.paragraphs(text_col)).alias("para_no", "raw"))
    p = p.select("doc_id", F.col("para_no").cast("long"), T.scrub_markup("raw").alias("paragraph"))
    is_bp = F.lit(False)
    for m in BOILERPLATE_MARKERS:
        is_bp = is_bp | F.col("paragraph").contains(m)
    ln = F.length("paragraph")
    return p.withColumn("weight", F.when(is_bp, F.ceil(ln * 0.01)).otherwise(ln).cast("double"))


def sample_paragraph(docs: DataFrame, seed: int, text_col: str = "text") -> DataFrame:
    """One paragraph per document, p ~ weight: ``doc_id, para_no, paragraph``."""
    pw = paragraph_weights(docs, text_col).filter(F.col("weight") > 0)
    keyed = pw.withColumn("_k", es_key(seed, F.col("weight"), "doc_id", "para_no"))
    # per document: min key (a partial/final aggregate, no per-doc window)
    best = keyed.groupBy("doc_id").agg(F.min(F.struct("_k", "para_no", "paragraph")).alias("b"))
    return best.select("doc_id", F.col("b.para_no").alias("para_no"), F.col("b.paragraph").alias("paragraph"))


def first_sentence(c) -> Column:
    """U5 default question generator: the first sentence of the passage."""
    return F.regexp_extract(F.col(c) if isinstance(c, str) else c, "^[^.!?]*[.!?]?", 0)


def generate_questions(passages: DataFrame, text_col: str = "paragraph",
                       build: Callable[[], Callable] | None = None, out: str = "query") -> DataFrame:
    """``passages`` with a question for each in ``out``.

    A model is a plug-in: ``build()`` loads it once per worker task and returns a
    function ``list of texts -> list of questions`` that is fed Arrow batches (a
    null text gets no question). Without one the first sentence is the question.
    """
    if build is None:
        return passages.withColumn(out, first_sentence(text_col))
    schema = StructType([*passages.schema.fields, StructField(out, StringType())])

    def ask(batches):
        fn = None
        for b in batches:
            fn = fn or build()
            known = b[text_col].notna()
            asked = pd.Series([None] * len(b), index=b.index, dtype=object)
            asked[known] = fn(b.loc[known, text_col].tolist())
            yield b.assign(**{out: asked})

    return passages.mapInPandas(ask, schema)


def known_item_truth(items: DataFrame, docs: DataFrame, params: Params = DEFAULT,
                     probes: int = 2) -> DataFrame:
    """E4 truth: ``query_id, doc_id`` where the document contains the item text
    verbatim.

    No (item, document) product: an item's interior whitespace tokens must be
    whole tokens of any containing document, so its ``probes`` rarest interior
    tokens select the candidates (joins on the token), and ``contains`` is then
    checked on those pairs only; texts without a candidate stay where they are.
    Items of fewer than three tokens have no interior token: their longest one
    must be part of a token of the document (``_short_candidates``).
    """
    toks = F.filter(F.split(F.lower("query"), WS_PATTERN), lambda w: w != "")
    it = items.select("query_id", "query", toks.alias("t"))
    short = it.filter((F.size("t") < 3) & (F.size("t") > 0)).select("query_id", "query")
    it = it.filter(F.size("t") >= 3)
    itok = it.select("query_id", F.explode(F.array_distinct(F.slice("t", 2, F.size("t") - 2))).alias("token")).cache()
    n_tok = itok.count()
    from quarry.plans.util import bounded_broadcast
    vocab = bounded_broadcast(itok.select("token").distinct(), n_tok, params.broadcast_max_rows)
    # one pass over the text: the (doc, token) rows of the items' tokens only,
    # persisted because both the token df and the candidate join read them
    dtok = (docs.select("doc_id", F.explode(F.array_distinct(
                F.filter(F.split(F.lower("text"), WS_PATTERN), lambda w: w != ""))).alias("token"))
               .join(vocab, "token", "left_semi")
               .persist(StorageLevel.MEMORY_AND_DISK))
    df = dtok.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    w = Window.partitionBy("query_id").orderBy(F.col("df").asc(), F.col("token").asc())
    chosen = (itok.join(df, "token").withColumn("_r", F.row_number().over(w))
                  .filter(F.col("_r") <= probes).drop("_r"))
    need = chosen.groupBy("query_id").agg(F.count(F.lit(1)).alias("need"))
    cand = (chosen.select("query_id", "token").join(dtok, "token")
                  .groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("have"))
                  .join(need, "query_id").filter(F.col("have") == F.col("need"))
                  .select("query_id", "doc_id"))
    if not short.isEmpty():
        cand = cand.unionByName(_short_candidates(short, docs))
    cand = cand.checkpoint()
    # only the texts of candidates meet the pairs
    wanted = bounded_broadcast(cand.select("doc_id").distinct(), cand.count(), params.broadcast_max_rows)
    return (cand.join(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), "doc_id")
                .join(items.select("query_id", "query"), "query_id")
                .filter(F.col("text").contains(F.col("query")))
                .select("query_id", "doc_id"))


def _short_candidates(short: DataFrame, docs: DataFrame) -> DataFrame:
    """``query_id, doc_id`` of the documents with a token that holds the item's longest token.

    The distinct tokens of the corpus meet the items on a gram (the first three
    characters of the item's token, or all of a shorter one) and are then
    compared; the documents follow by their tokens.
    """
    of = lambda c: F.array_distinct(F.filter(F.split(c, WS_PATTERN), lambda w: w != ""))
    probe = F.array_max(F.transform(of("query"), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    probes = short.select("query_id", probe.alias("probe")).withColumn("gram", F.substring("probe", 1, 3))
    tokens = docs.select("doc_id", F.explode(of("text")).alias("token"))
    chars = tokens.select("token").distinct().select("token", F.split("token", "").alias("c"))
    three = F.transform("c", lambda x, i: F.array_join(F.slice("c", i + 1, 3), ""))
    grams = chars.select("token", F.explode(F.array_distinct(F.flatten(F.transform(three, lambda g: F.array(
        F.substring(g, 1, 1), F.substring(g, 1, 2), g))))).alias("gram"))
    hits = grams.join(probes, "gram").filter(F.col("token").contains(F.col("probe"))).select("query_id", "token").distinct()
    return tokens.join(hits, "token").select("query_id", "doc_id").distinct()


def hit_positions(results: DataFrame, truth: DataFrame) -> DataFrame:
    """``query_id, hit_rank`` (best rank of any true document; NULL if
    none was returned) for every query that has a true document."""
    hits = results.join(truth, ["query_id", "doc_id"]).groupBy("query_id").agg(F.min("rank").alias("hit_rank"))
    return truth.select("query_id").distinct().join(hits, "query_id", "left")


def recall(results: DataFrame, truth: DataFrame, ns=(5, 10, 25)) -> DataFrame:
    """``n_queries, recall_at_<n>..., recall_at_all`` (mean over queries)."""
    pos = hit_positions(results, truth)
    aggs = [F.count(F.lit(1)).alias("n_queries")]
    for n in ns:
        aggs.append(F.round(F.avg(F.when(F.col("hit_rank") <= n, 1.0).otherwise(0.0)), 6).alias(f"recall_at_{n}"))
    aggs.append(F.round(F.avg(F.when(F.col("hit_rank").isNotNull(), 1.0).otherwise(0.0)), 6).alias("recall_at_all"))
    return pos.agg(*aggs)
