"""Benchmark decontamination over a distributed positional inverted index.

Index: every corpus token that occurs in the benchmark's vocabulary becomes a
posting ``(term, doc_id, h, pos)``. Each task writes the postings of its own
documents sorted by term - a segment - so building needs no shuffle and a
term's list is a few contiguous runs of the stored table. An end-of-document
posting (term 0) holds each document's length.

Search: a phrase reads only its ``lists`` rarest terms. Their lists are moved
by the term's offset in the phrase and intersected on (document, start); with
``slop`` the further lists may be off by that many places. The survivors are
checked against the documents' words: all words at their places (phrase), or
each within ``slop`` of its place (proximity).

Rows sharing ``doc_id`` and text are one document (each is returned). Defined
cases: null or empty text has no words; items without words have no windows;
an item of fewer words than a window is one window; repeated items and windows
count once; items without id mark words as hit but are not counted; empty
tables give no windows or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_BYTES, ascii_lower, materialise, small, text_hash

WINDOW_WORDS = 10
#: Rarest terms whose lists are intersected before the check on the text.
LISTS = 2
#: Everything but ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``; A-Z are lower-cased before.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_END = "\x00"  # never a word


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS, -1), "")


def phrases(items: DataFrame, window: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(win, words)`` of the distinct windows, and ``(win, item)`` of who has them."""
    w = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("ws")).filter("size(ws) > 0")
    at = F.explode(F.when(F.size("ws") > window, F.sequence(F.lit(1), F.size("ws") - window + 1)).otherwise(F.array(F.lit(1))))
    w = w.select("item", "ws", at.alias("at")).select("item", F.slice("ws", F.col("at"), F.lit(window)).alias("words")).distinct()
    w = materialise(w, "phrase-items")
    wins = materialise(w.select("words").distinct().withColumn("win", F.monotonically_increasing_id()), "phrases")
    return wins, materialise(w.join(wins, "words").select("win", "item"), "phrase-owners")


def vocabulary(wins: DataFrame) -> DataFrame:
    """``(word, term)``: the windows' words with ids from 1, and the end marker as 0."""
    spark = wins.sparkSession
    own = wins.select(F.explode("words").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id() + 1)
    end = spark.range(1).select(F.lit(_END).alias("word"), F.lit(0).cast("long").alias("term"))
    return materialise(own.unionByName(end), "vocabulary")


def build_index(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """The stored postings ``term, doc_id, h, pos``, one sorted segment per task."""
    tokens = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text").cast("string")).alias("h"),
                         F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(_END)))).alias("pos", "token"))
    v = small(vocab, 64)
    hits = tokens.join(v, tokens["token"] == v["word"]).select("term", "doc_id", "h", "pos")
    return materialise(hits.sortWithinPartitions("term"), "postings")


def rarest(wins: DataFrame, vocab: DataFrame, index: DataFrame, lists: int = LISTS) -> DataFrame:
    """``term, win, len, off, need``: the lists each window reads, rarest terms first.

    Windows with a word that no document has are gone.
    """
    cf = index.groupBy("term").agg(F.count("*").alias("cf"))
    cf = materialise(vocab.join(cf, "term", "left").select("word", "term", F.coalesce("cf", F.lit(0)).alias("cf")), "term-counts")
    t = wins.select("win", F.size("words").alias("len"), F.posexplode("words").alias("off", "word")).join(small(cf, 80), "word")
    t = t.groupBy("win", "len").agg(F.min("cf").alias("least"),
                             F.slice(F.array_sort(F.collect_list(F.struct("cf", "off", "term"))), 1, lists).alias("t"))
    return t.filter("least > 0").select("win", "len", F.size("t").alias("need"), F.explode("t").alias("t")).select(
        F.col("t.term").alias("term"), "win", "len", F.col("t.off").alias("off"), "need")


def matches(docs: DataFrame, index: DataFrame, wins: DataFrame, vocab: DataFrame,
            slop: int = 0, lists: int = LISTS) -> DataFrame:
    """``doc_id, h, win, start, len, exact``: phrase and (``slop`` > 0) proximity matches.

    A proximity match has every word of the phrase within ``slop`` places of
    where the phrase beginning at ``start`` would have it; ``start`` is given
    by the place of the phrase's rarest word.
    """
    probes = materialise(rarest(wins, vocab, index, lists), "probes")
    p = small(probes, 44).withColumnRenamed("term", "p_term")
    found = index.join(p, index["term"] == p["p_term"]).select(
        "doc_id", "h", "win", "len", "need", "off", (F.col("pos") - F.col("off")).alias("start"))
    if slop:
        # the rarest list stays as it is, the others are spread; which is which follows from the probes
        lead = _lead(probes, index, vocab)
        found = found.join(small(lead, 16).withColumnRenamed("win", "l_win"), (F.col("win") == F.col("l_win"))
                           & (F.col("off") == F.col("l_off")), "left")
        spread = F.when(F.col("l_win").isNotNull(), F.array("start")).otherwise(
            F.sequence(F.col("start") - slop, F.col("start") + slop))
        found = found.withColumn("is_lead", F.col("l_win").isNotNull()).select(
            "doc_id", "h", "win", "len", "need", "off", "is_lead", F.explode(spread).alias("start"))
        both = found.groupBy("doc_id", "h", "win", "len", "start").agg(
            F.size(F.collect_set("off")).alias("got"), F.max("need").alias("need"), F.max("is_lead").alias("led"))
        both = both.filter("got = need and led")
    else:
        # a start has a term's posting once, so counting rows counts lists; repeated rows only raise it
        both = found.filter("start >= 0").groupBy("doc_id", "h", "win", "len", "start").agg(
            F.count("*").alias("got"), F.max("need").alias("need")).filter("got >= need")
    per = both.groupBy(F.col("doc_id").alias("c_id"), F.col("h").alias("c_h")).agg(
        F.collect_list(F.struct("win", "start", "len")).alias("cands"))
    per = materialise(per, "candidates")
    n = per.agg(F.sum(F.size("cands"))).first()[0] or 0
    per = F.broadcast(per) if n * 28 <= BROADCAST_BYTES else per
    text = F.col("text").cast("string")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(text).alias("h"), text.alias("text"))
    cand = src.join(per, src["doc_id"].eqNullSafe(per["c_id"]) & (src["h"] == per["c_h"]))
    cand = cand.select("doc_id", "h", words(F.col("text")).alias("ws"), "cands")
    # a candidate carries the words of its own place only, never its document's
    first = lambda c: F.greatest(c["start"] - slop, F.lit(0))
    own = F.transform("cands", lambda c: F.struct(
        c["win"].alias("win"), c["start"].alias("start"),
        F.when(first(c) < F.size("ws"), F.slice("ws", first(c) + 1, c["start"] + c["len"] + slop - first(c)))
         .otherwise(F.array().cast("array<string>")).alias("here")))
    cand = cand.select("doc_id", "h", F.explode(own).alias("c")).select("doc_id", "h", "c.win", "c.start", "c.here")
    w = small(wins, 400).select(F.col("win").alias("w_win"), F.col("words").alias("pw"))
    j = cand.join(w, F.col("win") == F.col("w_win"))
    at = F.col("start") - F.greatest(F.col("start") - slop, F.lit(0))  # the start's place in ``here``
    exact = F.when(at >= 0, F.slice("here", F.greatest(at + 1, F.lit(1)), F.size("pw")) == F.col("pw")).otherwise(False)
    if slop:
        near = F.forall(F.transform("pw", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: F.array_contains(
            F.slice("here", F.greatest(at + s["i"] - slop + 1, F.lit(1)),
                    F.greatest(F.lit(0), F.lit(2 * slop + 1) + F.least(at + s["i"] - slop, F.lit(0)))), s["x"]))
        j = j.filter(near)
    else:
        j = j.filter(exact)
    return j.select("doc_id", "h", "win", "start", F.size("pw").alias("len"), exact.alias("exact")).distinct()


def _lead(probes: DataFrame, index: DataFrame, vocab: DataFrame) -> DataFrame:
    """``win, l_off``: the rarest of each window's lists."""
    cf = index.groupBy("term").agg(F.count("*").alias("cf"))
    lead = probes.join(cf, "term").groupBy("win").agg(F.min(F.struct("cf", "off")).alias("m"))
    return materialise(lead.select("win", F.col("m.off").alias("l_off")), "lead-lists")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, lists: int = LISTS) -> DataFrame:
    """``doc_id, h, n_words, n_hit, items`` for every row of ``docs(doc_id, text)``;
    ``items`` are the sorted ids of the items with a window in the document."""
    wins, owners = phrases(items, window)
    vocab = vocabulary(wins)
    index = build_index(docs, vocab)
    m = materialise(matches(docs, index, wins, vocab, 0, lists), "matches")
    fold = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "len"))),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["start"] + x["len"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["start"] + x["len"] - F.greatest(a["end"], x["start"]))).alias("n")),
        lambda a: a["n"])
    hit = m.groupBy(F.col("doc_id").alias("m_id"), F.col("h").alias("m_h")).agg(fold.alias("n_hit"))
    own = small(owners, 64).withColumnRenamed("win", "o_win")
    ids = m.select("doc_id", "h", "win").distinct().join(own, F.col("win") == F.col("o_win")).groupBy(
        F.col("doc_id").alias("i_id"), F.col("h").alias("i_h")).agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = index.filter("term = 0").select("doc_id", "h", F.col("pos").cast("long").alias("n_words"))
    out = out.join(hit, out["doc_id"].eqNullSafe(hit["m_id"]) & (out["h"] == hit["m_h"]), "left")
    out = out.join(ids, F.col("doc_id").eqNullSafe(F.col("i_id")) & (F.col("h") == F.col("i_h")), "left")
    return out.select("doc_id", "h", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns kept."""
    bad = materialise(contamination(docs, items, window).filter("n_hit > 0").select(
        F.col("doc_id").alias("__b_id"), F.col("h").alias("__b_h")).distinct(), "contaminated")
    bad = small(bad, 48)
    keyed = docs.withColumn("__b_key", text_hash(docs["text"].cast("string")))
    return keyed.join(bad, keyed["doc_id"].cast("long").eqNullSafe(F.col("__b_id")) & (F.col("__b_key") == F.col("__b_h")),
                      "left_anti").select(*docs.columns)
