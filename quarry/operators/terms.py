"""Term statistics.

Shuffle budget of the sparse build, per corpus:

* full build: the text is hash-partitioned by ``doc_id`` once; tokens, the
  ``(doc_id, word)`` counts and the document lengths are then computed
  locally (no further exchange);
* batch search: the text stays where it was read; only the rows of the
  batch's words (and one length row per document) move, clustered by
  ``doc_id``;
* ``df`` is a partial/final aggregate on ``word`` (one row per word and map
  task crosses the network);
* the ``idf`` join on ``word`` is left to AQE: it becomes a broadcast when the
  measured vocabulary is small, else a sort-merge join whose hot-word
  partitions AQE splits (skew join).

Corpus statistics are a single-row aggregate used as scalar subqueries.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.functions import text as T
from quarry.plans.util import partitions_for


def tokens(docs: DataFrame, profile: str = "basic", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, ..., tokens array<string>``.

    ``basic`` = lowercase, punctuation, whitespace split, stop words (JVM only).
    ``full``  = the whole normalisation chain; the token-level tail runs once
    per distinct token (see ``quarry.functions.vocab``), not per occurrence.
    """
    keep = [c for c in docs.columns if c != text_col]
    if profile == "basic":
        return docs.select(*keep, T.basic_tokens(F.col(text_col)).alias("tokens"))
    if profile == "full":
        from quarry.functions.vocab import normalise_token_arrays
        raw = docs.select(*keep, T.raw_tokens(F.col(text_col)).alias("raw"))
        return normalise_token_arrays(raw, "raw", keep)
    raise ValueError(f"unknown profile {profile!r}")


def doc_terms(docs: DataFrame, profile: str = "basic", text_col: str = "text") -> DataFrame:
    """COO term matrix ``doc_id, file, word, tf, doc_len``.

    ``doc_len`` is the token count of the row (functionally dependent on the
    document), carried through the aggregate instead of joined back.
    """
    tk = tokens(docs, profile, text_col)
    keys = [c for c in tk.columns if c != "tokens"]
    return (tk.select(*keys, F.size("tokens").cast("long").alias("doc_len"),
                      F.explode("tokens").alias("word"))
              .groupBy(*keys, "doc_len", "word")
              .agg(F.count(F.lit(1)).alias("tf")))


def doc_lengths(docs: DataFrame, profile: str = "basic", text_col: str = "text") -> DataFrame:
    """A4: ``doc_id, ..., doc_len`` (no shuffle)."""
    tk = tokens(docs, profile, text_col)
    keys = [c for c in tk.columns if c != "tokens"]
    return tk.select(*keys, F.size("tokens").cast("long").alias("doc_len"))


def corpus_stats(lengths: DataFrame) -> DataFrame:
    """One row ``corpus_size, avg_doc_len``."""
    return lengths.agg(F.count(F.lit(1)).alias("corpus_size"),
                       F.avg("doc_len").alias("avg_doc_len"))


def term_df(terms: DataFrame) -> DataFrame:
    """A2: ``word, num_docs`` (one row per (doc, word) in ``terms``)."""
    # Counting rows with tf > 0 (all of them) keeps ``tf`` referenced, so the
    # (doc, word) aggregate below stays identical to the one the postings use
    # and Spark reuses that exchange instead of tokenising the corpus again.
    return terms.groupBy("word").agg(F.count(F.when(F.col("tf") > 0, 1)).alias("num_docs"))


def idf(dfs: DataFrame, stats: DataFrame) -> DataFrame:
    """``word, idf = ln(N / df)`` (no smoothing)."""
    n = stats.select("corpus_size").scalar()   # one-row scalar subquery
    return dfs.select("word", F.log(n / F.col("num_docs")).alias("idf"))


def bm25_expr(tf, idf_c, doc_len, avg_len, k1: float, b: float):
    tf, idf_c, doc_len, avg_len = (F.col(x) if isinstance(x, str) else x
                                   for x in (tf, idf_c, doc_len, avg_len))
    return idf_c * tf * (k1 + 1) / (tf + k1 * (1 - b + b * doc_len / avg_len))


def sparse_vectors(terms: DataFrame, idf_df: DataFrame, stats: DataFrame,
                   params: Params = DEFAULT) -> DataFrame:
    """``doc_id, file, word, tf, doc_len, idf, tf_idf, bm25`` (J2 + arithmetic)."""
    avg = stats.select("avg_doc_len").scalar()   # one-row scalar subquery
    j = terms.join(idf_df, "word", "left")
    return j.select(
        *[c for c in terms.columns if c not in ("word", "tf", "doc_len")],
        "word", "tf", "doc_len", "idf",
        (F.col("tf") * F.col("idf")).alias("tf_idf"),
        bm25_expr("tf", "idf", "doc_len", avg, params.k1, params.b).alias("bm25"))


DOC_MARKER = ""  # word of the per-document length row (real words have length > 1)
DOCS_PER_TASK = 2_000  # a task's sums grow with its documents times the queries


class SparseIndex:
    """The corpus-level tables of the sparse model, built lazily from docs.

    ``vocabulary`` (a ``word`` column) restricts the term rows to those words
    before the ``(doc, word)`` aggregate: tf and df of a word depend only on
    that word's rows, so a search over raw documents shuffles only the rows
    of its query words. Document lengths and corpus statistics always cover
    the whole corpus (a map-only pass plus a one-row aggregate).
    """

    def __init__(self, docs: DataFrame, profile: str = "basic", params: Params = DEFAULT,
                 vocabulary: DataFrame | None = None, vocabulary_rows: int | None = None,
                 words: DataFrame | None = None):
        self.params = params
        self.words = words   # full profile: a vocabulary map that covers the corpus (token, words)
        self.profile = profile
        self.docs = docs
        self.vocabulary = vocabulary
        if profile == "full":
            self._init_full(docs, params, vocabulary, vocabulary_rows)
            return
        base = docs.select("doc_id", "text")
        parts = partitions_for(docs.sparkSession, docs.count(), DOCS_PER_TASK)
        if vocabulary is None:
            # full build: shuffle the compact text by document once; every
            # per-document step below is then local
            base = base.repartition(parts, "doc_id")
        tk = tokens(base, profile)
        keys = [c for c in tk.columns if c != "tokens"]
        self.keys = keys
        # One pass over the text: each document emits its term rows (only the
        # batch's words when ``vocabulary`` is given) plus one marker row
        # (word "") carrying its length. The aggregated result is persisted
        # (memory and disk, recomputable from lineage if an executor is lost),
        # so postings, df and corpus statistics all read it instead of
        # tokenising the text once per consumer.
        rows = tk.select(*keys, F.size("tokens").cast("long").alias("doc_len"),
                         F.explode(F.concat(F.array(F.lit(DOC_MARKER)), F.col("tokens"))).alias("word"))
        if vocabulary is not None:
            # batch search: the text stays where it was read; only the rows of
            # the batch's words (and the length rows) are moved, clustered by
            # document so the per-(query, doc) sums downstream stay local
            voc = vocabulary.select("word").distinct()
            n = vocabulary_rows if vocabulary_rows is not None else voc.count()
            if n <= self.params.broadcast_max_rows:
                # the hint goes on the union itself: below it, it would be lost
                marked = voc.unionByName(voc.sparkSession.range(1).select(F.lit(DOC_MARKER).alias("word")))
                rows = rows.join(F.broadcast(marked), "word", "left_semi")
            else:
                # no marker on a shuffled join key: the length rows bypass the join
                rows = rows.filter(F.col("word") == DOC_MARKER).unionByName(
                    rows.filter(F.col("word") != DOC_MARKER).join(voc, "word", "left_semi"))
            rows = rows.repartition(parts, "doc_id")
        counted = rows.groupBy(*keys, "doc_len", "word").agg(F.count(F.lit(1)).alias("tf")) \
                      .persist(StorageLevel.MEMORY_AND_DISK)
        self._counted = counted
        self.terms = counted.filter(F.col("word") != DOC_MARKER)
        self.lengths = counted.filter(F.col("word") == DOC_MARKER).select(*keys, "doc_len")
        self._finish()

    def unpersist(self) -> None:
        """Release the persisted term pass (long-running sessions)."""
        if getattr(self, "_counted", None) is not None:
            self._counted.unpersist()

    def _vocab(self, vocabulary, vocabulary_rows):
        from quarry.plans.util import bounded_broadcast, checked_broadcast
        voc = vocabulary.select("word").distinct()
        mx = self.params.broadcast_max_rows
        return (bounded_broadcast(voc, vocabulary_rows, mx) if vocabulary_rows is not None
                else checked_broadcast(voc, mx))

    def _init_full(self, docs, params, vocabulary, vocabulary_rows=None):
        # Full profile: JVM front per document, the token chain once per distinct
        # raw token (the map given, or made here and kept), and one join of the
        # documents' token counts with it. As in the basic profile every document
        # gets a marker row with its length beside its term rows, and with a
        # ``vocabulary`` only the tokens that become one of its words give any.
        from quarry.functions.vocab import token_counts, vocabulary_map
        self._tok = None
        self.keys = ["doc_id"]
        # tasks of a bounded number of documents, whose counts are local
        parts = partitions_for(docs.sparkSession, docs.count(), DOCS_PER_TASK)
        mine = docs.select("doc_id", "text").repartition(parts, "doc_id")
        counts = token_counts(mine.select("doc_id", T.raw_tokens(F.col("text")).alias("raw")), ["doc_id"])
        if self.words is None:
            self.words = vocabulary_map(counts, "token").persist(StorageLevel.MEMORY_AND_DISK)
        words = self.words
        if vocabulary is not None:
            each = words.select("token", F.explode("words").alias("word"))
            hits = each.join(self._vocab(vocabulary, vocabulary_rows), "word", "left_semi") \
                       .groupBy("token").agg(F.collect_list("word").alias("hits"))
            words = words.join(hits, "token", "left").select(
                "token", F.size("words").alias("n"), F.coalesce("hits", F.array().cast("array<string>")).alias("words"))
        else:
            words = words.withColumn("n", F.size("words"))
        marked = F.concat(F.array(F.struct(F.lit(DOC_MARKER).alias("word"), F.col("n").alias("k"))),
                          F.transform("words", lambda w: F.struct(w.alias("word"), F.lit(1).alias("k"))))
        # each task holds its tokens of the map and lets the counts pass, a frequent
        # token's too; the rows then go back to their documents
        found = counts.repartition(parts, "token").join(words.repartition(parts, "token").hint("shuffle_hash"), "token")
        rows = (found.select("doc_id", "rtf", "n", "words").repartition(parts, "doc_id")
                     .select("doc_id", "rtf", F.explode(marked).alias("r")))
        counted = rows.groupBy("doc_id", F.col("r.word").alias("word")).agg(
            F.sum(F.col("rtf") * F.col("r.k")).alias("tf")).persist(StorageLevel.MEMORY_AND_DISK)
        self._counted = counted
        per_doc = counted.filter(F.col("word") == DOC_MARKER).select("doc_id", F.col("tf").alias("doc_len"))
        self.lengths = (docs.select("doc_id").join(per_doc, "doc_id", "left")
                            .select("doc_id", F.coalesce("doc_len", F.lit(0)).cast("long").alias("doc_len")))
        self.terms = counted.filter(F.col("word") != DOC_MARKER).join(per_doc.hint("shuffle_hash"), "doc_id").select(
            "doc_id", F.col("doc_len").cast("long"), "word", F.col("tf").cast("long"))
        self._finish()

    def _finish(self):
        self.stats = corpus_stats(self.lengths)
        self.df = term_df(self.terms)
        self.idf = idf(self.df, self.stats)

    def restrict(self, vocabulary: DataFrame, vocabulary_rows: int | None = None) -> "SparseIndex":
        """Same corpus, term rows limited to ``vocabulary`` words."""
        return SparseIndex(self.docs, self.profile, self.params, vocabulary, vocabulary_rows, self.words)

    def packed(self, words: DataFrame, n: int) -> DataFrame:
        """``doc_id, doc_len, wids, tfs`` (basic profile): one row per document with
        its counts of ``words(word, wid)``, ``n`` distinct words; documents without
        any have empty arrays. For a batch whose words are most of the corpus: the
        text moves, once, as its tokens in rows of their own take several times the
        room, and neither those rows nor the counts are kept."""
        parts = partitions_for(self.docs.sparkSession, self.docs.count(), DOCS_PER_TASK)
        tk = tokens(self.docs.select("doc_id", "text").repartition(parts, "doc_id"), self.profile)
        rows = tk.select("doc_id", F.size("tokens").cast("long").alias("doc_len"),
                         F.explode(F.concat(F.array(F.lit(DOC_MARKER)), F.col("tokens"))).alias("word"))
        if n <= self.params.broadcast_max_rows:
            end = words.sparkSession.range(1).select(F.lit(DOC_MARKER).alias("word"), F.lit(-1).alias("wid"))
            rows = rows.join(F.broadcast(words.select("word", F.col("wid").cast("int")).unionByName(end)), "word")
            counted = rows.groupBy("doc_id", "doc_len", "wid").agg(F.count(F.lit(1)).cast("int").alias("tf"))
        else:
            # counts, not tokens, meet the words; the length rows bypass the join
            rows = rows.groupBy("doc_id", "doc_len", "word").agg(F.count(F.lit(1)).cast("int").alias("tf"))
            found = rows.filter(F.col("word") != DOC_MARKER).join(
                words.select("word", F.col("wid").cast("int")).hint("merge"), "word")
            counted = rows.filter(F.col("word") == DOC_MARKER).withColumn("wid", F.lit(-1)).unionByName(found).drop("word")
        pair = F.when(F.col("wid") >= 0, F.struct("wid", "tf"))   # a list takes no nulls
        return counted.groupBy("doc_id", "doc_len").agg(F.collect_list(pair).alias("p")).select(
            "doc_id", "doc_len", F.col("p.wid").alias("wids"), F.col("p.tf").alias("tfs"))

    @property
    def vectors(self) -> DataFrame:
        return sparse_vectors(self.terms, self.idf, self.stats, self.params)


# ---- filters and small aggregates ------------------------------------------------

def first_char_bucket(word, digits: bool = True):
    """'0-9a-z' (or 'a-z') first character, else 'other'."""
    w = F.col(word) if isinstance(word, str) else word
    first = F.substring(w, 1, 1)
    cls = "^[0-9a-z]$" if digits else "^[a-z]$"
    return F.when(first.rlike(cls), first).otherwise(F.lit("other"))


def vocabulary_profile(dfs: DataFrame) -> DataFrame:
    """Words per starting-character bucket (with digit/alpha flags)."""
    b = first_char_bucket("word")
    return (dfs.groupBy(b.alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n_words"),
                    F.sum(F.when(F.col("word").rlike("^[0-9]"), 1).otherwise(0)).cast("long").alias("n_digit_start"),
                    F.sum(F.when(F.col("word").rlike("^[a-z]"), 1).otherwise(0)).cast("long").alias("n_alpha_start")))


def df_curve(dfs: DataFrame, top_n: int | None = None) -> DataFrame:
    """Rank of each word by df (desc, then word).

    Computed as a global sort (range-partitioned) + rank by partition offsets
    (see ``quarry.operators.index.dense_rank_by``), not a single-partition window.
    """
    from quarry.operators.index import sequential_ids
    ranked = sequential_ids(dfs, [F.desc("num_docs"), F.asc("word")], "df_rank")
    if top_n is not None:
        ranked = ranked.filter(F.col("df_rank") <= top_n)
    return ranked


def partial_maps(terms: DataFrame, block: int) -> DataFrame:
    """A3, per file: ``file, word, block, total_tf, num_docs, postings`` from
    ``file, doc_id, word, tf``. A block holds one range of ``block`` document
    ids, so no word's list grows with the corpus. Rows are dealt by word and
    block, so the merge across files finds its lists where they were made."""
    at = F.floor(F.col("doc_id") / block).cast("long")
    return terms.withColumn("block", at).repartition("word", "block").groupBy("file", "word", "block").agg(
        F.sum("tf").cast("long").alias("total_tf"), F.count(F.lit(1)).alias("num_docs"),
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))


def merge_maps(parts: DataFrame) -> DataFrame:
    """A3, across files: ``word, block, total_tf, num_docs, docs, tfs``; counts
    are added, document maps united, vectors concatenated in document order."""
    one = parts.groupBy("word", "block").agg(
        F.sum("total_tf").cast("long").alias("total_tf"), F.sum("num_docs").cast("long").alias("num_docs"),
        F.sort_array(F.flatten(F.collect_list("postings"))).alias("p"))
    return one.select("word", "block", "total_tf", "num_docs", F.col("p.doc_id").alias("docs"), F.col("p.tf").alias("tfs"))


def normalised_tf(terms: DataFrame) -> DataFrame:
    """``tf / doc_len`` (doc_len = Σ tf, carried on each row)."""
    return terms.withColumn("ntf", F.col("tf") / F.col("doc_len"))
