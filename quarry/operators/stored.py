"""A sparse index built once and queried many times (the deployment layout).

    <path>/terms   doc_id, word, tf, doc_len, idf, tf_idf, bm25
                                                partitioned by shard = hash(word) mod n
                                                rows sorted by (word, doc_id) inside files
    <path>/df      word, num_docs               partitioned the same way
    <path>/stats   corpus_size, avg_doc_len     one row
    <path>/meta    profile, k1, b, n_shards     one row

A query batch only reads the shards of its words (a partition filter on the
batch's shard ids, then a semi join on ``(shard, word)`` against the
broadcast query vocabulary); inside a shard the word-sorted files let
parquet statistics skip row groups. ``StoredIndex``
has the same attributes as ``SparseIndex``, so every search function works
on either. Scores with other ``k1``/``b`` than the stored ones are computed
from ``tf``/``doc_len``/``idf`` at query time (R6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params
from quarry.operators.terms import SparseIndex, idf as idf_of, sparse_vectors
from quarry.plans.util import checked_broadcast, partitions_for

IDF_BROADCAST_ROWS = 500_000
ROWS_PER_TASK = 1_000_000


def shard_of(word, n_shards: int):
    w = F.col(word) if isinstance(word, str) else word
    return F.pmod(F.xxhash64(w), F.lit(n_shards)).cast("int")


def build(index: SparseIndex, path: str, n_shards: int = 64) -> None:
    """Write the index; every part is a whole-table overwrite (safe to rerun)."""
    # the sparse-vector rows (D10): tf, doc_len, idf, tf_idf and bm25 under
    # the index's k1/b, so a search with the same k1/b only sums stored scores
    # a vocabulary that fits is sent to the rows, which then stay where they are
    idf = checked_broadcast(index.idf, IDF_BROADCAST_ROWS)
    v = sparse_vectors(index.terms, idf, index.stats, index.params)
    t = (v.select("doc_id", "word", "tf", "doc_len", "idf", "tf_idf", "bm25")
          .withColumn("shard", shard_of("word", n_shards)))
    # ranges over (shard, word, doc): a hot word's list spans several tasks and
    # files of its shard, and each file is one sorted run; a task sorts a
    # bounded number of rows
    parts = partitions_for(index.terms.sparkSession, index.terms.count(), ROWS_PER_TASK)
    (t.repartitionByRange(parts, "shard", "word", "doc_id").sortWithinPartitions("shard", "word", "doc_id")
      .write.mode("overwrite").partitionBy("shard").parquet(f"{path}/terms"))
    d = index.df.withColumn("shard", shard_of("word", n_shards))
    (d.repartitionByRange("shard", "word").sortWithinPartitions("shard", "word")
      .write.mode("overwrite").partitionBy("shard").parquet(f"{path}/df"))
    index.stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")
    spark = index.terms.sparkSession
    meta = spark.createDataFrame([(index.profile, index.params.k1, index.params.b, n_shards)],
                                 "profile string, k1 double, b double, n_shards int")
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


class StoredIndex:
    def __init__(self, spark: SparkSession, path: str, params: Params = DEFAULT,
                 vocabulary: DataFrame | None = None, vocabulary_rows: int | None = None):
        self.spark, self.path, self.params = spark, path, params
        m = spark.read.parquet(f"{path}/meta").first()
        self.profile, self.n_shards = m.profile, m.n_shards
        self.stored_k1, self.stored_b = m.k1, m.b
        self.stats = spark.read.parquet(f"{path}/stats")
        terms = spark.read.parquet(f"{path}/terms")
        df = spark.read.parquet(f"{path}/df")
        if vocabulary is not None:
            from quarry.plans.util import bounded_broadcast, checked_broadcast
            voc = vocabulary.select("word").distinct().withColumn("shard", shard_of("word", self.n_shards))
            voc = (bounded_broadcast(voc, vocabulary_rows, params.broadcast_max_rows)
                   if vocabulary_rows is not None else checked_broadcast(voc, params.broadcast_max_rows))
            # the shard ids of the batch (at most n_shards small ints) become a
            # literal partition filter: only those directories are listed/read
            shards = sorted(r.shard for r in voc.select("shard").distinct().collect())
            terms = terms.filter(F.col("shard").isin(shards)).join(voc, ["shard", "word"], "left_semi")
            df = df.filter(F.col("shard").isin(shards)).join(voc, ["shard", "word"], "left_semi")
        self.vocabulary = vocabulary
        self.doc_clustered = False   # rows are laid out by word shard
        self.terms = terms.select("doc_id", "doc_len", "word", "tf")
        self.vectors = terms.select("doc_id", "doc_len", "word", "tf", "idf", "tf_idf", "bm25")
        self.df = df.select("word", "num_docs")
        self.idf = idf_of(self.df, self.stats)

    def restrict(self, vocabulary: DataFrame, vocabulary_rows: int | None = None) -> "StoredIndex":
        return StoredIndex(self.spark, self.path, self.params, vocabulary, vocabulary_rows)
