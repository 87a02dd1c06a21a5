"""Readers for the input tables.

Mapping of the corpus onto the article model: ``doc = doc_id``,
``file = source`` (the shard/file an article came from), ``entry_id = doc_id``.
Readers select only the needed columns so the parquet scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a CPU-heavy input at least one partition per core.

    A large corpus arrives in many file splits and is left where it is (the
    text is never shuffled just to be read); a small one (a single parquet
    row group is a single split) is redistributed round-robin so tokenising
    and regex work use every core.
    """
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # sessions without RDD access (Spark Connect): leave as read
        return df
    return df if have >= want else df.repartition(want)


def by_key(df: DataFrame, key: str) -> DataFrame:
    """Cluster rows by a document key (one hash shuffle).

    Used where every row of a document must meet in one task anyway: the
    full term build shuffles the compact text once and then tokenises and
    aggregates per document locally, which is cheaper than shuffling the
    exploded term rows (several times the text size).
    """
    return df.repartition(key)


def documents(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """Articles: ``doc_id, file, entry_id[, text]``."""
    cols = [F.col("doc_id"), F.col("source").alias("file"), F.col("doc_id").alias("entry_id")]
    if with_text:
        cols.append(F.col("text"))
        return spread(table(spark, sf_dir, "documents").select(*cols))
    return table(spark, sf_dir, "documents").select(*cols)


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query batch ``query_id, query`` from the benchmark items."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def conversation_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second query batch: user turns, ``query_id = conv_id * 1000 + turn``."""
    c = spread(table(spark, sf_dir, "conversations"))
    return (c.filter(F.col("role") == "user")
             .select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"),
                     F.col("text").alias("query")))


def excluded_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusion list standing in for redirects: docs labelled toxic."""
    return (table(spark, sf_dir, "labels").filter(F.col("toxic") == 1)
            .select("doc_id"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
