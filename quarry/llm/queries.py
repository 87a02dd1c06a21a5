"""The registered queries: each operator over its whole table, with the result's
digest columns derived from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (ann, decontam, license, linededup, linefreq, mixing, pivotkmeans, sharding, simhash, suffix,
                        tokenalign, toxicity, urlfilter)
from quarry.llm.sql import ORACLES
from quarry.sources.tables import table

#: Folder of the tokenizer files, read on the driver.
TOKENIZERS = "/opt/tokenizers"


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op4_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_rows(docs, model).select(
        "doc_id", (toxicity.fold(F.col("doc_id")) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``/source/lang/block of 1000 ids/doc_id.txt``; the
    document whose id is the block's first is the block's ``LICENSE``. Folders
    of documents without source or language are named ``(none)``; a document
    without id has no path."""
    d = table(spark, sf_dir, "documents")
    folder = F.concat(F.lit("/"), F.coalesce("source", F.lit("(none)")), F.lit("/"), F.coalesce("lang", F.lit("(none)")),
                      F.lit("/"), F.expr("cast(doc_id div 1000 as string)"), F.lit("/"))
    name = F.when(F.col("doc_id") % 1000 == 0, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = d.select(F.concat(folder, name).alias("path"), "text")
    return license.scan(files).select("path", "license", "how", "score", "from_path")


def op10_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the documents' sources."""
    return linefreq.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_ptolemaic_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotkmeans.cluster(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    a, b = (Path(tokenizers, f).read_bytes() for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return tokenalign.alignment(table(spark, sf_dir, "documents"), a, b)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_multi_index, op2_decontaminate, op3_url_filter, op4_interleave, op5_suffix_dedup, op6_simhash,
        op7_line_dedup, op8_toxicity, op9_license_scan, op10_cube_mix, op11_line_frequency, op12_ptolemaic_kmeans,
        op13_token_alignment)}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
