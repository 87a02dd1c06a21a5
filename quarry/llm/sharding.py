"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; a row's
fractional rank ``(rank - 1/2) / n_source`` says how far through its source it
comes. Sorted by it, every stretch of the whole order holds the sources in
their overall shares, so cutting the order into equal stretches gives shards
that all match the mixture and whose row counts differ by one at most.

Both ranks (within the source, and overall) are exact and distributed: rows
are bucketed by the leading part of what they are sorted by, ranked within the
bucket, and moved by the number of rows in the buckets before. A bucket holds
about ``ROWS_PER_BUCKET`` rows whatever the size of its source. Sources of
equal size share their fractional ranks; where there are more sources than a
bucket's rows, crowded buckets are cut by the rank itself and by ranges of the
sources' own order, in which a source has one row at a rank.

Defined cases: a null source is a source of its own; null text has no bytes
and CRC 0; repeated rows are rows of their own and get slots of their own;
with fewer rows than shards the last shards stay empty; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_BYTES, materialise
from quarry.operators.index import sequential_ids

N_SHARDS = 16
SEED = 7
ROWS_PER_BUCKET = 20_000
LAW = "rows"


def shuffle_key(doc_id: Column, seed: int = SEED) -> Column:
    """MD5 of ``seed:doc_id``, the place of a row in its source's shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _ranked(df: DataFrame, group: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """0-based rank of each row within ``group`` by (bucket, order)."""
    sizes = df.groupBy(*group, bucket).agg(F.count("*").alias("_c"))
    up_to = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*group, bucket, F.coalesce(F.sum("_c").over(up_to), F.lit(0)).alias("_before"))
    inner = Window.partitionBy(*group, bucket).orderBy(*order)
    ranked = df.withColumn("_r", F.row_number().over(inner))
    return (ranked.join(before, [*group, bucket]).withColumn(out, F.col("_before") + F.col("_r") - 1)
            .drop("_r", "_before"))


def _positions(rows: DataFrame, n_rows: int, n_sources: int, rows_per_bucket: int) -> DataFrame:
    """0-based place ``_pos`` of each row of ``rows(frac, _src, _sr)`` by (frac, source)."""
    wide = max(1, -(-n_rows // rows_per_bucket))
    rows = rows.withColumn("_g", F.floor(F.col("frac") * F.lit(wide)).cast("long")).withColumn("_all", F.lit(0))
    if n_sources <= rows_per_bucket:  # a bucket has at most one row of each source above its share
        return _ranked(rows, ["_all"], "_g", ["frac", "_src"], "_pos")
    sizes = materialise(rows.groupBy("_g").agg(F.count("*").alias("_c")), "shard-buckets")
    before = sizes.select("_g", F.col("_c").alias("_crowd"),
                          (F.sum("_c").over(Window.orderBy("_g")) - F.col("_c")).alias("_skip"))
    ranges = -(-n_sources // rows_per_bucket)
    crowded = F.col("_crowd") > 2 * rows_per_bucket
    # in the order of (frac, range of sources); one part where the bucket is small
    part = F.struct(F.when(crowded, F.col("frac")).otherwise(0.0).alias("f"),
                    F.when(crowded, F.expr(f"((_sr - 1) * {ranges}) div {n_sources}")).otherwise(0).alias("s"))
    rows = _ranked(rows.join(before, "_g").withColumn("_part", part), ["_g"], "_part", ["frac", "_src"], "_in")
    return rows.withColumn("_pos", F.col("_skip") + F.col("_in")).drop("_skip", "_in", "_part", "_crowd")


def interleave(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED,
               rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``doc_id, source, size, text_crc32, shard, slot, frac`` for every row of
    ``docs(doc_id, text, source)``."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("tie"))
    rows = rows.withColumn("_src", F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"),
                                            F.coalesce("source", F.lit(""))))
    rows = rows.withColumn("_k", shuffle_key(F.col("doc_id"), seed))
    totals = rows.groupBy("_src").agg(F.count("*").alias("_n"))
    stat = totals.agg(F.count("*"), F.sum("_n")).first()
    n_sources, n_rows = stat[0], stat[1] or 0
    totals = sequential_ids(totals, [F.col("_src")], "_sr") if n_sources > rows_per_bucket else totals
    totals = F.broadcast(totals) if n_sources * 64 <= BROADCAST_BYTES else totals
    rows = rows.join(totals, "_src")
    # the leading 32 bits of the shuffle key, scaled to the source's buckets
    lead = F.conv(F.substring("_k", 1, 8), 16, 10).cast("long")
    buckets = F.ceil(F.col("_n") / F.lit(rows_per_bucket))
    rows = rows.withColumn("_b", F.shiftright(lead * buckets, 32))
    rows = _ranked(rows, ["_src"], "_b", ["_k", "doc_id", "tie", "n_bytes"], "_rank")
    rows = materialise(rows, "shard-ranked")  # small: the text is read once
    rows = rows.withColumn("frac", (F.col("_rank") + F.lit(0.5)) / F.col("_n"))
    rows = _positions(rows, n_rows, n_sources, rows_per_bucket)
    # position p of n goes to shard floor(p * shards / n); its slot counts from the shard's first position
    rows = rows.withColumn("shard", F.expr(f"cast((_pos * {n_shards}) div {max(1, n_rows)} as int)"))
    first = F.expr(f"(cast(shard as bigint) * {n_rows} + {n_shards - 1}) div {n_shards}")
    return rows.select("doc_id", "source", (F.col("n_bytes") + 1).alias("size"), "text_crc32", "shard",
                       (F.col("_pos") - first).cast("long").alias("slot"), "frac")
