"""Documents stored for lookups by (file, entry_id).

The rows are dealt to buckets by a hash of their key, one folder per bucket,
and lie there sorted by (entry_id, file). A lookup reads only the folders of
its keys' buckets, and, for a batch of few keys, only the row groups whose
statistics admit one of the entry ids; the corpus is never scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources import builds

BUCKETS = 64
#: Entry ids that are pushed down to the row groups; a larger batch prunes buckets only.
PUSHED_KEYS = 1000
#: Keys per lookup that may be broadcast (a key is below 100 bytes with its overhead).
BROADCAST_KEYS = 300_000


def bucket_of(n: int) -> Column:
    return F.pmod(F.xxhash64(F.col("file").cast("string"), F.col("entry_id").cast("long")), F.lit(n)).cast("int")


def build(docs: DataFrame, path: str, buckets: int = BUCKETS) -> bool:
    """Store ``docs(file, entry_id, ...)`` unless a complete store is there."""
    def layout(df: DataFrame) -> DataFrame:
        return df.repartitionByRange("bucket", "entry_id", "file").sortWithinPartitions("bucket", "entry_id", "file")

    rows = docs.withColumns({"file": F.col("file").cast("string"), "entry_id": F.col("entry_id").cast("long")})
    spark = docs.sparkSession
    if builds.is_complete(spark, path):
        return False
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return builds.build_once(rows.withColumn("bucket", bucket_of(buckets)), path, "bucket", False, layout)


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The stored rows of the distinct ``keys(file, entry_id)``; keys without a
    row, or with a null, find nothing."""
    n = spark.read.parquet(f"{path}/meta").first()["buckets"]
    asked = keys.select(F.col("file").cast("string").alias("file"), F.col("entry_id").cast("long").alias("entry_id")) \
                .filter("file is not null and entry_id is not null").distinct().withColumn("bucket", bucket_of(n)).cache()
    count = asked.count()
    found = builds.read_build(spark, path)
    buckets = sorted(r["bucket"] for r in asked.select("bucket").distinct().collect())   # at most n
    found = found.filter(F.col("bucket").isin(buckets))
    if count <= PUSHED_KEYS:
        found = found.filter(F.col("entry_id").isin([r["entry_id"] for r in asked.select("entry_id").distinct().collect()]))
    side = F.broadcast(asked) if count <= BROADCAST_KEYS else asked
    return found.join(side, ["bucket", "file", "entry_id"], "left_semi").drop("bucket")
