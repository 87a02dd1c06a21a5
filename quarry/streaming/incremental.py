"""File-driven incremental build with Structured Streaming.

New document files dropped into a directory are picked up by a parquet
``readStream``; each micro-batch is turned into term rows and appended to the
output table, partitioned by ``file`` and ``batch`` (the micro-batch number). The streaming checkpoint records which
files were consumed, so a restarted job resumes where it stopped and a file
is never processed twice; a replayed batch replaces its own partitions. ``trigger(availableNow=True)`` processes the backlog
and stops — a batch job with exactly-once file bookkeeping.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream_build(spark: SparkSession, source_dir: str, schema: StructType | str, out_path: str,
                 checkpoint: str, build: Callable[[DataFrame], DataFrame],
                 max_files_per_trigger: int | None = None) -> None:
    """Run ``build`` over every not-yet-seen file of ``source_dir`` and append
    the result to ``out_path``; blocks until the backlog is processed."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_dir)

    def each(batch: DataFrame, epoch: int) -> None:
        # one source may arrive in several part files and micro-batches, so each
        # batch owns its (file, batch) partitions; a replay replaces just those
        (build(batch).withColumn("batch", F.lit(epoch)).write.partitionBy("file", "batch").mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").parquet(out_path))

    q = (src.writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    q.awaitTermination()
