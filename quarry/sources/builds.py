"""Builds that are read only when they are whole.

A build is a folder with its rows in parts and a manifest that names every part
with its row count. A part is written to a folder of its own and is listed only
after its rows were counted, so a job killed at any point leaves a part that no
manifest names: it is never read, and the next run builds it again. A listed
part that has lost rows or files since then is not trusted either.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "part string, file string, rows long"


def _read(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """The table at ``path``, or None if nothing was ever written there."""
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def listed(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: ``part, file, rows`` (``file`` null where a part is not split by file)."""
    found = _read(spark, f"{path}/manifest")
    return spark.createDataFrame([], MANIFEST) if found is None else found


def write_part(rows: DataFrame, path: str, partition_by: str | None = None,
               layout: Callable[[DataFrame], DataFrame] = lambda df: df) -> str:
    """Write ``rows`` as a new part that is not listed yet; returns its name."""
    part = f"part-{uuid.uuid4().hex}"
    w = layout(rows).write
    (w.partitionBy(partition_by) if partition_by else w).parquet(f"{path}/{part}")
    return part


def list_part(spark: SparkSession, path: str, entries: DataFrame, mode: str = "append") -> None:
    """Write rows of the manifest; one file, so that it appears as a whole."""
    entries.coalesce(1).write.mode(mode).parquet(f"{path}/manifest")


def _whole_parts(spark: SparkSession, path: str) -> list[DataFrame | None]:
    """The listed parts by name if every one has the rows it had, else none; each
    part's folders are listed once. A part without rows may have no file (None)."""
    entries, frames = listed(spark, path).groupBy("part").agg(F.sum("rows").alias("rows")).collect(), []
    for e in sorted(entries, key=lambda e: e["part"]):
        found = _read(spark, f"{path}/{e['part']}")
        if (0 if found is None else found.count()) != e["rows"]:
            return []
        frames.append(found)
    return frames


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a manifest is there and every part it names has the rows it had."""
    return bool(_whole_parts(spark, path))


def read_build(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the listed parts; an incomplete build is an error."""
    frames = _whole_parts(spark, path)
    if not frames:
        raise ValueError(f"no complete build at {path}")
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError(f"the build at {path} has no file")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def build_once(rows: DataFrame, path: str, partition_by: str | None = None, overwrite: bool = False,
               layout: Callable[[DataFrame], DataFrame] = lambda df: df) -> bool:
    """Write ``rows`` as the build at ``path`` unless a complete one is there.

    Returns whether it wrote. What an earlier run left without listing it, and
    a listed part that is no longer whole, are not read again.
    """
    spark = rows.sparkSession
    if not overwrite and is_complete(spark, path):
        return False
    part = write_part(rows, path, partition_by, layout)
    n = spark.read.schema(rows.schema).parquet(f"{path}/{part}").count()
    list_part(spark, path, spark.createDataFrame([(part, None, n)], MANIFEST), "overwrite")
    return True


def append_part(rows: DataFrame, path: str) -> int:
    """Add ``rows`` to the build as a part of its own; returns how many there were."""
    spark = rows.sparkSession
    part = write_part(rows, path)
    n = spark.read.schema(rows.schema).parquet(f"{path}/{part}").count()
    if n:
        list_part(spark, path, spark.createDataFrame([(part, None, n)], MANIFEST))
    return n


def _file_counts(spark: SparkSession, path: str) -> DataFrame:
    """``part, file, have``: rows per file in each listed part."""
    out = spark.createDataFrame([], "part string, file string, have long")
    for r in listed(spark, path).select("part").distinct().collect():
        rows = _read(spark, f"{path}/{r['part']}")
        if rows is not None:
            out = out.unionByName(rows.groupBy("file").agg(F.count("*").alias("have")).withColumn("part", F.lit(r["part"])))
    return out


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, part, rows`` of the files whose listed rows are all there (files
    without rows included). A file that was built more than once has several
    parts with the same rows; one that is whole is named."""
    entries, counts = listed(spark, path).alias("e"), _file_counts(spark, path).alias("c")
    j = entries.join(counts, (F.col("e.part") == F.col("c.part")) & F.col("e.file").eqNullSafe(F.col("c.file")), "left")
    whole = j.filter(F.coalesce("have", F.lit(0)) == F.col("rows")).select("e.file", F.struct("e.part", "rows").alias("p"))
    return whole.groupBy("file").agg(F.max("p").alias("p")).select("file", "p.part", "p.rows")


def resume_files(docs: DataFrame, path: str, build: Callable[[DataFrame], DataFrame]) -> int:
    """Build the files of ``docs`` that are not whole at ``path``; returns how many.

    ``build(docs)`` returns rows with their ``file`` column.
    """
    spark = docs.sparkSession
    files, done = docs.select("file").distinct().alias("f"), whole_files(spark, path).alias("d")
    todo = files.join(done, F.col("f.file").eqNullSafe(F.col("d.file")), "left_anti").select("f.file").cache()
    n = todo.count()
    if n:
        mine = docs.join(todo.withColumnRenamed("file", "_file"), F.col("file").eqNullSafe(F.col("_file")), "left_semi")
        part = write_part(build(mine), path)
        have = spark.read.parquet(f"{path}/{part}").groupBy("file").agg(F.count("*").alias("rows")).alias("h")
        entries = todo.alias("t").join(have, F.col("t.file").eqNullSafe(F.col("h.file")), "left").select(
            F.lit(part).alias("part"), "t.file", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))
        list_part(spark, path, entries)
    todo.unpersist()
    return n


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all whole files, each file from one part."""
    keep, out = whole_files(spark, path).filter("rows > 0").cache(), None
    for r in keep.select("part").distinct().collect():
        here = keep.filter(F.col("part") == r["part"]).select(F.col("file").alias("_file"))
        rows = spark.read.parquet(f"{path}/{r['part']}")
        rows = rows.join(here, F.col("file").eqNullSafe(F.col("_file")), "left_semi")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError(f"no whole file at {path}")
    return out
