"""Helpers shared by the training-data operators.

Conventions used by every operator here:

* inputs are narrowed to the needed columns first, so further columns of any
  name cannot clash with helper columns;
* a document is identified by ``(doc_id, hash of its text)``: rows repeating
  both are the same document, rows that share only the id are not;
* intermediate tables are written under ``spark.checkpoint.dir`` (see
  ``quarry.session``), so a lost executor never costs more than a stage;
* a side is broadcast only after its size was measured; beyond the bound the
  same join is a shuffle join (AQE splits its hot keys).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

#: Measured bytes up to which a join side is broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ``[\x20\x09-\x0D]`` spelled out, for trimming.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings take the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, _UPPER, _UPPER.lower()))


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    w = df.write
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int, bound: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if rows x ``row_bytes`` is within ``bound``.

    Beyond it the join is a sort-merge join: the file sizes Spark goes by miss
    what compression and an explode on either side hide. ``df`` should be a
    materialised table (its rows are counted).
    """
    return F.broadcast(df) if df.count() * row_bytes <= bound else df.hint("merge")


def text_hash(c: Column) -> Column:
    return F.xxhash64(F.coalesce(c, F.lit("")), c.isNull())


def same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Null-safe equality on the named columns."""
    cond = F.lit(True)
    for n in names:
        cond = cond & a[n].eqNullSafe(b[n])
    return cond


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
