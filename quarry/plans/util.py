"""Plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, bound_rows: int, max_rows: int) -> DataFrame:
    """Broadcast ``df`` when a proven upper bound on its rows is within ``max_rows``.

    Above the bound the frame is returned unchanged and the planner (or AQE,
    from measured sizes) picks the join strategy.
    """
    return F.broadcast(df) if bound_rows <= max_rows else df


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows (counted).

    Use on inputs that are cheap to count (query batches, candidate lists);
    the count runs on the side being checked only.
    """
    return bounded_broadcast(df, df.count(), max_rows)


def partitions_for(spark, amount: int, each: int) -> int:
    """Partitions that hold at most about ``each`` of ``amount`` (rows or bytes), and
    at least as many as the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-amount // each))
