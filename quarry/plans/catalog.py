"""Registry of named queries: a DataFrame builder and, where the result is
expressible in SQL, the equivalent SQL over the same input tables.

Every builder takes ``(spark, sf_dir)`` and reads the whole input tables.
Modules under ``quarry.plans`` register their queries on import.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql.strip() if sql else None)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # import order = registration order
    from quarry.plans import (  # noqa: F401
        q_text, q_terms, q_search, q_index, q_chunk, q_dense, q_graph, q_eval, q_misc, q_storage, q_inventory)
    return REGISTRY
