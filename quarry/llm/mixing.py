"""Mixing sources to target weights by the cube method (balanced sampling).

Targets: sources in code point order (null last) weigh ``weights`` cyclically
and share all words by weight; a target stops at ``max_epochs`` times its
source's size and the excess is reshared by weight (water-filling, solved in
closed form over the sources sorted by the level at which they fill up).

Copies: a source with target ``t`` and size ``s`` takes every document
``floor(t / s)`` times, and a further copy with inclusion probability
``frac(t / s)``. Which documents get it is drawn by the cube method: the
probability vector is moved along the null space of the constraints (words and
documents taken from the source stay as expected) until coordinates reach 0 or
1. With two constraints any three open documents have a null-space direction
(the cross product of the constraint rows), so one pass over a block leaves two
open at most.

Spark deals the documents of a source to blocks of about ``BLOCK_ROWS`` by
hash; each block runs the flight on its own and passes its open documents on.
They are dealt again, level by level, until a source fits one block; large
documents come first in a block, so what stays open is small. The landing
settles the last two by the outcome nearest to the expected words.

Defined cases: null text has size 0; a null source is a source of its own; an
empty source (no words) has target 0 and takes nothing; repeated rows are rows
of their own; an empty table gives no rows. Draws come from hashes of the seed,
the source and the block, so reruns and retried tasks agree.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_BYTES, materialise, text_hash

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 11
BLOCK_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
            share: float = 1.0) -> DataFrame:
    """``sizes(src, source_size)`` with ``target, whole, pi``: copies every
    document gets, and the inclusion probability of one more.

    One row per source; the two windows run over that small table.
    """
    order = Window.orderBy(F.col("src").isNull(), "src")
    cyc = F.array(*[F.lit(float(w)) for w in weights])
    t = sizes.withColumn("weight", cyc[((F.row_number().over(order) - 1) % len(weights)).cast("int")])
    t = t.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    every = Window.partitionBy()
    t = t.withColumn("total", F.sum("source_size").over(every) * F.lit(share))
    # sources fill up in this order; level: what a unit of weight gets if all before are full
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("src").isNull(), "src")
    before, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    t = t.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(rest))
    t = t.withColumn("nth", F.row_number().over(fill))
    # the first in this order that does not fill up ends the full ones; its level is everyone's after it
    opens = F.when(F.col("cap") / F.col("weight") > F.col("level"), F.struct("nth", "level"))
    t = t.withColumn("open", F.min(opens).over(every))
    t = t.withColumn("full", F.col("open").isNull() | (F.col("nth") < F.col("open.nth"))).withColumn("water", F.col("open.level"))
    t = t.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("water")))
    ratio = F.col("target") / F.col("source_size")
    t = t.withColumn("whole", F.when(F.col("source_size") == 0, 0).when(F.col("full"), max_epochs)
                     .otherwise(F.least(F.floor(ratio), F.lit(max_epochs))).cast("int"))
    return t.withColumn("pi", F.when((F.col("source_size") == 0) | F.col("full"), 0.0).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio - F.col("whole"))))).select(
        "src", "source_size", "target", "whole", "pi")


def flight(size: np.ndarray, pi: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move ``pi`` until at most two coordinates are open, keeping
    ``sum(pi)`` and ``sum(size * pi)``; units are taken up in the given order."""
    pi = pi.astype(float).copy()
    eps = 1e-9
    todo = np.flatnonzero((pi > eps) & (pi < 1 - eps)).tolist()
    draws = iter(rng.random(len(todo) + 1))
    held: list[int] = []
    for k in todo:
        held.append(k)
        while len(held) == 3:
            a, b, c = held
            sa, sb, sc = float(size[a]), float(size[b]), float(size[c])
            u = (sb - sc, sc - sa, sa - sb)  # cross product of (1, 1, 1) and the sizes
            if u == (0.0, 0.0, 0.0):
                u = (1.0, -1.0, 0.0)  # equal sizes: any direction with sum 0
            up = min((((1 - pi[i]) if x > 0 else pi[i]) / abs(x)) for i, x in zip(held, u) if x)
            down = min((pi[i] if x > 0 else (1 - pi[i])) / abs(x) for i, x in zip(held, u) if x)
            step = up if next(draws) * (up + down) < down else -down
            for i, x in zip(held, u):
                v = pi[i] + step * x
                pi[i] = 0.0 if v < eps else 1.0 if v > 1 - eps else v
            held = [i for i in held if 0.0 < pi[i] < 1.0]
    return np.where(pi <= eps, 0.0, np.where(pi >= 1 - eps, 1.0, pi))


def land(size: np.ndarray, pi: np.ndarray) -> np.ndarray:
    """Settle the open coordinates by the outcome nearest to the expected
    words, then to the expected documents (first outcome on ties)."""
    pi = pi.copy()
    held = np.flatnonzero((pi > 0) & (pi < 1))
    words, docs = float((size[held] * pi[held]).sum()), float(pi[held].sum())
    best = None
    for bits in range(1 << len(held)):
        take = np.array([bits >> i & 1 for i in range(len(held))], dtype=float)
        miss = (abs(float((size[held] * take).sum()) - words), abs(float(take.sum()) - docs))
        if best is None or miss < best[0]:
            best = (miss, take)
    pi[held] = best[1]
    return pi


def _block(g: pd.DataFrame, seed: int) -> pd.DataFrame:
    first = g.iloc[0]
    tag = f"{seed}|{first['src']}|{first['level']}|{first['block']}"
    rng = np.random.default_rng(int.from_bytes(hashlib.sha256(tag.encode()).digest()[:8], "big"))
    g = g.sort_values(["size", "tie", "doc_id"], ascending=[False, True, True], kind="stable")
    size, pi = g["size"].to_numpy(), flight(g["size"].to_numpy(), g["pi"].to_numpy(), rng)
    if first["blocks"] == 1:
        pi = land(size, pi)
    return g.assign(pi=pi)[["src", "doc_id", "size", "tie", "pi"]]


_UNIT = "src string, doc_id long, size long, tie long, pi double"


def cube_sample(units: DataFrame, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``units(src, doc_id, size, tie, pi)`` with every ``pi`` moved to 0 or 1."""
    open_, done, level = units, [], 0
    while True:
        counts = open_.groupBy("src").agg(F.ceil(F.count("*") / F.lit(block_rows)).alias("blocks"))
        stat = counts.agg(F.count("*"), F.max("blocks")).first()
        counts = counts.withColumnRenamed("src", "c_src")
        counts = F.broadcast(counts) if stat[0] * 64 <= BROADCAST_BYTES else counts
        dealt = open_.join(counts, F.col("src").eqNullSafe(F.col("c_src"))).drop("c_src")
        dealt = dealt.withColumn("level", F.lit(level)).withColumn(
            "block", F.pmod(F.xxhash64("doc_id", "tie", F.lit(seed + level)), F.col("blocks")))
        flown = materialise(dealt.groupBy("src", "block").applyInPandas(
            lambda g: _block(g, seed), _UNIT), f"cube-{level}")
        if (stat[1] or 0) <= 1:
            return reduce(DataFrame.unionByName, [*done, flown])
        done.append(flown.filter("pi <= 0 or pi >= 1"))
        open_ = flown.filter("pi > 0 and pi < 1")
        level += 1


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0,
        seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``doc_id, src, tie, size, source_size, target, copies, taken`` for every
    row of ``docs(doc_id, text, source)``. ``tie`` is the text's hash."""
    text = F.col("text").cast("string")
    rows = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("src"),
        word_count(text).alias("size"), text_hash(text).alias("tie")), "mix-sizes")
    goal = materialise(targets(rows.groupBy("src").agg(F.sum("size").alias("source_size")), weights, max_epochs, share),
                       "mix-targets").withColumnRenamed("src", "g_src")
    goal = F.broadcast(goal) if goal.count() * 96 <= BROADCAST_BYTES else goal
    units = rows.join(goal, F.col("src").eqNullSafe(F.col("g_src")))
    sampled = cube_sample(units.select("src", "doc_id", "size", "tie", "pi"), seed, block_rows)
    out = sampled.join(goal.drop("pi"), F.col("src").eqNullSafe(F.col("g_src"))).withColumn(
        "copies", F.col("whole") + F.col("pi").cast("int"))
    return out.select("doc_id", "src", "tie", "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as mixed: each row as often as it is taken, all columns kept."""
    counts = materialise(mix(docs, **options).groupBy("doc_id", "tie").agg(
        F.sum("copies").alias("n"), F.count("*").alias("rows")).select(
        F.col("doc_id").alias("__m_id"), F.col("tie").alias("__m_h"), F.col("n").alias("__m_n"),
        F.col("rows").alias("__m_rows")), "mix-counts")
    if counts.count() * 48 <= BROADCAST_BYTES:
        counts = F.broadcast(counts)
    text = docs["text"].cast("string")
    keyed = docs.withColumn("__m_key", text_hash(text))
    j = keyed.join(counts, keyed["doc_id"].cast("long").eqNullSafe(F.col("__m_id")) & (F.col("__m_key") == F.col("__m_h")))
    # rows that repeat id and text share their copies: the first `n mod rows` get one more
    if counts.filter("__m_rows > 1").isEmpty():
        j = j.withColumn("__m_take", F.col("__m_n"))
    else:
        w = Window.partitionBy("__m_id", "__m_h").orderBy("__m_n")
        j = j.withColumn("__m_take", F.expr("__m_n div __m_rows") + (
            F.row_number().over(w) <= F.col("__m_n") % F.col("__m_rows")).cast("long"))
    j = j.filter("__m_take > 0").withColumn("__m_i", F.explode(F.sequence(F.lit(1), F.col("__m_take").cast("int"))))
    return j.select(*[docs[c] for c in docs.columns])
