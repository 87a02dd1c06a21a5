"""Centroid clustering on integer vectors with Ptolemaic pivots.

Vectors are scaled and floored to integers once and written beside their
distances to the pivots (the starting centroids, fixed for all rounds). For a
pivot pair (p, q), Ptolemy's inequality gives

    d(v, c) >= |d(v, p) d(c, q) - d(v, q) d(c, p)| / d(p, q)

so one bound per (vector, centroid) comes from cached distances alone. The
centroids are tried by ascending bound, and one whose bound exceeds the best
exact distance found so far is never computed. Bounds are rounded down by more
than the error of their doubles, and every survivor's distance is computed in
integers, so the clusters are those of the plain method.

A round is one pass over the written table: batches return their own sums per
cluster, which are added in Spark; only the centroids (``k`` rows) reach the
driver. Vectors never move.

Defined cases: vectors that are null, have another length or hold null or
non-finite components take no part, nor do those with a scaled component beyond
2^27, whose distances a long could not hold. Equal distances go to the smaller
centroid number; rows that repeat an id are vectors of their own, ordered by
their components where the hash of the id decides; null ids come last in that
order. Fewer vectors than ``k`` give as many centroids; none give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise

K = 16
ROUNDS = 3
DIM = 64
SCALE = 64
SEED = 1
#: Largest scaled component: squared distances of 64 components stay below 2^63.
LIMIT = 1 << 27
#: Pivot pairs: every pivot with those so many places further round the ring.
STEPS = (1, 3, 5)
#: Relative error granted to the doubles of a bound (their true error is below 1e-14).
SLACK = 1e-12


def scaled(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: usable vectors as integers ``floor(scale * x)``."""
    x = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("x"))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit((LIMIT - 1) / scale)))
    return rows.filter((F.size("x") == dim) & F.coalesce(whole, F.lit(False))).select(
        "vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("int")).alias("v"))


def starts(table: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of ``seed:vec_id``, in hash order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = table.select(order.alias("o"), "v").orderBy(F.asc_nulls_last("o"), "v").limit(k).collect()
    return np.array([r["v"] for r in first], dtype=np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def pivot_pairs(pivots: np.ndarray, steps: tuple[int, ...] = STEPS) -> list[tuple[int, int, float]]:
    """``(i, j, distance)`` of the fixed pairs with a distance above zero."""
    m = len(pivots)
    pairs = sorted({tuple(sorted((i, (i + s) % m))) for i in range(m) for s in steps})
    return [(i, j, float(e) ** 0.5) for i, j in pairs if (e := int(squared(pivots[i:i + 1], pivots[j:j + 1])[0])) > 0]


def bounds(near: np.ndarray, cents: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """Lower bounds of the squared distances (vectors x centroids), rounded down.

    ``near`` holds vector-pivot and ``cents`` centroid-pivot distances.
    """
    low = np.zeros((len(near), len(cents)))
    for i, j, e in pairs:
        a = near[:, i, None] * cents[None, :, j]
        b = near[:, j, None] * cents[None, :, i]
        np.maximum(low, (np.abs(a - b) - SLACK * (a + b)) / e, out=low)
    return low * low * (1 - SLACK)


def nearest(v: np.ndarray, near: np.ndarray, centroids: np.ndarray, cents: np.ndarray,
            pairs: list[tuple[int, int, float]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid, its squared distance, and how many distances were computed."""
    n, k = len(v), len(centroids)
    low = bounds(near, cents, pairs)
    order = np.argsort(low, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max)
    who = np.full(n, k)
    open_, done = np.arange(n), 0
    for r in range(k):
        c = order[open_, r]
        alive = low[open_, c] <= best[open_]  # bounds ascend: a row that fails here has no further survivor
        open_, c = open_[alive], c[alive]
        if not len(open_):
            break
        d = squared(v[open_], centroids[c])
        done += len(open_)
        won = (d < best[open_]) | ((d == best[open_]) & (c < who[open_]))
        best[open_[won]], who[open_[won]] = d[won], c[won]
    return who, best, done


def _arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return np.stack(pdf["v"].to_numpy()).astype(np.int64), np.stack(pdf["near"].to_numpy())


def _to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(points, p[None, :]) for p in pivots], axis=1).astype(float))


def _with_pivots(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                v = np.stack(pdf["v"].to_numpy()).astype(np.int64)
                yield pdf.assign(near=list(_to_pivots(v, pivots)))

    return table.mapInPandas(run, "vec_id long, v array<int>, near array<double>")


def _assigner(centroids: np.ndarray, pivots: np.ndarray) -> Callable:
    pairs, cents = pivot_pairs(pivots), _to_pivots(centroids, pivots)
    return lambda v, near: nearest(v, near, centroids, cents, pairs)


def _sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``cluster, i, n, computed, x``: the sum of each cluster's component ``i``, added up in Spark."""
    assign, dim = _assigner(centroids, pivots), centroids.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n, done = np.zeros((len(centroids), dim), np.int64), np.zeros(len(centroids), np.int64), 0
        for pdf in batches:
            if len(pdf):
                v, near = _arrays(pdf)
                who, _, computed = assign(v, near)
                done += computed
                for c in np.unique(who):
                    total[c] += v[who == c].sum(axis=0)
                    n[c] += int((who == c).sum())
        yield pd.DataFrame({"cluster": np.arange(len(centroids), dtype=np.int32), "n": n,
                            "computed": [done] + [0] * (len(centroids) - 1),
                            "total": list(total)})

    part = table.mapInPandas(run, "cluster int, n long, computed long, total array<long>")
    each = part.select("cluster", "n", "computed", F.posexplode("total").alias("i", "x"))
    return each.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("computed").alias("computed"),
                                            F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))


def moved(sums: list, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: floored means; empty clusters keep theirs."""
    out = centroids.copy()
    for r in sums:
        if r["n"]:
            out[r["cluster"], r["i"]] = int(r["x"]) // r["n"]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
            seed: int = SEED, stats: dict | None = None) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    ``stats``, if given, receives the final ``centroids`` and, per round, the
    number of ``vectors`` and of distances ``computed``.
    """
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    spark = vectors.sparkSession
    table = materialise(scaled(vectors, dim, scale), "pivot-vectors")
    pivots = starts(table, k, seed)
    if not len(pivots):
        return spark.createDataFrame([], schema)
    table = materialise(_with_pivots(table, pivots), "pivot-distances")
    centroids = pivots
    for _ in range(rounds):
        sums = _sums(table, centroids, pivots).collect()
        if stats is not None:
            first = [r for r in sums if r["i"] == 0]
            stats.setdefault("vectors", []).append(sum(r["n"] for r in first))
            stats.setdefault("computed", []).append(sum(r["computed"] for r in first))
        centroids = moved(sums, centroids)
    if stats is not None:
        stats["centroids"] = centroids.tolist()
    assign = _assigner(centroids, pivots)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                who, best, _ = assign(*_arrays(pdf))
                yield pd.DataFrame({"vec_id": pdf["vec_id"], "cluster": who.astype(np.int32), "distance": best})

    named = materialise(table.mapInPandas(label, "vec_id long, cluster int, distance long"), "pivot-labels")
    per = dict(named.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    whole = sum(map(int, per.values()))

    def fits(x: int) -> int | None:  # a sum beyond a long has no value
        return x if x < 1 << 63 else None

    sides = [(c, fits(int(t)), fits(whole), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, t in per.items()]
    sides = spark.createDataFrame(sides, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return named.join(F.broadcast(sides), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
