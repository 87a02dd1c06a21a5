"""Approximate nearest neighbours with an inverted multi-index.

Index: vectors are cut in two halves and each half is quantised by its own
``K`` centroids (k-means on a bounded sample), which makes ``K * K`` cells.
``K`` grows with the square root of the rows, so that a cell holds about
``CELL_ROWS`` of them, up to what the sample can place (``FIT_ROWS / 20``).
Every row is indexed: it lies in cell ``(i, j)``. Rows are dealt to blocks by
``i`` (a large ``i`` is salted into several), about ``BLOCK_ROWS`` rows each,
and lie there sorted by ``j``.

Search: for a query, the centroid pairs are visited in the order of their
summed inner products (the multi-sequence walk over two sorted lists with a
heap) until the visited cells hold ``scan`` of all rows. A query goes to each
block once, with a bit mask of the second-half centroids it visits there. A
task reads a block's rows, then streams the queries of the block against them,
so memory does not depend on the number of queries; a query is multiplied with
the rows of its visited cells only. Nearest entries of a block
are reranked by the exact inner product on the original vectors in double
precision; the best of all blocks follow by a ranking per query.

``scan`` is calibrated on the sample: the share of rows that must be visited
so that ``recall`` of the sample's true neighbours lie in visited cells. Data
without structure needs a large share, clustered data a small one.

Identical vectors are one row of a block's matrix with their smallest ids, so
a vector that a third of all rows share costs no more than any other.

Defined cases: vectors that are null, empty, zero, hold a null or non-finite
component, or have another length than the most common one take no part, nor
rows without id; rows that share an id are entries and queries of their own,
and only the query's own row is no candidate; ties go to the smaller id; fewer
candidates than ``k`` are all returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise

CENTROIDS = 32  # per half, at least
CELL_ROWS = 64
FIT_ROWS = 20_000
FIT_QUERIES = 200
BLOCK_ROWS = 4096
RECALL = 0.97
TOP_K = 20
SEED = 5


def usable(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, v``: the double vectors of the most common length, numbered."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.filter("vec_id is not null and v is not null and size(v) > 0").filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    dims = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return v.filter(F.size("v") == (dims["d"] if dims else 0)).withColumn("row", F.monotonically_increasing_id())


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centroids of ``x`` (Lloyd, k-means++ start); at most one per distinct row."""
    x = np.ascontiguousarray(x)
    rng = np.random.default_rng(seed)
    c = [x[rng.integers(len(x))]]
    d = ((x - c[0]) ** 2).sum(axis=1)
    while len(c) < k and d.max() > 0:
        c.append(x[rng.choice(len(x), p=d / d.sum())])
        d = np.minimum(d, ((x - c[-1]) ** 2).sum(axis=1))
    c = np.array(c)
    for _ in range(rounds):
        near = assign(x, c)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def assign(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c ** 2).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)


def walk(a: np.ndarray, b: np.ndarray, rows: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Cells ``(i, j)`` by descending ``a[i] + b[j]`` until they hold ``enough``
    rows: the multi-sequence algorithm over both sorted lists."""
    oa, ob = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
    al, bl = a.tolist(), b.tolist()
    heap, cells, have = [(-(al[oa[0]] + bl[ob[0]]), 0, 0)], [], 0
    while heap and have < enough:
        _, x, y = heapq.heappop(heap)
        i, j = oa[x], ob[y]
        cells.append((i, j))
        have += int(rows[i, j])
        # (x+1, y) is reached from (x, y) only, (0, y+1) from (0, y): every pair enters once
        if x + 1 < len(oa):
            heapq.heappush(heap, (-(al[oa[x + 1]] + bl[ob[y]]), x + 1, y))
        if x == 0 and y + 1 < len(ob):
            heapq.heappush(heap, (-(al[oa[0]] + bl[ob[y + 1]]), 0, y + 1))
    return cells


def calibrate(x: np.ndarray, c1: np.ndarray, c2: np.ndarray, k: int, recall: float) -> float:
    """Share of rows to visit so that ``recall`` of true neighbours are in visited cells."""
    half = x.shape[1] // 2
    i, j = assign(x[:, :half], c1), assign(x[:, half:], c2)
    rows = np.zeros((len(c1), len(c2)), dtype=np.int64)
    np.add.at(rows, (i, j), 1)
    need = []
    for q in range(min(FIT_QUERIES, len(x))):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.argsort(-s, kind="stable")[:min(k, len(x) - 1)]
        cell = (c1 @ x[q, :half])[:, None] + (c2 @ x[q, half:])[None, :]
        order = np.argsort(-cell, axis=None, kind="stable")
        reach = np.empty(order.size)
        reach[order] = np.cumsum(rows.ravel()[order])
        need += (reach[(i * len(c2) + j)[best]] / len(x)).tolist()
    return float(np.quantile(need, recall)) if need else 1.0


def _block_top(rows: np.ndarray, ids: np.ndarray, mat: np.ndarray, js: np.ndarray, k: int):
    """A function from queries (rows, ids, matrix, visited) to their best rows of the block."""
    tagged = np.concatenate([js[:, None].astype(np.float64), mat], axis=1)
    as_key = np.ascontiguousarray(tagged).view(np.dtype((np.void, 8 * tagged.shape[1]))).ravel()
    _, first, inverse = np.unique(as_key, return_index=True, return_inverse=True)
    by_cell = np.argsort(js[first], kind="stable")  # distinct vectors, sorted by cell
    place = np.empty(len(first), dtype=np.int64)
    place[by_cell] = np.arange(len(first))
    inverse, first = place[inverse], first[by_cell]
    uniq, ju = mat[first], js[first]
    cells = [(int(j), *np.searchsorted(ju, [j, j + 1])) for j in np.unique(ju)]
    order = np.lexsort((ids, inverse))
    begin = np.searchsorted(inverse[order], np.arange(len(first)))
    end = np.append(begin[1:], len(order))
    members = [order[b:min(e, b + k + 1)] for b, e in zip(begin, end)]  # k + 1: the query itself may be one

    def top(q_rows: np.ndarray, q_ids: np.ndarray, q: np.ndarray, visited: np.ndarray) -> tuple[list, list, list, list]:
        out: tuple[list, list, list, list] = ([], [], [], [])
        s = np.full((len(q), len(uniq)), -np.inf)
        for j, lo, hi in cells:
            asks = np.flatnonzero(visited[:, j])
            if len(asks):
                s[asks, lo:hi] = q[asks] @ uniq[lo:hi].T
        m = min(k + 1, s.shape[1])
        floor = np.partition(s, s.shape[1] - m, axis=1)[:, s.shape[1] - m]
        for r in range(len(q)):
            near = np.flatnonzero((s[r] >= floor[r] - 1e-9) & np.isfinite(s[r]))
            exact = (uniq[near] * q[r]).sum(axis=1)  # same order of additions for equal vectors
            found = sorted((-e, int(ids[x])) for e, n in zip(exact.tolist(), near.tolist())
                           for x in members[n] if rows[x] != q_rows[r])[:k]
            for column, value in zip(out, (int(q_rows[r]), int(q_ids[r]))):
                column.extend([value] * len(found))
            out[2].extend(i for _, i in found)
            out[3].extend(-e for e, _ in found)
        return out

    return top


def _search_blocks(k: int):
    """Streams rows sorted by (block, kind): a block's entries, then its queries."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, top = None, None
        held: list[tuple] = []
        for b in batches:
            blocks, kinds = b.column("block").to_numpy(), b.column("kind").to_numpy()
            rows, ids, tags = (b.column(c).to_numpy() for c in ("row", "id", "tag"))
            cut = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for x, y in zip([0, *cut], [*cut, b.num_rows]):
                if blocks[x] != block:
                    block, top, held = blocks[x], None, []
                for s in range(x, y, 1024):
                    e = min(y, s + 1024)
                    m = _stacked(b.column("v").slice(s, e - s), np.float64)
                    if kinds[x] == 0:
                        held.append((rows[s:e], ids[s:e], m, tags[s:e]))
                    elif held or top:
                        if top is None:
                            top, held = _block_top(*map(np.concatenate, zip(*held)), k), []
                        visited = np.unpackbits(_stacked(b.column("mask").slice(s, e - s), np.uint8), axis=1, bitorder="little")
                        got = top(rows[s:e], ids[s:e], m, visited)
                        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in got[:3]), pa.array(got[3], pa.float64())],
                                                         ["query_row", "query_id", "vec_id", "score"])

    return part


def search(vectors: DataFrame, is_query, k: int = TOP_K, centroids: int = CENTROIDS, fit_rows: int = FIT_ROWS,
           recall: float = RECALL, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors(vec_id,
    embedding)`` where the condition ``is_query`` (on ``vec_id``) holds."""
    spark = vectors.sparkSession
    v = materialise(usable(vectors), "ann-vectors")
    sample = v.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id", "v").limit(fit_rows).collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = np.array([r["v"] for r in sample], dtype=np.float64)
    del sample
    half = x.shape[1] // 2
    wanted = max(centroids, min(fit_rows // 20, int((v.count() / CELL_ROWS) ** 0.5)))
    c1, c2 = kmeans(x[:, :half], wanted, seed), kmeans(x[:, half:], wanted, seed + 1)
    scan = calibrate(x, c1, c2, k, recall)
    del x

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column("v"))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("vec_id"), pa.array(assign(m[:, :half], c1).astype(np.int64)),
                 pa.array(assign(m[:, half:], c2).astype(np.int64)), pa.array([r.tobytes() for r in m], pa.binary())],
                ["row", "id", "i", "tag", "v"])

    index = materialise(v.mapInArrow(cells, "row long, id long, i long, tag long, v binary"), "ann-index")
    rows = np.zeros((len(c1), len(c2)), dtype=np.int64)
    for r in index.groupBy("i", "tag").count().collect():  # at most one row per cell
        rows[r["i"], r["tag"]] = r["count"]
    enough = max(k + 1, int(np.ceil(scan * rows.sum())))
    parts = np.maximum(1, -(-rows.sum(axis=1) // block_rows)).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(parts)[:-1]])
    salt = F.pmod(F.xxhash64("row", F.lit(seed)), F.element_at(F.array(*[F.lit(int(p)) for p in parts]), (F.col("i") + 1).cast("int")))
    base = F.element_at(F.array(*[F.lit(int(p)) for p in begin]), (F.col("i") + 1).cast("int"))
    entries = index.select((base + salt).alias("block"), F.lit(0).cast("int").alias("kind"), "row", "id", "tag", "v",
                           F.lit(None).cast("binary").alias("mask"))
    width = -(-len(c2) // 8)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                out: list[tuple] = []
                for row, q, raw in zip(*(part.column(c).to_pylist() for c in ("row", "id", "v"))):
                    m = np.frombuffer(raw, dtype=np.float64)
                    masks: dict[int, int] = {}
                    for i, j in walk(c1 @ m[:half], c2 @ m[half:], rows, enough):
                        if rows[i, j]:
                            masks[i] = masks.get(i, 0) | 1 << j
                    out += [(int(begin[i]) + p, 1, row, q, 0, raw, mask.to_bytes(width, "little"))
                            for i, mask in masks.items() for p in range(int(parts[i]))]
                if out:
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                     ["block", "kind", "row", "id", "tag", "v", "mask"])

    asked = index.filter(is_query(F.col("id"))).mapInArrow(
        visits, "block long, kind int, row long, id long, tag long, v binary, mask binary")
    dealt = entries.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind")
    hits = dealt.mapInArrow(_search_blocks(k), "query_row long, query_id long, vec_id long, score double")
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _stacked(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1), dtype=np.float64)


def exact(vectors: DataFrame, query_ids: list[int], k: int = TOP_K) -> pd.DataFrame:
    """Brute force for a few queries, to measure recall (collects the vectors; tests only)."""
    rows = usable(vectors).collect()
    ids, m = np.array([r["vec_id"] for r in rows]), np.array([r["v"] for r in rows])
    out = []
    for q in query_ids:
        for own in np.flatnonzero(ids == q):
            s = (m * m[own]).sum(axis=1)
            for rank, n in enumerate([n for n in np.lexsort((ids, -s)) if n != own][:k], 1):
                out.append((q, rank, int(ids[n]), float(s[n])))
    return pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])
