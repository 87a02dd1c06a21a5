"""Dense vectors: embedding plug-in (U3, R7, R8), exact kNN (J11, W2, R9),
candidate-restricted kNN (R10, R11).

Exact kNN over a large item table against a bounded query batch runs as
``mapInPandas`` over the items: the query matrix (size-checked) is shipped
to every task, each Arrow batch computes its squared-L2 distances to all
queries with one matrix product and keeps only its k best per query; a
final per-query top-k (partial/final window limit) merges the survivors.
No (query, item) pair table is ever materialised.

Candidate-restricted search (rerank) joins queries with the chunks of their
own candidate documents — bounded by the stage-1 k — and computes distances
with built-in array expressions.

Embedding: by default signed feature hashing as a JVM expression
(``hashed_vector``), a deterministic stand-in for a model: the MD5 of a token id
names a dimension and a sign, and a text's vector is the mean over all
positions, padding included (a padding position adds nothing), the pooling of
the reference model call. A model is a plug-in, ``embed_fn(tokens: list of
arrays) -> np.ndarray[float32, (n, dims)]``, built once per worker and fed Arrow
batches.
"""

from __future__ import annotations

from functools import lru_cache
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from quarry.config import DEFAULT, Params


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas read it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _counts(codes: Column) -> Column:
    """Map of the values of a sorted array to how often they occur (by run ends)."""
    def ends(s):
        last = F.filter(F.sequence(F.lit(1), F.size(s)),
                        lambda i: (i == F.size(s)) | (F.element_at(s, i) != F.try_element_at(s, i + 1)))
        return _let(last, lambda e: F.map_from_arrays(
            F.transform(e, lambda x: F.element_at(s, x)),
            F.transform(e, lambda x, j: x - F.when(j == 0, 0).otherwise(F.element_at(e, F.greatest(j, F.lit(1)))))))
    return _let(codes, ends)


def token_code(token: Column, dims: int) -> Column:
    """Dimension and sign of a token id: ``2 * dimension + (1 if positive)``."""
    return F.conv(F.substring(F.md5(token.cast("string")), 1, 8), 16, 10).cast("long") % (2 * dims)


def hashed_vector(tokens: Column, dims: int, pad_id: int, positions: int = 0) -> Column:
    """``array<bigint>`` token ids to their hashed vector ``array<float>`` of ``dims``.

    The mean is taken over the array's length or ``positions``, whichever is
    larger. Null arrays give null, arrays without a token zeros.
    """
    codes = F.array_sort(F.transform(F.filter(tokens, lambda t: t != pad_id), lambda t: token_code(t, dims)))
    n = F.greatest(F.size(tokens), F.lit(max(positions, 1)))

    def vector(m):
        return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(dims - 1).cast("long")), lambda i: (
            (F.coalesce(F.element_at(m, 2 * i + 1), F.lit(0)) - F.coalesce(F.element_at(m, 2 * i), F.lit(0))) / n).cast("float"))

    zeros = F.array_repeat(F.lit(0.0).cast("float"), dims)
    return F.when(tokens.isNull(), None).when(F.exists(tokens, lambda t: t != pad_id), _let(_counts(codes), vector)).otherwise(zeros)


def hashing_fn(dims: int, pad_id: int, positions: int = 0) -> Callable:
    """The hashed vectors as an ``embed_fn``: a plug-in whose results SQL can repeat.
    1,024 rows are summed at once, with the codes of the smaller ids in a table."""
    import hashlib

    @lru_cache(maxsize=1 << 16)
    def code(token: int) -> int:
        return int(hashlib.md5(str(token).encode()).hexdigest()[:8], 16) % (2 * dims)

    table = np.array([code(t) for t in range(1 << 15)], dtype=np.int64)

    def part(tokens: list) -> np.ndarray:
        n = np.array([len(ids) for ids in tokens], dtype=np.int64)
        flat = np.concatenate([np.asarray(ids, dtype=np.int64) for ids in tokens] + [np.zeros(0, dtype=np.int64)])
        row, real = np.repeat(np.arange(len(tokens)), n), flat != pad_id
        row, flat = row[real], flat[real]
        near = (flat >= 0) & (flat < len(table))
        c = table[np.where(near, flat, 0)]
        c[~near] = [code(int(t)) for t in flat[~near]]
        signed = np.bincount(row * dims + (c >> 1), weights=2 * (c & 1) - 1, minlength=len(tokens) * dims)
        return (signed.reshape(-1, dims) / np.maximum(n, max(positions, 1))[:, None]).astype(np.float32)

    def fn(tokens: list) -> np.ndarray:
        return np.concatenate([part(tokens[i:i + 1024]) for i in range(0, max(1, len(tokens)), 1024)])
    return fn


def embed_udf(build: Callable[[], Callable]):
    """R7 with a model: iterator pandas UDF ``array<bigint> -> array<float>``.
    ``build()`` makes the ``embed_fn`` (loads the model) once per Python worker."""
    @F.pandas_udf(ArrayType(FloatType()))
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = None
        for toks in batches:
            fn = fn or build()
            known = toks.notna()
            out = pd.Series([None] * len(toks), index=toks.index, dtype=object)
            if known.any():
                out[known] = pd.Series(list(fn(list(toks[known]))), index=toks.index[known])
            yield out
    return _embed


def embedding(tokens: Column, params: Params = DEFAULT, build: Callable[[], Callable] | None = None,
              positions: int = 0) -> Column:
    """Vector of a token array: the hashed one, or the plug-in's that ``build()`` makes."""
    if build is None:
        return hashed_vector(tokens, params.dims, params.pad_token_id, positions)
    return embed_udf(build)(tokens)


def sq_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length arrays (in double)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) ** 2),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def cosine(a: Column, b: Column) -> Column:
    """R3 (dense): NULL when either norm is zero."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                      F.lit(0.0).cast("double"), lambda acc, v: acc + v)
    na = F.aggregate(F.transform(a, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0).cast("double"), lambda acc, v: acc + v)
    nb = F.aggregate(F.transform(b, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0).cast("double"), lambda acc, v: acc + v)
    return F.when((na > 0) & (nb > 0), dot / (F.sqrt(na) * F.sqrt(nb)))


def knn_exact(items: DataFrame, queries: DataFrame, k: int, params: Params = DEFAULT,
              item_key: str = "item_id", vec: str = "vector", digits: int | None = 6) -> DataFrame:
    """R9 + W2: ``query_id, rank, item_id, distance`` (squared L2, ascending;
    ties by item key). ``queries``: ``query_id, vector``.

    Up to ``params.knn_query_bytes`` of query vectors (measured) go to every
    task and the items are streamed where they lie. More queries than that
    stay distributed: the items are dealt to blocks, every query visits every
    block, and a task holds one block while the queries stream past it.
    """
    size = queries.agg(F.sum(F.size(vec) * F.lit(8))).first()[0] or 0
    near = _near_broadcast if size <= params.knn_query_bytes else _near_dealt
    cand = near(items, queries, k, params, item_key, vec)
    if digits is not None:
        cand = cand.withColumn("distance", F.round("distance", digits))
    w = Window.partitionBy("query_id").orderBy(F.col("distance").asc(), F.col(item_key).asc())
    return (cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("long"), item_key, "distance"))


_TILE = 512  # queries whose distances to a batch are held at a time


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _best_pairs(x: np.ndarray, q: np.ndarray, k: int, seen: np.ndarray):
    """Row and query numbers of pairs that may be among a query's k nearest,
    and their exact distances. ``seen`` holds each query's k-th distance so
    far and is lowered in place; pairs within rounding of it stay (ties)."""
    x2 = (x ** 2).sum(axis=1)
    for s in range(0, len(q), _TILE):
        t = q[s:s + _TILE]
        d = x2[:, None] - 2.0 * x @ t.T + (t ** 2).sum(axis=1)[None, :]
        bound = seen[s:s + _TILE]
        if len(x) >= k:
            np.minimum(bound, np.partition(d, k - 1, axis=0)[k - 1], out=bound)
        ri, qi = np.nonzero(d <= bound[None, :] + 2e-6 + 1e-9 * np.abs(np.where(np.isfinite(bound), bound, 0))[None, :])
        yield ri, qi + s, ((x[ri] - t[qi]) ** 2).sum(axis=1)


def _pair_schema(items: DataFrame, queries: DataFrame, item_key: str) -> str:
    return (f"query_id {queries.schema['query_id'].dataType.simpleString()}, "
            f"{item_key} {items.schema[item_key].dataType.simpleString()}, distance double")


def _near_broadcast(items, queries, k, params, item_key, vec) -> DataFrame:
    qpd = queries.select("query_id", vec).toPandas()   # within params.knn_query_bytes
    qids, qmat = qpd["query_id"].to_numpy(), _matrix(qpd[vec]) if len(qpd) else None

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.full(len(qids), np.inf)   # runs through the whole partition
        for b in batches:
            if b.empty or qmat is None:
                continue
            keys = b[item_key].to_numpy()
            for ri, qi, d in _best_pairs(_matrix(b[vec]), qmat, k, seen):
                yield pd.DataFrame({"query_id": qids[qi], item_key: keys[ri], "distance": d})

    return items.select(item_key, vec).mapInPandas(part, _pair_schema(items, queries, item_key))


def _near_dealt(items, queries, k, params, item_key, vec) -> DataFrame:
    blocks = max(1, -(-items.count() // params.knn_block_rows))
    it = items.select(F.pmod(F.xxhash64(item_key), F.lit(blocks)).alias("_block"), F.lit(0).alias("_kind"),
                      F.col(item_key).alias("_item"), F.lit(None).cast(queries.schema["query_id"].dataType).alias("_query"),
                      F.col(vec).alias("_v"))
    qs = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block"), F.lit(1).alias("_kind"),
                        F.lit(None).cast(items.schema[item_key].dataType).alias("_item"), F.col("query_id").alias("_query"),
                        F.col(vec).cast(items.schema[vec].dataType).alias("_v"))

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, keys, mats, x = None, [], [], None
        for b in batches:
            for (blk, kind), g in b.groupby(["_block", "_kind"], sort=True):
                if blk != block:
                    block, keys, mats, x = blk, [], [], None
                if kind == 0:
                    keys.append(g["_item"].to_numpy())
                    mats.append(_matrix(g["_v"]))
                elif mats:
                    if x is None:
                        x, ids = np.concatenate(mats), np.concatenate(keys)
                    qids = g["_query"].to_numpy()
                    for ri, qi, d in _best_pairs(x, _matrix(g["_v"]), k, np.full(len(g), np.inf)):
                        yield pd.DataFrame({"query_id": qids[qi], item_key: ids[ri], "distance": d})

    dealt = it.unionByName(qs).repartition("_block").sortWithinPartitions("_block", "_kind")
    return dealt.mapInPandas(part, _pair_schema(items, queries, item_key))


def knn_candidates(pairs: DataFrame, k: int, qvec: str = "qvec", ivec: str = "vector",
                   key=("doc_id", "text_idx", "chunk_no"), digits: int | None = 6) -> DataFrame:
    """R10 + W2 over bounded candidate pairs: adds ``distance`` and ``rank``."""
    d = sq_l2(F.col(qvec), F.col(ivec))
    scored = pairs.withColumn("distance", F.round(d, digits) if digits is not None else d)
    w = Window.partitionBy("query_id").orderBy(F.col("distance").asc(), *[F.col(c).asc() for c in key])
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
                 .withColumn("rank", F.col("rank").cast("long"))


def lsh_keys(df: DataFrame, key: str, vec: str, dims: int, n_tables: int = 8, n_proj: int = 4,
             width: float = 4.0, seed: int = 17) -> DataFrame:
    """Bucketed random projections (p-stable LSH for L2): per table, the key
    is a hash of ``floor((a.v + b) / width)`` over ``n_proj`` projections.
    Output ``key, table, bucket`` (one row per table)."""
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((dims, n_tables * n_proj))
    b = rng.uniform(0, width, n_tables * n_proj)
    mix = rng.integers(1, 2 ** 31 - 1, size=n_proj, dtype=np.int64)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec]])
            h = np.floor((x @ a + b) / width).astype(np.int64).reshape(len(pdf), n_tables, n_proj)
            bucket = (h * mix).sum(axis=2)
            ids = np.repeat(pdf[key].to_numpy(), n_tables)
            yield pd.DataFrame({key: ids, "table": np.tile(np.arange(n_tables, dtype=np.int32), len(pdf)),
                                "bucket": bucket.reshape(-1)})

    schema = f"{key} {df.schema[key].dataType.simpleString()}, table int, bucket long"
    return df.select(key, vec).mapInPandas(part, schema)


def knn_lsh(items: DataFrame, queries: DataFrame, k: int, params: Params = DEFAULT,
            item_key: str = "item_id", vec: str = "vector", n_tables: int = 8, n_proj: int = 4,
            width: float = 4.0, seed: int = 17) -> DataFrame:
    """Approximate kNN: candidates share an LSH bucket with the query in at
    least one table; candidates are then scored exactly (squared L2) and the
    k best kept. Opt-in: recall is measured against ``knn_exact``."""
    dims = params.dims
    nq = queries.count()
    from quarry.plans.util import bounded_broadcast
    qk = lsh_keys(queries, "query_id", vec, dims, n_tables, n_proj, width, seed)
    ik = lsh_keys(items, item_key, vec, dims, n_tables, n_proj, width, seed)
    cand = (ik.join(bounded_broadcast(qk, nq * n_tables, params.broadcast_max_rows), ["table", "bucket"])
              .select("query_id", item_key).distinct())
    qv = bounded_broadcast(queries.select("query_id", F.col(vec).alias("qvec")), nq, params.broadcast_max_rows)
    pairs = cand.join(items.select(item_key, vec), item_key).join(qv, "query_id")
    top = knn_candidates(pairs, k, qvec="qvec", ivec=vec, key=(item_key,))
    return top.select("query_id", "rank", item_key, "distance")
