"""Exact substring duplicates through longest-previous-factor (LPF) arrays.

A byte is repeated if it lies in a string of ``min_bytes`` bytes that also
starts elsewhere (any document, or another place of the same one).

1. *Deal the suffixes.* Every start of a ``min_bytes`` string belongs to its
   minimiser: the leftmost smallest hash of the ``GRAM``-byte grams inside the
   string. Equal strings have equal minimisers, so they meet under the same
   anchor hash. Consecutive starts with one minimiser form a *piece*; a piece
   is a row of hashes and offsets, about one per 85 bytes of text.
2. *Exact copies of pieces* are counted by aggregation: a common passage is
   one row per task before the shuffle, and all its places are repeated.
3. *LPF arrays* settle the rest: the distinct pieces of an anchor that has
   more than one are cut from the text, dealt to bounded blocks, and a suffix
   array with LCPs is built over each block. Previous and next smaller
   positions in suffix order give every start its longest earlier match; a
   start with a match of ``min_bytes`` is a later copy, its source the kept
   one. ``keep_first`` removes the later copies only, otherwise both go.
   An anchor whose distinct pieces exceed a block (a phrase that very many
   contexts share) is settled by counting digests of its strings instead: the
   same answer with no group in one task.
4. The ranges are merged to maximal runs per document and cut from the text.

The text meets the wanted pieces, and later the runs, in two shuffle joins; it
travels compressed.

Defined cases: null text is empty; texts shorter than ``min_bytes`` have no
repeats; repeated rows are places of their own (the whole text is repeated);
matches never cross documents; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise, small, text_hash

MIN_BYTES = 200
GRAM = 32
#: Bytes of a text that are hashed at a time.
_STRIDE = 1 << 21
#: Bytes of piece text that one suffix array is built over, about.
BLOCK_BYTES = 1 << 19
SALTS = 64


# ---------------------------------------------------------------- pieces
def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the GRAM bytes from each position on (by doubling)."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    step, mul = 1, np.uint64(0xBF58476D1CE4E5B9)
    while step < GRAM:
        h = h[:-step] * mul + h[step:]
        mul = mul * mul + np.uint64(2 * step)
        step *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h


def _pieces(text: bytes, min_bytes: int) -> Iterator[tuple[int, int, int, int]]:
    """``lo, n, anchor, content``: starts lo..lo+n-1 share a minimiser."""
    from xxhash import xxh3_64_intdigest

    width = min_bytes - GRAM + 1  # grams in a string
    low = np.uint64((1 << width.bit_length()) - 1)
    whole = np.frombuffer(text, dtype=np.uint8)
    view = memoryview(text)
    with np.errstate(over="ignore"):
        for s in range(0, len(text) - min_bytes + 1, _STRIDE):
            h = _gram_hashes(whole[s:min(len(text), s + _STRIDE + min_bytes - 1)])
            v, have = h & ~low, 1
            while have < width:  # smallest of `have` grams, its offset in the low bits
                step = min(have, width - have)
                v = np.minimum(v[:-step], v[step:] + np.uint64(step))
                have += step
            at = np.arange(len(v)) + (v & low).astype(np.int64)
            cut = np.flatnonzero(at[1:] != at[:-1]) + 1
            los = np.concatenate([[0], cut])
            ns = np.diff(np.concatenate([los, [len(v)]]))
            anchors = h[at[los]].view(np.int64).tolist()
            for lo, n, a in zip((los + s).tolist(), ns.tolist(), anchors):
                yield lo, n, a, xxh3_64_intdigest(view[lo:lo + n + min_bytes - 1]) - (1 << 63)


def pieces(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``doc_id, h, lo, n, anchor, content`` of every piece of every text."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "h", "lo", "n", "anchor", "content"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        out: list[tuple] = []
        for b in batches:
            for d, h, t in zip(b.column("doc_id").to_pylist(), b.column("h").to_pylist(), b.column("t")):
                for p in _pieces(t.as_py(), min_bytes):
                    out.append((d, h, *p))
                    if len(out) >= 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return _keyed(docs).filter(F.octet_length("t") >= min_bytes).mapInArrow(
        part, "doc_id long, h long, lo int, n int, anchor long, content long")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(text).alias("h"),
                       F.coalesce(text, F.lit("")).cast("binary").alias("t"))


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id, h, z``: the texts' bytes, compressed for a shuffle."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        pack = ZstdCompressor(level=1).compress
        for b in batches:
            z = [pack(t.as_py()) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), pa.array(z, pa.binary())], ["doc_id", "h", "z"])

    return _keyed(docs).mapInArrow(part, "doc_id long, h long, z binary")


# ---------------------------------------------------------------- suffix arrays
def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes by their first ``depth`` codes or more (equal ones
    by position) and the LCP of each with the one before it, by prefix doubling."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    levels, step = [rank], 1
    while step < depth:
        nxt = np.zeros(n, dtype=np.int64)
        if step < n:
            nxt[:n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + nxt, return_inverse=True)[1].astype(np.int64)
        levels.append(rank.astype(np.int32))
        step *= 2
    sa = np.argsort(rank, kind="stable")
    lcp = np.zeros(n, dtype=np.int64)
    i, j = sa[1:].copy(), sa[:-1].copy()
    got, size = np.zeros(n - 1, dtype=np.int64), step
    for level in reversed(levels):
        ok = (i < n) & (j < n)
        eq = ok & (level[np.minimum(i, n - 1)] == level[np.minimum(j, n - 1)])
        got += eq * size
        i, j = i + eq * size, j + eq * size
        size //= 2
    lcp[1:] = got
    return sa, lcp


def lpf(sa: list[int], lcp: list[int]) -> dict[int, tuple[int, int]]:
    """Longest previous factor of every position: ``{position: (length, source)}``.

    One pass over the suffix order with a stack: the entry below on the stack
    is the previous smaller position, the one that pops it the next smaller.
    """
    found: dict[int, tuple[int, int]] = {}
    stack: list[tuple[int, int]] = []  # position, LCP with the entry below
    for p, common in zip([*sa, -1], [*lcp, 0]):
        while stack and stack[-1][0] > p:
            q, below = stack.pop()
            if below >= common:
                found[q] = (below, stack[-1][0]) if stack else (0, -1)
            else:
                found[q] = (common, p)
            common = min(common, below)
        stack.append((p, common if stack else 0))
    return found


def _block(g: pd.DataFrame, min_bytes: int) -> pd.DataFrame:
    """Starts of each piece in the block that are later copies, or copies at all."""
    g = g.sort_values(["doc_id", "h", "lo"], na_position="last", kind="stable").reset_index(drop=True)
    sizes = np.array([len(t) for t in g["t"]])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    codes = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
    for k, (b, t) in enumerate(zip(begins, g["t"])):
        codes[b:b + len(t)] = np.frombuffer(t, dtype=np.uint8)
        codes[b + len(t)] = 256 + k  # ends differ, so no match runs over one
    sa, lcp = suffix_array(codes, min_bytes)
    starts = np.zeros(len(codes) + 1, dtype=bool)
    for b, n in zip(begins, g["n"]):
        starts[b:b + n] = True
    # only starts of whole strings are kept; an LCP over dropped neighbours is their smallest
    # (reduceat's last segment must end at the last kept start: the end marks sort behind it)
    keep = np.flatnonzero(starts[sa])
    low = np.minimum.reduceat(lcp[:keep[-1] + 1], np.concatenate([[0], keep[:-1] + 1])) if len(keep) else lcp[:0]
    later, copies = np.zeros(len(codes), dtype=bool), np.zeros(len(codes), dtype=bool)
    for p, (length, src) in lpf(sa[keep].tolist(), low.tolist()).items():
        if length >= min_bytes:
            later[p] = copies[p] = copies[src] = True
    rows = []
    for k, (b, n) in enumerate(zip(begins, g["n"])):
        for kind, flag in (("later", later), ("copy", copies)):
            f = np.concatenate([[0], flag[b:b + n].astype(np.int8), [0]])
            edge = np.flatnonzero(np.diff(f))
            rows += [(k, kind, int(x), int(y)) for x, y in zip(edge[::2], edge[1::2])]
    out = pd.DataFrame(rows, columns=["k", "kind", "x", "y"])
    src = g.loc[out["k"]].reset_index(drop=True)
    return pd.DataFrame({"doc_id": src["doc_id"], "h": src["h"], "many": src["many"], "kind": out["kind"],
                         "lo": (src["lo"] + out["x"]).astype("int64"),
                         "hi": (src["lo"] + out["y"] - 1 + min_bytes).astype("int64")})


# ---------------------------------------------------------------- operator
def repeated_spans(docs: DataFrame, min_bytes: int = MIN_BYTES, keep_first: bool = False) -> DataFrame:
    """``doc_id, h, lo, hi``: the maximal byte ranges to remove.

    ``keep_first``: of equal strings the first place, by (doc_id, text hash,
    position), stays.
    """
    if min_bytes < 2 * GRAM:
        raise ValueError(f"min_bytes must be at least {2 * GRAM}")
    cut = materialise(pieces(docs, min_bytes), "suffix-pieces")
    shared = (cut.groupBy("anchor").agg(F.count("*").alias("c"), F.min("content").alias("x"), F.max("content").alias("y"))
              .filter("c > 1").select(F.col("anchor").alias("a"), (F.col("x") != F.col("y")).alias("mixed")))
    shared = materialise(shared, "suffix-shared")
    occ = materialise(cut.join(small(shared, 24), F.col("anchor") == F.col("a")).drop("a"), "suffix-places")
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h", "lo")
    contents = materialise(occ.groupBy("anchor", "content").agg(
        F.count("*").alias("n_occ"), F.max("mixed").alias("mixed"), F.max("n").alias("n"),
        F.min(place).alias("first")), "suffix-contents")

    # pieces that occur more than once: whole
    many = contents.filter("n_occ > 1").select(
        F.col("anchor").alias("a"), F.col("content").alias("c"), "first")
    j = occ.join(small(many, 64), (F.col("anchor") == F.col("a")) & (F.col("content") == F.col("c")))
    if keep_first:
        j = j.filter(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.h"))
                       & (F.col("lo") == F.col("first.lo"))))
    spans = j.select("doc_id", "h", F.col("lo").cast("long").alias("lo"),
                     (F.col("lo") + F.col("n") - 1 + min_bytes).cast("long").alias("hi"))

    # distinct pieces under one anchor: LPF over bounded blocks, digests where they exceed one
    mixed = contents.filter("mixed").select("anchor", "n_occ", "n", "first.*")
    weight = mixed.groupBy(F.col("anchor").alias("a")).agg(F.sum(F.col("n") + min_bytes).alias("bytes"))
    mixed = mixed.join(weight, F.col("anchor") == F.col("a")).withColumn("wide", F.col("bytes") > BLOCK_BYTES)
    total = contents.filter("mixed").agg(F.sum(F.col("n") + min_bytes)).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    wanted = mixed.groupBy(F.col("doc_id").alias("w_id"), F.col("h").alias("w_h")).agg(
        F.collect_list(F.struct((F.col("n_occ") > 1).alias("many"), "wide", "n", "lo",
                                F.pmod(F.xxhash64("anchor"), F.lit(blocks)).alias("block"))).alias("w"))
    src = _packed(docs)
    cut_text = src.join(wanted, src["doc_id"].eqNullSafe(wanted["w_id"]) & (src["h"] == wanted["w_h"])).select(
        "doc_id", "h", "z", "w")
    if _repeats(docs):
        cut_text = cut_text.dropDuplicates(["doc_id", "h"])
    strings = materialise(_cut(cut_text, min_bytes), "suffix-strings")
    fine = strings.filter("not wide").groupBy("block").applyInPandas(
        lambda g: _block(g, min_bytes), "doc_id long, h long, many boolean, kind string, lo long, hi long")
    fine = fine.filter("kind = 'later'" if keep_first else "kind = 'copy' and not many").select("doc_id", "h", "lo", "hi")
    wide = _equal_strings(strings.filter("wide").select(
        "doc_id", "h", "many", F.col("lo").cast("long").alias("lo"), F.col("t").alias("d")), keep_first)
    wide = wide.select("doc_id", "h", "lo", (F.col("lo") + min_bytes).alias("hi"))
    return _runs(spans.unionByName(fine).unionByName(wide))


def _equal_strings(strings: DataFrame, keep_first: bool) -> DataFrame:
    """Rows of ``strings(doc_id, h, many, lo, d)`` whose digest ``d`` occurs again.

    Ranked within (digest, salt) first; the first row of each, at most
    ``SALTS`` per digest, is then ranked within the digest, so no group grows
    with the number of equal strings.
    """
    place = [F.col("doc_id").isNull(), "doc_id", "h", "lo"]
    salted = strings.withColumn("salt", F.pmod(F.xxhash64("doc_id", "h", "lo"), F.lit(SALTS)))
    near = Window.partitionBy("d", "salt")
    salted = materialise(salted.withColumns({
        "nth": F.row_number().over(near.orderBy(*place)), "n": F.count("*").over(near)}), "suffix-equal")
    far = Window.partitionBy("d")
    firsts = salted.filter("nth = 1").withColumns({
        "nth": F.row_number().over(far.orderBy(*place)), "n_d": F.count("*").over(far)})
    rest = salted.filter("nth > 1")
    if keep_first:
        return firsts.filter("nth > 1").drop("n_d").unionByName(rest)
    return firsts.filter("n > 1 or n_d > 1").drop("n_d").unionByName(rest).filter("not many")


def _cut(texts: DataFrame, min_bytes: int) -> DataFrame:
    """The wanted pieces' bytes; of wide ones the digest of every string instead."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        from zstandard import ZstdDecompressor

        names = ["doc_id", "h", "many", "wide", "block", "lo", "n", "t"]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        unpack = ZstdDecompressor().decompress
        out: list[tuple] = []
        for b in batches:
            for d, h, z, w in zip(b.column("doc_id").to_pylist(), b.column("h").to_pylist(), b.column("z"), b.column("w")):
                t = unpack(z.as_py())
                for p in w.as_py():
                    lo, n = p["lo"], p["n"]
                    if p["wide"]:
                        out += [(d, h, p["many"], True, p["block"], i, 1, xxh3_128_digest(t[i:i + min_bytes])) for i in range(lo, lo + n)]
                    else:
                        out.append((d, h, p["many"], False, p["block"], lo, n, t[lo:lo + n - 1 + min_bytes]))
                    if len(out) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return texts.mapInArrow(part, "doc_id long, h long, many boolean, wide boolean, block long, lo int, n int, t binary")


def _runs(spans: DataFrame) -> DataFrame:
    """Overlapping or touching ranges of a document as one."""
    of = Window.partitionBy("doc_id", "h").orderBy("lo", "hi")
    reach = F.max("hi").over(of.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(reach >= F.col("lo"), 0).otherwise(1))
    numbered = marked.withColumn("run", F.sum("new").over(of.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc_id", "h", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def _repeats(docs: DataFrame) -> bool:
    """Whether some row repeats another's id and text."""
    k = _keyed(docs).groupBy("doc_id", "h").count().filter("count > 1")
    return not k.isEmpty()


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, keep_first: bool = False) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the merged removed ranges and the bytes left of every row."""
    per = repeated_spans(docs, min_bytes, keep_first).groupBy(F.col("doc_id").alias("s_id"), F.col("h").alias("s_h")).agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    src = _packed(docs)
    j = src.join(per, src["doc_id"].eqNullSafe(per["s_id"]) & (src["h"] == per["s_h"]), "left").select("doc_id", "z", "spans")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        unpack = ZstdDecompressor().decompress
        span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
        for b in batches:
            for s in range(0, b.num_rows, 256):
                c = b.slice(s, 256)
                ids, ns, runs, kept = [], [], [], []
                for d, z, sp in zip(c.column("doc_id"), c.column("z"), c.column("spans")):
                    t, m = unpack(z.as_py()), sp.as_py() or []
                    edge = [0, *(e for run in m for e in (run["lo"], run["hi"])), len(t)]
                    ids.append(d.as_py())
                    ns.append(len(t))
                    runs.append(m)
                    kept.append(b"".join(t[x:y] for x, y in zip(edge[::2], edge[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(runs, span), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"])

    return j.mapInArrow(part, "doc_id long, n_bytes long, spans array<struct<lo: long, hi: long>>, kept binary")
