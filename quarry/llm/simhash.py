"""SimHash near-duplicate detection with pigeonring candidate filtering.

Fingerprint: 64 bits over the XXH64 hashes (seed 42) of a text's word
shingles; a bit is set when it is set in over half of them.

Candidates (pigeonring principle): cut the fingerprint into ``m = d + 1``
segments on a ring. If two fingerprints differ in at most ``d`` bits, then
from some segment on, every chain of ``l`` consecutive segments differs in at
most ``floor(l * d / m)`` bits. The first two links of such a chain make the
join key: one side emits its exact (segment, next segment), the other also all
one-bit changes of the next segment, so a bucket is as selective as two
segments. The longer chains are checked on the joined rows before the full
Hamming check.

Exact copies of a fingerprint are one node: groups of any size cost one row in
the join. Components are found by repeated min-label hooking and shortcutting
as joins over the links; nothing is collected to the driver but a count of
changed labels.

Defined cases: null or empty texts (no words) have fingerprint zero and link
like any other; a text of fewer words than a shingle is one shingle; repeated
rows are returned each; a null ``doc_id`` never becomes a component id unless
the whole component has none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise, small, text_hash

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text; shingles are hashed in bounded chunks."""
    from xxhash import xxh64_intdigest

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < words:
        shingles = iter([b" ".join(w)])
    else:
        shingles = map(b" ".join, zip(*(islice(w, i, None) for i in range(words))))
    counts, n = np.zeros(64, dtype=np.int64), 0
    while part := list(map(xxh64_intdigest, islice(shingles, _CHUNK), repeat(SEED))):
        bits = np.unpackbits(np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * counts > n).view(">u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, h, fp``: text hash and signed 64-bit fingerprint of every row."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in b.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("h"), pa.array(fps.view(np.int64))], ["doc_id", "h", "fp"])

    src = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                      text_hash(F.col("text").cast("string")).alias("h"))
    return src.mapInArrow(part, "doc_id long, h long, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of the ring's segments, widths as even as possible."""
    m = max_bits + 1
    cuts = [round(64 * i / m) for i in range(m + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(m)]


def _segment(c: Column, seg: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(c, seg[0]).bitwiseAND(F.lit((1 << seg[1]) - 1))


def candidate_links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a < b`` between distinct fingerprints ``nodes(fp)`` at most ``max_bits`` apart."""
    if not 0 <= max_bits <= 15:
        raise ValueError("max_bits must be between 0 and 15")
    if max_bits == 0:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter(F.lit(False))
    segs = _segments(max_bits)
    m = len(segs)

    def key(i: int, flip: Column) -> Column:
        nxt = segs[(i + 1) % m]
        return F.struct(F.lit(i).cast("byte").alias("i"),
                        F.shiftleft(_segment(F.col("fp"), segs[i]), nxt[1])
                        .bitwiseXOR(_segment(F.col("fp"), nxt).bitwiseXOR(flip)).alias("v"))

    exact = nodes.select(F.col("fp").alias("a"),
                         F.explode(F.array(*[key(i, F.lit(0).cast("long")) for i in range(m)])).alias("k"))
    near = nodes.select(F.col("fp").alias("b"), F.explode(F.array(*[
        key(i, F.lit(f).cast("long")) for i in range(m)
        for f in [0, *(1 << j for j in range(segs[(i + 1) % m][1]))]])).alias("k"))
    exact = exact.select("a", F.col("k.i").alias("i"), F.col("k.v").alias("v"))
    near = near.select("b", F.col("k.i").alias("i"), F.col("k.v").alias("v"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    # chains of l >= 3 segments from i on; l = m is the Hamming check itself
    chains = F.lit(False)
    for i in range(m):
        ok = F.col("i") == i
        diff = F.bit_count(_segment(x, segs[i])) + F.bit_count(_segment(x, segs[(i + 1) % m]))
        for length in range(3, m + 1):
            diff = diff + F.bit_count(_segment(x, segs[(i + length - 1) % m]))
            ok = ok & (diff <= length * max_bits // m)
        chains = chains | ok
    # Spark sizes both sides as if a node were one row; 68 keys a node are no table to broadcast
    j = exact.hint("merge").join(near, (exact["i"] == near["i"]) & (exact["v"] == near["v"])
                   & (F.col("a") != F.col("b")) & (F.bit_count(x) <= max_bits))
    j = j.select(exact["i"].alias("i"), "a", "b").filter(chains)
    return j.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable, for every node with a link.

    Alternating large-star and small-star rounds: linear rows per round, few
    rounds even for long chains. Each round is written to the shared folder.
    """
    edges = materialise(links.select("a", "b").filter("a <> b"), "simhash-links")
    before = None
    while True:
        # large star: every larger neighbour is hooked to the smallest of the neighbourhood
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("mv")).select(F.col("u").alias("k"), F.least("u", "mv").alias("m"))
        large = (both.join(low, both["u"] == low["k"]).filter("v > u")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct())
        large = materialise(large, "simhash-large")
        # small star: smaller neighbours and the node itself are hooked to the smallest
        low = large.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "k")
        j = large.join(low, large["b"] == low["k"])
        nxt = (j.select(F.col("m").alias("a"), F.col("a").alias("b"))
               .unionAll(low.select(F.col("m").alias("a"), F.col("k").alias("b")))
               .filter("a <> b").distinct())
        edges = materialise(nxt, "simhash-small")
        # a fixed point is a set of stars: the same edges come out of a round
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return stars.unionAll(roots)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, h, fp, label, component_id`` for every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable over fingerprints at
    most ``max_bits`` bits apart, the document itself included; ``label`` is
    the component's smallest fingerprint.
    """
    fps = materialise(fingerprints(docs, words), "simhash-fp")
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    comp = components(candidate_links(classes.select("fp"), max_bits))
    lab = classes.join(comp, classes["fp"] == comp["node"], "left").select(
        classes["fp"], "first_id", F.coalesce("label", classes["fp"]).alias("label"))
    ids = lab.groupBy("label").agg(F.min("first_id").alias("component_id"))
    lab = lab.join(ids, "label").select(F.col("fp").alias("fp_"), "label", "component_id")
    return fps.join(lab, fps["fp"] == lab["fp_"]).select("doc_id", "h", "fp", "label", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of every near-duplicate component.

    The one with the smallest ``doc_id`` (then text hash) stays; of rows that
    repeat id and text one stays. All columns are kept.
    """
    found = materialise(near_duplicates(docs, words, max_bits).select(
        F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "label"), "simhash-found")
    first = found.groupBy("label").agg(
        F.min(F.struct(F.col("__id").isNull().alias("n"), "__id", "__h")).alias("f")).select(
        "label", F.col("f.__id").alias("fid"), F.col("f.__h").alias("fh"))
    keys = found.groupBy("label", "__id", "__h").agg(F.count("*").alias("n"))
    marked = keys.join(first, "label")
    marked = materialise(marked.select(
        "__id", "__h", "n", (F.col("__id").eqNullSafe(F.col("fid")) & (F.col("__h") == F.col("fh"))).alias("stays"))
        .filter("not stays or n > 1"), "simhash-marked")
    gone = small(marked.filter("not stays").select("__id", "__h").distinct(), 48)
    keyed = docs.withColumn("__doc_h", text_hash(docs["text"].cast("string")))
    cond = lambda right: (keyed["doc_id"].cast("long").eqNullSafe(right["__id"])
                          & (keyed["__doc_h"] == right["__h"]))
    kept = keyed.join(gone, cond(gone), "left_anti")
    again = marked.filter("stays and n > 1").select("__id", "__h")
    if again.isEmpty():
        return kept.select(*docs.columns)
    again = small(again, 48)
    once = keyed.join(again, cond(again), "left_semi").dropDuplicates(["doc_id", "__doc_h"])
    cond2 = kept["doc_id"].cast("long").eqNullSafe(again["__id"]) & (kept["__doc_h"] == again["__h"])
    return kept.join(again, cond2, "left_anti").unionByName(once).select(*docs.columns)
