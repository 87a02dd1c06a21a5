"""Alignment of two tokenizers' ids, and how often each id pair is linked.

Each text is encoded by both tokenizers in a task. The byte ends of the tokens
become dictionaries (end -> index); the intersection of their key sets, sorted,
gives the offsets where both end, and consecutive ones slice both id lists into
groups. All A-B pairs of a group are links; a slice's links are expanded on id
positions, in bounded runs (a slice with more links than a run is expanded over
its distinct ids and their counts instead, with the same result).

A document's distinct pairs, with the times each is linked, are written as two
arrays. Their corpus-wide document counts are partial/final sums, so a pair that
every document holds costs one row per task; the highest count per A id is a
window over the counts (at most |A| x |B| rows). To come back to the documents,
the pairs with the highest counts, as many as fit the broadcast bound, are
broadcast; what is left has only rare pairs, which are joined by shuffle.

Defined cases: a null or empty text, and one whose token bytes differ from the
encoded string, has no tokens and zeros; rows that repeat id and text are one
document in the counts and have a result each; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_BYTES, materialise, text_hash

#: Links expanded at once.
RUN = 1 << 18
#: Result rows held at once.
ROWS = 500
#: Bytes of a broadcast row of (pair, count, best).
ROW_BYTES = 64

# FIXED VALUES: the split pattern and byte table of the byte-level encoding.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


class Vocabulary:
    """``encode(text)`` to ids, ``parts``: the bytes of every id, and ``lead``: what goes before a text.

    ``lossless``: the bytes of the ids of any string are that string's bytes.
    """

    def __init__(self, encode, parts: list[bytes], lead: str, lossless: bool = False):
        self.encode, self.parts, self.lead, self.lossless = encode, parts, lead, lossless
        self.lengths = np.array([len(p) for p in parts], dtype=np.int64)

    def spells(self, ids: list[int], want: bytes) -> bool:
        return self.lossless or b"".join(map(self.parts.__getitem__, ids)) == want


def byte_level(data: bytes) -> Vocabulary:
    """A byte-level BPE in the JSON format of ``tokenizers``; special strings are plain text.

    Where every merge makes the next larger id, as in vocabularies numbered by
    training order, ids are merge ranks and the faster ``tiktoken`` encodes; with
    all 256 bytes in the vocabulary and no normaliser it loses nothing.
    """
    spec = json.loads(data)
    model = spec["model"]
    spare = [b for b in range(256) if b not in set(PRINTABLE)]
    of = {chr(b): b for b in PRINTABLE} | {chr(256 + n): b for n, b in enumerate(spare)}
    special = {t["content"] for t in spec["added_tokens"]}
    parts = [b""] * (1 + max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
    ranks = {}
    for token, i in model["vocab"].items():
        parts[i] = token.encode() if token in special else bytes(of[c] for c in token)
        if token not in special:
            ranks[parts[i]] = i
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"]["".join(m)] for m in merges]
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    if plain and not spec.get("normalizer") and made == sorted(set(made)) and len(ranks) == len(made) + 256:
        import tiktoken

        return Vocabulary(tiktoken.Encoding("byte_level", pat_str=SPLIT, mergeable_ranks=ranks,
                                            special_tokens={}).encode_ordinary, parts, " ", lossless=True)
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(data.decode())
    t.encode_special_tokens = True
    return Vocabulary(lambda text: t.encode(text, add_special_tokens=False).ids, parts, " ")


def pieces(data: bytes) -> Vocabulary:
    """A ``sentencepiece`` model; it adds the leading space itself."""
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_proto=data)
    code = re.compile("<0x([0-9A-F]{2})>")

    def part(i: int) -> bytes:
        piece = m.id_to_piece(i)
        byte = code.fullmatch(piece) if m.is_byte(i) else None
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    return Vocabulary(m.encode, [part(i) for i in range(m.get_piece_size())], "")


def _load(data: bytes) -> Vocabulary:
    return byte_level(data) if data.lstrip()[:1] == b"{" else pieces(data)


class Pair:
    """Both vocabularies, and the text of every id with each separator that may follow it."""

    def __init__(self, a_file: bytes, b_file: bytes):
        self.a, self.b = _load(a_file), _load(b_file)
        self.na, self.nb = len(self.a.parts), len(self.b.parts)
        self.written = [f"{i}{sep}" for n, close in ((self.na, "|"), (self.nb, ";")) for sep in (",", close) for i in range(n)]


@functools.lru_cache(maxsize=2)
def _cached(a_file: bytes, b_file: bytes) -> Pair:
    return Pair(a_file, b_file)


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (one past) in both lists of token ends where both tokens end."""
    at_a, at_b = dict(zip(a.tolist(), range(1, len(a) + 1))), dict(zip(b.tolist(), range(1, len(b) + 1)))
    both = sorted(at_a.keys() & at_b.keys())
    return tuple(np.fromiter(map(at.__getitem__, both), np.int64, len(both)) for at in (at_a, at_b))


def _expanded(a: np.ndarray, b: np.ndarray, sa: np.ndarray, sb: np.ndarray, na: np.ndarray, nb: np.ndarray,
              width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes ``a * width + b`` of the links of slices starting at ``sa``, ``sb`` and their times."""
    per = na * nb
    g = np.repeat(np.arange(len(per)), per)
    k = np.arange(len(g)) - np.repeat(np.cumsum(per) - per, per)
    return np.unique(a[sa[g] + k // nb[g]] * width + b[sb[g] + k % nb[g]], return_counts=True)


def _wide(a: np.ndarray, b: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same for one slice, over its distinct ids, a bounded run at a time."""
    (ua, ca), (ub, cb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    step = max(1, RUN // len(ub))
    for i in range(0, len(ua), step):
        yield ((ua[i:i + step, None] * width + ub[None, :]).ravel(), (ca[i:i + step, None] * cb[None, :]).ravel())


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(found) == 1:
        return found[0]
    codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    times = np.zeros(len(codes), np.int64)
    np.add.at(times, at, np.concatenate([t for _, t in found]))
    return codes, times


def links(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a document as codes, ascending, and how often each is linked."""
    sa, sb = np.concatenate([[0], cut_a[:-1]]), np.concatenate([[0], cut_b[:-1]])
    na, nb = cut_a - sa, cut_b - sb
    per, found = na * nb, []
    wide = np.flatnonzero(per > RUN)
    for g in wide.tolist():
        found += list(_wide(a[sa[g]:cut_a[g]], b[sb[g]:cut_b[g]], width))
    rest = np.flatnonzero(per <= RUN)
    run = (np.cumsum(per[rest]) - per[rest]) // RUN if len(rest) else rest
    for part in np.split(rest, np.flatnonzero(np.diff(run)) + 1) if len(rest) else []:
        found.append(_expanded(a, b, sa[part], sb[part], na[part], nb[part], width))
        if len(found) > 8:
            found = [_summed(found)]
    return _summed(found)


def groups_text(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, v: Pair) -> str:
    """``a1,a2|b1;a3|b2,b3``."""
    code_a, code_b = a.copy(), b + 2 * v.na
    code_a[cut_a - 1] += v.na
    code_b[cut_b - 1] += v.nb
    at = np.empty(len(a) + len(b), np.int64)
    at[np.arange(len(a)) + np.repeat(np.concatenate([[0], cut_b[:-1]]), np.diff(cut_a, prepend=0))] = code_a
    at[np.arange(len(b)) + np.repeat(cut_a, np.diff(cut_b, prepend=0))] = code_b
    return "".join(map(v.written.__getitem__, at.tolist()))[:-1]


def align(text: str | None, v: Pair):
    """``ids_a, ids_b, cut_a, cut_b`` of a text, or None if it has no tokens."""
    if not text:
        return None
    want = (" " + text).encode()
    a, b = v.a.encode(v.a.lead + text), v.b.encode(v.b.lead + text)
    if not (v.a.spells(a, want) and v.b.spells(b, want)):
        return None
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    return a, b, *common_ends(np.cumsum(v.a.lengths[a]), np.cumsum(v.b.lengths[b]))


def measure(text: str | None, v: Pair) -> tuple:
    """``n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` of a text."""
    got = align(text, v)
    if got is None:
        return 0, 0, 0, 0, "", (), ()
    a, b, cut_a, cut_b = got
    pairs, times = links(a, b, cut_a, cut_b, v.nb)
    sha = hashlib.sha256(groups_text(a, b, cut_a, cut_b, v).encode()).hexdigest()
    return len(a), len(b), len(cut_a), int(times.sum()), sha, pairs, times


def _lists(arrays: list, kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays), kind))


def _encoded(docs: DataFrame, a_file: bytes, b_file: bytes, v: Pair) -> DataFrame:
    """Per row: its measures, and its distinct pairs with their times."""
    files = docs.sparkSession.sparkContext.broadcast((a_file, b_file))
    code = "int" if v.na * v.nb < 1 << 31 else "long"
    text = F.col("text").cast("string")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(text).alias("h"), text.alias("text"))
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, kind = _cached(*files.value), pa.int32() if code == "int" else pa.int64()
        for part in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            *plain, pairs, times = zip(*(measure(t.as_py(), v) for t in part.column(2)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in plain[:4]), pa.array(plain[4], pa.string()),
                 _lists(pairs, kind), _lists(times, pa.int64())], ["doc_id", "h", *names])

    rows = src.mapInArrow(run, "doc_id long, h long, n_a long, n_b long, n_groups long, n_links long, "
                               f"groups_sha256 string, pairs array<{code}>, times array<long>")
    return rows.withColumn("row", F.monotonically_increasing_id())


def pair_counts(encoded: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: documents that hold a pair linked, and whether that is its A id's highest count."""
    once = encoded.groupBy("doc_id", "h").agg(F.count("*").alias("c")).filter("c > 1")
    docs = encoded if once.isEmpty() else encoded.dropDuplicates(["doc_id", "h"])
    n = docs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    top = n.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("n").alias("top"))
    with_a = n.withColumn("a", F.expr(f"pair div {width}"))
    return with_a.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _split(counts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The pairs of the highest counts, within the broadcast bound, and the rest if any."""
    bins = counts.groupBy(F.floor(F.log2(F.col("n").cast("double"))).alias("b")).agg(F.count("*").alias("c"))
    room, cut = BROADCAST_BYTES // ROW_BYTES, None
    for b, c in sorted(bins.collect(), reverse=True):
        room -= c
        if room < 0:
            break
        cut = b
    if room >= 0:
        return counts, None
    hot = F.lit(False) if cut is None else F.col("n") >= F.lit(1 << int(cut))
    return counts.filter(hot), counts.filter(~hot)


def alignment(docs: DataFrame, a_file: bytes, b_file: bytes) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``."""
    v = Pair(a_file, b_file)
    rows = materialise(_encoded(docs, a_file, b_file, v), "align-rows")
    counts = materialise(pair_counts(rows, v.nb), "align-counts")
    hot, cold = _split(counts)
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("z")).select(
        "row", F.col("z.pairs").alias("pair"), F.col("z.times").alias("t"))
    measures = (F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("n_best"),
                F.sum(F.col("t") * F.col("n")).alias("count_sum"))
    sums = each.join(F.broadcast(hot), "pair").groupBy("row").agg(*measures)
    if cold is not None:
        rare = each.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(cold, "pair").groupBy("row").agg(*measures)
        sums = sums.unionByName(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    j = rows.drop("pairs", "times").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return j.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
