"""Passage chunking (C1-C7) and the default tokenizer plug-in (U4).

All built-in expressions: split -> posexplode -> token array -> window starts
from a closed form -> slice -> pad. The recursive variant (C3/C4) is a loop
of DataFrame levels (each level halves the pieces that are still too long),
with the pending pieces checkpointed per level to cut lineage.

Tokenizer plug-in: any function ``Column(text) -> Column(array<bigint>)``.
The default is a hashing word tokenizer (lowercased whitespace words, id =
first 32 bits of md5 mod ``vocab`` + 1; id 0 is padding) — a stand-in for a
model tokenizer, computed in the JVM; ``batch_hash_tokenizer`` gives the same
ids from Arrow batches, for jobs over whole corpora.
"""

from __future__ import annotations

import hashlib
from typing import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.config import DEFAULT, Params, WS_PATTERN

HASH_VOCAB = 30000
BATCH_BYTES = 1 << 22


def hash_tokenizer(text: Column, vocab: int = HASH_VOCAB) -> Column:
    words = F.filter(F.split(F.lower(text), WS_PATTERN), lambda w: w != "")
    return F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % vocab + 1)


def batch_hash_tokenizer(text: Column, vocab: int = HASH_VOCAB) -> Column:
    """The ids of ``hash_tokenizer``; an Arrow batch is taken in parts of about
    ``BATCH_BYTES`` of text, and a word is hashed once in a part."""
    def part(texts):
        words = pc.split_pattern(pc.replace_substring_regex(texts, WS_PATTERN.replace(" ", ""), " "), " ")
        found = words.flatten().dictionary_encode()
        distinct = found.dictionary.cast(pa.binary()).to_pylist()
        hashes = np.frombuffer(b"".join(hashlib.md5(w).digest()[:4] for w in distinct), dtype=">u4")
        # 0 is no word: what the split leaves beside white space
        known = np.where([w != b"" for w in distinct], hashes.astype(np.int64) % vocab + 1, 0)
        tokens = known[found.indices.to_numpy()]
        ends = np.cumsum(words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        kept = np.append(0, np.cumsum(tokens > 0))[np.append(0, ends).astype(np.int64)]
        return pa.ListArray.from_arrays(pa.array(kept, pa.int32()), pa.array(tokens[tokens > 0]), mask=texts.is_null())

    @F.arrow_udf("array<bigint>")
    def ids(texts: pa.Array) -> pa.Array:
        rows = max(1, len(texts) * BATCH_BYTES // max(1, texts.nbytes))
        return pa.concat_arrays([part(texts.slice(i, rows)) for i in range(0, max(1, len(texts)), rows)])
    return ids(F.lower(text))


Tokenizer = Callable[[Column], Column]


def windows(tokens: Column, ctx: int, overlap: int) -> Column:
    """Start offsets of the token windows: one window when it fits, else
    windows of ``ctx`` every ``ctx - overlap`` tokens until the end is
    covered (closed form of the stop-once-end-reached loop)."""
    n = F.size(tokens)
    return F.sequence(F.lit(0), F.greatest(n - overlap - 1, F.lit(0)), F.lit(ctx - overlap))


def pad(tokens: Column, ctx: int, pad_id: int) -> Column:
    """Right-pad to ``ctx``."""
    return F.concat(tokens, F.array_repeat(F.lit(pad_id).cast("long"), F.lit(ctx) - F.size(tokens)))


def attention_mask(tokens, pad_id: int) -> Column:
    """0 where the token is padding, else 1."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.transform(t, lambda x: F.when(x == pad_id, 0).otherwise(1))


def split_pieces(docs: DataFrame, splitter: str, text_col: str = "text",
                 true_offsets: bool = False) -> DataFrame:
    """Pieces of each text split on ``splitter`` (empties skipped):
    ``doc_id, piece_no, piece, text_idx, text_len``.

    C2: ``text_idx`` is the first occurrence of the piece in the text (so
    repeated pieces share it), or with ``true_offsets`` its real position.
    """
    sep = "\\Q" + splitter.replace("\\E", "\\E\\\\E\\Q") + "\\E"   # a literal, not a pattern
    p = docs.select("doc_id", text_col,
                    F.posexplode(F.split(F.col(text_col), sep)).alias("piece_no", "piece"))
    if true_offsets:
        w = (Window.partitionBy("doc_id").orderBy("piece_no")
             .rowsBetween(Window.unboundedPreceding, -1))
        p = p.withColumn("text_idx", F.coalesce(F.sum(F.length("piece") + len(splitter)).over(w), F.lit(0)))
    else:
        p = p.withColumn("text_idx", F.instr(F.col(text_col), F.col("piece")) - 1)
    return (p.filter(F.col("piece") != "")
             .select("doc_id", F.col("piece_no").cast("long"), "piece",
                     F.col("text_idx").cast("long"), F.length("piece").cast("long").alias("text_len")))


def direct_split(docs: DataFrame, params: Params = DEFAULT, splitter: str = "\n\n",
                 tokenizer: Tokenizer = hash_tokenizer, text_col: str = "text",
                 true_offsets: bool = False) -> DataFrame:
    """``doc_id, piece_no, win_no, text_idx, text_len, n_tokens, tokens``."""
    ctx, ov = params.context_length, params.overlap
    pieces = split_pieces(docs, splitter, text_col, true_offsets)
    tok = pieces.withColumn("all_tokens", tokenizer(F.col("piece")))
    # the windows are cut before they become rows: a row holds its window, not its piece
    cut = F.transform(windows(F.col("all_tokens"), ctx, ov), lambda start: F.slice("all_tokens", start + 1, F.lit(ctx)))
    w = tok.select("doc_id", "piece_no", "text_idx", "text_len", F.posexplode(cut).alias("win_no", "chunk"))
    chunk = F.col("chunk")
    return w.select("doc_id", "piece_no", F.col("win_no").cast("long"), "text_idx", "text_len",
                    F.size(chunk).cast("long").alias("n_tokens"),
                    pad(chunk, ctx, params.pad_token_id).alias("tokens"))


def _number(name: str) -> Column:
    """A piece's number in its path: six digits at least, longer numbers whole."""
    n = F.col(name).cast("string")
    return F.lpad(n, F.greatest(F.lit(6), F.length(n)), F.lit("0"))


def recursive_split(docs: DataFrame, params: Params = DEFAULT,
                    tokenizer: Tokenizer = hash_tokenizer, text_col: str = "text") -> DataFrame:
    """C3 + C4 (+ C5 dispatch with ``recursive_split=True``).

    Level 1 splits on a blank line, level 2 splits the pieces that are still
    too long on line breaks; after that each too-long piece is halved by
    words (or by characters once one word is left) until it fits. A single
    character that a tokenizer plug-in still finds too long cannot be halved:
    its tokens go out as sliding windows, as in the direct split. Offsets
    are first occurrences within the parent piece plus the parent's offset.
    Output: ``doc_id, path, text_idx, text_len, n_tokens, tokens``.

    The loop ends by itself: halves of a piece of several words or characters
    are shorter than it.
    """
    ctx = params.context_length
    long_ = F.size("all_tokens") > ctx

    def tokenised(df):
        # a piece is tokenised once; its level is read by what fits and by the next level
        return df.withColumn("all_tokens", tokenizer(F.col("piece"))).persist(StorageLevel.MEMORY_AND_DISK)

    def split_level(df, sep):
        p = df.select("doc_id", "path", F.col("piece").alias("parent"), F.col("text_idx").alias("base"),
                      F.posexplode(F.split("piece", sep)).alias("i", "piece"))
        p = p.filter(F.col("piece") != "")
        return p.select("doc_id", F.concat("path", F.lit("."), _number("i")).alias("path"),
                        "piece", (F.col("base") + F.instr(F.col("parent"), F.col("piece")) - 1).cast("long").alias("text_idx"))

    start = docs.select("doc_id", F.lit("").alias("path"), F.col(text_col).alias("piece"),
                        F.lit(0).cast("long").alias("text_idx"))
    pieces = tokenised(split_level(start, "\n\n"))
    lines = tokenised(split_level(pieces.filter(long_), "\n"))
    out = [pieces.filter(~long_), lines.filter(~long_)]
    pending = lines.filter(long_)
    while True:
        pending = pending.checkpoint()
        if pending.isEmpty():
            break
        out.append(pending.filter(F.length("piece") == 1))
        words = F.split("piece", " ")
        chars = F.split("piece", "")
        by_words = F.size(words) > 1
        parts = F.when(by_words, words).otherwise(chars)
        h = F.floor(F.size(parts) / 2).cast("int")

        def halves(sep):
            return F.array(F.array_join(F.slice(parts, 1, h), sep),
                           F.array_join(F.slice(parts, h + 1, F.size(parts)), sep))
        hv = pending.filter(F.length("piece") > 1).select(
            "doc_id", "path", F.col("piece").alias("parent"), F.col("text_idx").alias("base"),
            F.posexplode(F.when(by_words, halves(" ")).otherwise(halves(""))).alias("i", "piece"))
        hv = tokenised(hv.filter(F.col("piece") != "").select(
            "doc_id", F.concat("path", F.lit("."), F.col("i").cast("string")).alias("path"), "piece",
            (F.col("base") + F.instr(F.col("parent"), F.col("piece")) - 1).cast("long").alias("text_idx")))
        out.append(hv.filter(~long_))
        pending = hv.filter(long_)
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    tok = res.select("doc_id", "path", "text_idx", F.length("piece").cast("long").alias("text_len"),
                     "all_tokens")
    # one window for every piece that fits; several only for the unsplittable ones
    w = tok.select("*", F.posexplode(F.when(F.size("all_tokens") <= ctx, F.array(F.lit(0))).otherwise(
        windows(F.col("all_tokens"), ctx, params.overlap))).alias("win", "at"))
    chunk = F.slice("all_tokens", F.col("at") + 1, F.lit(ctx))
    path = F.when(F.size("all_tokens") <= ctx, F.col("path")).otherwise(
        F.concat("path", F.lit(".w"), _number("win")))
    return w.select("doc_id", path.alias("path"), "text_idx", "text_len",
                    pad(chunk, ctx, params.pad_token_id).alias("tokens"), F.size(chunk).cast("long").alias("n_tokens"))
