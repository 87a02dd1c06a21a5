"""Line dedup by range-partitioned line hashes, with keep bitmaps as the result.

Every line becomes a row (128-bit hash of its key, document, position) without
its text. The rows are range-partitioned by hash and by a salt made from the
document, and sorted within by document and position, so one pass over each
run streams the first line per document and the first per run; a hash that a
third of all documents carry is spread over ``salts`` runs. Runs are then
summed per hash (one row per run), which gives the documents that have the
line and its first place in the corpus.

The result is a bitmap per document, 64 lines to a word, with only those words
stored that have a dropped line; documents that keep every line have none.
Applying it to the text is a separate map step, and the text is not shuffled
while the bitmaps stay within the measured broadcast bound.

Rows sharing ``doc_id`` and text are one document. Defined cases: a null or
empty text is one empty line; keys shorter than ``min_key`` code points never
drop; a null ``doc_id`` is an id like any other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import ASCII_SPACE, BROADCAST_BYTES, ascii_lower, materialise, text_hash

MIN_KEY = 1
MIN_DOCS = 10
SALTS = 64


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def line_rows(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """``doc_id, h, pos, key``: the key's MD5 of every line with one long enough."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(text).alias("h"),
                       F.posexplode(split_lines(text)).alias("pos", "line"))
    rows = rows.select("doc_id", "h", "pos", line_key(F.col("line")).alias("k"))
    return rows.filter(F.char_length("k") >= min_key).select("doc_id", "h", "pos", F.unhex(F.md5("k")).alias("key"))


def line_runs(lines: DataFrame, salts: int = SALTS) -> DataFrame:
    """``key, n_docs, f_id, f_h, f_pos``: documents with the line and its first place."""
    salt = F.pmod(F.xxhash64("doc_id", "h"), F.lit(salts)).cast("int")
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.withColumn("salt", salt).repartitionByRange(n, "key", "salt")
    run = Window.partitionBy("key", "salt").orderBy("doc_id", "h", "pos")
    new = F.lag(F.struct("doc_id", "h")).over(run)
    seen = dealt.select("key", "salt", "doc_id", "h", "pos", new.alias("before"))
    firsts = seen.filter(F.col("before").isNull() | ~F.col("before").eqNullSafe(F.struct("doc_id", "h")))
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h", "pos")
    return firsts.groupBy("key").agg(F.count("*").alias("n_docs"), F.min(place).alias("f")).select(
        "key", "n_docs", F.col("f.doc_id").alias("f_id"), F.col("f.h").alias("f_h"), F.col("f.pos").alias("f_pos"))


def keep_bitmaps(docs: DataFrame, min_key: int = MIN_KEY, min_docs: int = MIN_DOCS,
                 keep_first: bool = False, salts: int = SALTS) -> DataFrame:
    """``b_id, b_h, n_dropped, bitmap``: for documents that lose lines.

    ``bitmap`` maps a word number to 64 keep bits (bit ``p`` of word ``w`` is
    line ``64 w + p``); absent words keep all their lines. With ``keep_first``
    the first place of a line in the corpus, by document and position, stays.
    """
    lines = materialise(line_rows(docs, min_key).distinct() if _repeats(docs) else line_rows(docs, min_key), "line-rows")
    runs = line_runs(lines, salts).filter(F.col("n_docs") >= min_docs).withColumnRenamed("key", "r_key")
    runs = materialise(runs, "line-runs")
    if runs.count() * 64 <= BROADCAST_BYTES:
        runs = F.broadcast(runs)
    gone = lines.join(runs, F.col("key") == F.col("r_key"))
    if keep_first:
        gone = gone.filter(~(F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("h") == F.col("f_h"))
                             & (F.col("pos") == F.col("f_pos"))))
    words = gone.groupBy("doc_id", "h", F.shiftright("pos", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits"), F.count("*").alias("c"))
    return words.groupBy(F.col("doc_id").alias("b_id"), F.col("h").alias("b_h")).agg(
        F.sum("c").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("w", F.bitwise_not("bits")))).alias("bitmap"))


def _repeats(docs: DataFrame) -> bool:
    text = F.col("text").cast("string")
    k = docs.select("doc_id", text_hash(text).alias("h")).groupBy("doc_id", "h").count().filter("count > 1")
    return not k.isEmpty()


def kept_lines(lines: Column, bitmap: Column) -> Column:
    """The lines whose keep bit is set; 64 lines share one look-up."""
    words = F.sequence(F.lit(0), F.shiftright(F.size(lines) - 1, 6))
    per = F.transform(words, lambda w: F.filter(
        F.transform(F.slice(lines, w * 64 + 1, F.lit(64)),
                    lambda x, i: F.struct(x.alias("x"), F.try_element_at(bitmap, w).alias("b"), i.alias("i"))),
        lambda s: s["b"].isNull() | (F.call_function("getbit", s["b"], s["i"]) == 1)))
    return F.transform(F.flatten(per), lambda s: s["x"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` (the text left) for every row of ``docs``."""
    bitmaps = materialise(bitmaps, "line-bitmaps")
    size = bitmaps.agg(F.count("*"), F.sum(F.size("bitmap"))).first()
    if 64 * size[0] + 16 * (size[1] or 0) <= BROADCAST_BYTES:
        bitmaps = F.broadcast(bitmaps)
    text = F.col("text").cast("string")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"),
                      text_hash(text).alias("h"))
    j = src.join(bitmaps, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("h") == F.col("b_h")), "left")
    lines = split_lines(F.col("text"))
    return j.select("doc_id", F.size(lines).cast("long").alias("n_lines"),
                    F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("bitmap").isNull(), F.col("text"))
                    .otherwise(F.array_join(kept_lines(lines, F.col("bitmap")), "\n")).alias("kept"))
