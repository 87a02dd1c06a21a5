"""Inverted index.

Layout: postings stay rows ``(shard, word, doc_int)`` or, when a packed form
is wanted, bounded blocks ``(shard, word, block, docs array)`` where a block
holds the ids of one fixed id range (``doc_int div block_size``). A word of a
third of the corpus therefore never becomes one array or one group.

Global orders (dense ids, cumulative df) use a two-level prefix sum: a range
partitioned sort, per-partition counts/sums (one small row per partition),
offsets from those, then a per-partition running value — never a
single-partition window over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.terms import first_char_bucket

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row position


def _ordered(df: DataFrame, order: list[Column]) -> DataFrame:
    n = df.sparkSession.sparkContext.defaultParallelism
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n)
    s = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    mono = F.monotonically_increasing_id()
    s = s.withColumn("_pid", F.shiftright(mono, _POS_BITS)) \
         .withColumn("_pos", mono - F.shiftleft(F.shiftright(mono, _POS_BITS), _POS_BITS))
    # The partition boundaries come from sampling rows whose order inside a
    # partition is not fixed, so two evaluations (or a recomputation after a
    # lost executor) could cut differently. Positions and per-partition counts
    # must come from the same rows: materialise once in the checkpoint folder.
    return s.checkpoint(eager=True)


def sequential_ids(df: DataFrame, order: list[Column], name: str = "seq") -> DataFrame:
    """Dense 1-based position of each row in ``order`` (W7 / zipWithIndex)."""
    s = _ordered(df, order)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a window over it is tiny
    offs = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (s.join(F.broadcast(offs), "_pid")
             .withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("long"))
             .drop("_pid", "_pos", "_off"))


def running_sum(df: DataFrame, value: str, order: list[Column], name: str = "cum") -> DataFrame:
    """Inclusive prefix sum of ``value`` in ``order`` (two-level)."""
    s = _ordered(df, order)
    sums = s.groupBy("_pid").agg(F.sum(value).alias("_s"))
    offs = sums.select("_pid", (F.sum("_s").over(Window.orderBy("_pid")) - F.col("_s")).alias("_off"))
    within = F.sum(value).over(Window.partitionBy("_pid").orderBy("_pos")
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (s.withColumn("_in", within)
             .join(F.broadcast(offs), "_pid")
             .withColumn(name, (F.col("_off") + F.col("_in")).cast("long"))
             .drop("_pid", "_pos", "_off", "_in"))


# ---- W4 / W7 -------------------------------------------------------------------

def doc_ids(docs: DataFrame) -> DataFrame:
    """``doc_id, file, doc_int`` dense 1-based in (file, doc_id) order."""
    return sequential_ids(docs.select("doc_id", "file"), [F.col("file"), F.col("doc_id")], "doc_int")


def vocabulary_by_df(dfs: DataFrame) -> DataFrame:
    """``word, num_docs, df_rank`` (df descending, then word)."""
    return sequential_ids(dfs, [F.desc("num_docs"), F.asc("word")], "df_rank")


# ---- W5 / W6 -------------------------------------------------------------------

def shard_by_df(dfs: DataFrame, cap: int) -> DataFrame:
    """``word, num_docs, shard``; the vocabulary by df (descending, then word)
    is cut before the word that would take the shard's df sum over ``cap``; a
    word above the cap has a shard of its own.

    Words of one df behave alike, so the cut follows from the df histogram: in
    a run of equal df the open shard takes ``room`` words and every further
    shard ``each``. The running pass goes over the distinct dfs only (their
    number grows with the square root of the postings); the words themselves
    are ranked by the distributed sort and pick up their run's numbers."""
    runs = dfs.groupBy("num_docs").agg(F.count(F.lit(1)).alias("n"))

    def cut(batches):
        import pandas as pd
        shard, total, rank = 0, 0, 0
        for b in batches:
            rows = []
            for d, n in zip(b["num_docs"].tolist(), b["n"].tolist()):
                room = max(0, (cap - total) // d)
                if total == 0:
                    room = max(1, room)
                each = max(1, cap // d)
                rows.append((d, rank, shard, room, each))
                if n <= room:
                    total += n * d
                else:
                    more = -(-(n - room) // each)
                    shard, total = shard + more, (n - room - (more - 1) * each) * d
                rank += n
            yield pd.DataFrame(rows, columns=["run_df", "run_rank", "run_shard", "room", "each"])

    # one ordered pass over the histogram
    cuts = runs.repartition(1).sortWithinPartitions(F.desc("num_docs")).mapInPandas(
        cut, "run_df long, run_rank long, run_shard long, room long, each long")
    words = vocabulary_by_df(dfs).join(cuts, F.col("num_docs") == F.col("run_df"))
    nth = F.col("df_rank") - 1 - F.col("run_rank")
    return words.select("word", "num_docs", F.when(nth < F.col("room"), F.col("run_shard")).otherwise(
        F.col("run_shard") + 1 + F.floor((nth - F.col("room")) / F.col("each"))).cast("long").alias("shard"))


def vocab_chunks(dfs: DataFrame, words_per_chunk: int, digits: bool = True) -> DataFrame:
    """Per first-character bucket, the sorted vocabulary cut into chunks of
    ``words_per_chunk`` words: ``bucket, chunk, lo, hi, n_words``."""
    b = dfs.select("word", first_char_bucket("word", digits).alias("bucket"))
    seq = sequential_ids(b, [F.col("bucket"), F.col("word")], "seq")
    start = seq.groupBy("bucket").agg(F.min("seq").alias("first"))
    ranked = seq.join(F.broadcast(start), "bucket").withColumn("rn", F.col("seq") - F.col("first") + 1)
    return (ranked.withColumn("chunk", F.floor((F.col("rn") - 1) / words_per_chunk).cast("long"))
                  .groupBy("bucket", "chunk")
                  .agg(F.min("word").alias("lo"), F.max("word").alias("hi"),
                       F.count(F.lit(1)).alias("n_words")))


# ---- postings ------------------------------------------------------------------

def postings_rows(terms: DataFrame, ids: DataFrame) -> DataFrame:
    """J3 + A9 (row form): ``word, doc_int`` for every (doc, word)."""
    # the postings pass by the ids of their documents, unsorted
    return terms.select("doc_id", "word").join(ids.select("doc_id", "doc_int").hint("shuffle_hash"), "doc_id") \
                .select("word", "doc_int")


def postings_blocks(rows: DataFrame, block_size: int = 65536) -> DataFrame:
    """A9 (packed form): ``word, block, docs`` with sorted ids of one id range;
    each array holds at most ``block_size`` ids."""
    return (rows.withColumn("block", F.floor(F.col("doc_int") / block_size).cast("long"))
                .groupBy("word", "block")
                .agg(F.sort_array(F.collect_list("doc_int")).alias("docs"),
                     F.count(F.lit(1)).alias("n")))


def sharded_postings(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """``shard, word, doc_int``."""
    return rows.join(shards.select("word", "shard").hint("shuffle_hash"), "word").select("shard", "word", "doc_int")


def decode(doc_ints: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_int`` -> ``doc_id, file``."""
    return doc_ints.join(ids, "doc_int")


# ---- queries against the index -------------------------------------------------

def or_candidates(qwords: DataFrame, post: DataFrame) -> DataFrame:
    """``query_id, doc_int`` with any query word (union, distinct)."""
    return qwords.select("query_id", "word").join(post.select("word", "doc_int"), "word") \
                 .select("query_id", "doc_int").distinct()


def words_to_chunks(qwords: DataFrame, chunks: DataFrame, digits: bool = True) -> DataFrame:
    """Each query word to the vocabulary chunk (D13 shard map, from
    ``vocab_chunks``) whose ``lo <= word <= hi`` within the word's bucket.

    A point-in-range join as a merge in order: cut points and distinct words are
    sorted together over the partitions, a word takes the last cut point before
    it (from its own partition, or the last one of the partitions before), and
    the upper end is a filter. Neither side is broadcast and no bucket meets in
    one task; the found chunks are joined to the rows by word.
    """
    cuts = chunks.select("bucket", F.col("lo").alias("word"), F.lit(0).alias("_kind"), "chunk", "hi")
    words = qwords.select("word").distinct().select(
        first_char_bucket("word", digits).alias("bucket"), "word", F.lit(1).alias("_kind"),
        F.lit(None).cast(chunks.schema["chunk"].dataType).alias("chunk"), F.lit(None).cast("string").alias("hi"))
    s = _ordered(cuts.unionByName(words), [F.col("bucket"), F.col("word"), F.col("_kind")])
    cut = F.when(F.col("_kind") == 0, F.struct(F.col("bucket").alias("b"), "chunk", "hi"))
    upto = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = s.groupBy("_pid").agg(F.max(F.when(F.col("_kind") == 0, F.struct("_pos", cut.alias("cut"))))["cut"].alias("end"))
    # one row per partition: a window over it is tiny
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_pid", F.last("end", ignorenulls=True).over(before).alias("carried"))
    at = s.withColumn("last", F.last(cut, ignorenulls=True).over(upto)).join(F.broadcast(carried), "_pid") \
          .filter("_kind = 1").select("word", "bucket", F.coalesce("last", "carried").alias("at"))
    found = at.filter((F.col("at.b") == F.col("bucket")) & (F.col("word") <= F.col("at.hi")))
    return qwords.join(found.select("word", "bucket", "at.chunk"), "word")


# ---- reading stored postings ------------------------------------------------------

def sorted_walk(words: DataFrame, postings: DataFrame, first: int = 1) -> tuple[DataFrame, int]:
    """``shard, word, doc_int`` of ``words(word)`` from stored shards in df
    order, and how many shards were read.

    Shards are read in rounds (``first`` of them, then twice as many each time);
    the words a round finds leave by an anti join, as a word lies in one shard,
    and the walk stops when none is left.
    """
    left = words.select("word").distinct().checkpoint()
    top = postings.agg(F.max("shard")).first()[0]
    out, lo, step = postings.limit(0).select("shard", "word", "doc_int"), 0, first
    while top is not None and lo <= top and not left.isEmpty():
        here = postings.filter(F.col("shard").between(lo, lo + step - 1))
        hit = here.join(left, "word", "left_semi").select("shard", "word", "doc_int").checkpoint()
        out, left = out.unionByName(hit), left.join(hit.select("word").distinct(), "word", "left_anti").checkpoint()
        lo, step = lo + step, 2 * step
    return out, 0 if top is None else min(lo, top + 1)


def write_by_word(rows: DataFrame, path: str) -> None:
    """Postings laid out by ranges of words, sorted within files, so that scans of
    word ranges skip files and row groups by their statistics."""
    rows.repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(path)


def next_prefix(prefix: str) -> str | None:
    """The smallest string above all that begin with ``prefix``; None if there is none."""
    while prefix:
        code = ord(prefix[-1]) + 1
        code = 0xE000 if code == 0xD800 else code
        if code <= 0x10FFFF:
            return prefix[:-1] + chr(code)
        prefix = prefix[:-1]
    return None


def prefix_ranges(prefixes: list[str], most: int = 256) -> list[tuple[str, str | None]]:
    """Disjoint ranges that hold every word with one of the prefixes: longer prefixes
    merge into the shorter ones they begin with, and neighbours merge until at
    most ``most`` ranges are left (which then hold other words too)."""
    out: list[tuple[str, str | None]] = []
    for p in sorted({p for p in prefixes if p}):
        if not (out and p.startswith(out[-1][0])):
            out.append((p, next_prefix(p)))
    size = -(-len(out) // most) if out else 1
    return [(group[0][0], group[-1][1]) for group in (out[i:i + size] for i in range(0, len(out), size))]


def prefix_scan(stored: DataFrame, prefixes: list[str], most: int = 16) -> DataFrame:
    """I8: rows of ``stored`` whose word lies in a range of the (bounded) prefixes,
    as filters that reach the file scan. Every row that is read is held against
    the ranges, so there are few; the exact match is a join (``prefix_matches``)."""
    cond = F.lit(False)
    for lo, hi in prefix_ranges(prefixes, most):
        one = F.col("word") >= lo
        cond = cond | (one if hi is None else one & (F.col("word") < hi))
    return stored.filter(cond)
