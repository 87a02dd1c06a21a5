"""Registered storage, incremental-build and streaming queries
(S2, S6-S11, S14, N1-N4). Each writes under a fresh folder below the
session's checkpoint directory and returns what it reads back."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.operators import chunk as C
from quarry.operators import dense as D
from quarry.operators import index as IX
from quarry.operators import terms as TM
from quarry.operators.rerank import embed_chunks
from quarry.plans.catalog import REGISTRY, register
from quarry.plans.q_dense import CHUNK_VECTORS_SQL
from quarry.session import scratch_path
from quarry.sources import builds as B
from quarry.sources import storage as ST
from quarry.sources import tables
from quarry.streaming.incremental import stream_build

P = DEFAULT


def _fresh(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _docs(spark, sf_dir):
    return tables.documents(spark, sf_dir)


def _terms_of(docs):
    """Per-document term rows (with ``file``) of a document batch."""
    return TM.SparseIndex(docs, "basic", P).terms.join(docs.select("doc_id", "file"), "doc_id") \
             .select("file", "doc_id", "word", "tf")


def _sql(name):
    return REGISTRY[name].sql


@register("s6_parquet_roundtrip", _sql("a1_term_frequency"))
def s6_parquet_roundtrip(spark, sf_dir):
    path = _fresh(spark, "terms")
    t = TM.SparseIndex(_docs(spark, sf_dir), "basic", P).terms.select("doc_id", "word", "tf")
    ST.write_parquet(t, path, sort_within=["word"])
    return spark.read.parquet(path)


@register("s7_json_map_roundtrip", _sql("a1_term_frequency"))
def s7_json_map_roundtrip(spark, sf_dir):
    path = _fresh(spark, "termmaps")
    ST.write_term_maps_json(TM.SparseIndex(_docs(spark, sf_dir), "basic", P).terms, path)
    return ST.read_term_maps_json(spark, path)


@register("s10_stats_roundtrip", _sql("a5_corpus_stats"))
def s10_stats_roundtrip(spark, sf_dir):
    path = _fresh(spark, "stats")
    ST.write_stats(TM.corpus_stats(TM.doc_lengths(_docs(spark, sf_dir).select("doc_id", "text"))), path)
    s = ST.read_stats(spark, path, corpus_size=274669, avg_doc_len=389.3195)
    return s.select("corpus_size", F.round("avg_doc_len", 6).alias("avg_doc_len"))


@register("s8_format_preference", _sql("a5_corpus_stats"))
def s8_format_preference(spark, sf_dir):
    """Only the JSON copy exists, so the reader falls back to it."""
    base = _fresh(spark, "stats")
    ST.write_stats(TM.corpus_stats(TM.doc_lengths(_docs(spark, sf_dir).select("doc_id", "text"))), base + ".json")
    s = ST.read_preferred(spark, base, json_schema=None)
    return s.select(F.col("corpus_size").cast("long"), F.round("avg_doc_len", 6).alias("avg_doc_len"))


def _postings(spark, sf_dir):
    from quarry.plans.q_index import SHARD_CAP
    idx = TM.SparseIndex(_docs(spark, sf_dir), "basic", P)
    ids = IX.doc_ids(tables.documents(spark, sf_dir, with_text=False))
    return IX.sharded_postings(IX.postings_rows(idx.terms, ids), IX.shard_by_df(idx.df, SHARD_CAP))


def _shards(spark, path):
    return B.read_build(spark, path).select(F.col("shard").cast("long"), "word", "doc_int")


@register("s11_shard_sink", _sql("i1_sharded_postings"))
def s11_shard_sink(spark, sf_dir):
    path = _fresh(spark, "shards")
    ST.write_shards(_postings(spark, sf_dir), path)
    return _shards(spark, path)


@register("n3_skip_existing", _sql("i1_sharded_postings"))
def n3_skip_existing(spark, sf_dir):
    """A run that was killed after half of its shards has listed nothing: the
    next run builds again, and the one after it finds a complete output."""
    post, path = _postings(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK), _fresh(spark, "shards")
    B.write_part(post.filter(F.col("shard") % 2 == 0), path, "shard", ST.sorted_runs)
    wrote = [ST.write_shards(post, path), ST.write_shards(post.limit(0), path)]
    assert wrote == [True, False], "an unlisted output must be rebuilt, a complete one kept"
    return _shards(spark, path)


FILE_VECTORS_SQL = CHUNK_VECTORS_SQL.rsplit("SELECT", 1)[0] + """
SELECT v.doc_id, v.piece_no, v.win_no, v.vector, d.source AS file FROM vecs v JOIN documents d USING (doc_id)"""


def _file_vectors(docs):
    vec = embed_chunks(docs.select("doc_id", "text"), P, lambda: D.hashing_fn(P.dims, P.pad_token_id),
                       tokenizer=C.batch_hash_tokenizer)
    return vec.join(docs.select("doc_id", "file", "entry_id"), "doc_id") \
        .select("file", "entry_id", "doc_id", "piece_no", "win_no", "vector")


@register("s9_vector_table", FILE_VECTORS_SQL)
def s9_vector_table(spark, sf_dir):
    """Create the vector table, then replace every file's partition again
    (dynamic overwrite): the result holds each chunk's vector once."""
    vec = _file_vectors(_docs(spark, sf_dir)).persist(StorageLevel.MEMORY_AND_DISK)
    path = _fresh(spark, "vectors")
    ST.save_vectors(vec, path, mode="overwrite")
    ST.save_vectors(vec, path, mode="replace")
    vec.unpersist()
    return spark.read.parquet(path).select("doc_id", "piece_no", "win_no", "vector", "file")


@register("n2_partition_overwrite", FILE_VECTORS_SQL)
def n2_partition_overwrite(spark, sf_dir):
    """Vectors per file, over a run that finished some files, a killed run that
    listed nothing, and a listed part that has lost rows: a resumed run builds
    the files that are not whole, and a further one finds nothing to do."""
    docs, path = _docs(spark, sf_dir), _fresh(spark, "vectors")
    third = F.pmod(F.crc32(F.col("file").cast("binary")), F.lit(3))
    B.resume_files(docs.filter(third == 0), path, _file_vectors)
    B.write_part(_file_vectors(docs.filter(third == 1)), path)
    lost = _file_vectors(docs.filter(third == 2))
    part = B.write_part(lost.filter("win_no = 0"), path)
    B.list_part(spark, path, lost.groupBy("file").agg(F.count("*").alias("rows")).select(F.lit(part).alias("part"), "file", "rows"))
    B.resume_files(docs, path, _file_vectors)
    assert B.resume_files(docs, path, _file_vectors) == 0, "a whole build must be left alone"
    return B.read_files(spark, path).select("doc_id", "piece_no", "win_no", "vector", "file")


@register("n4_resume_vectors", FILE_VECTORS_SQL)
def n4_resume_vectors(spark, sf_dir):
    """A run that embedded the entries of some files only is resumed: the next
    one embeds the entries that are not in the table, and a third finds none."""
    docs = _docs(spark, sf_dir)
    path = _fresh(spark, "vectors")
    some = docs.filter(F.crc32(F.col("file").cast("binary")) % 2 == 0)
    for part in (some, docs, docs):
        ST.save_vectors(_file_vectors(ST.not_yet_done(part, path)), path, mode="append")
    return spark.read.parquet(path).select("doc_id", "piece_no", "win_no", "vector", "file")


@register("n1_incremental_build", _sql("a1_term_frequency"))
def n1_incremental_build(spark, sf_dir):
    """Build per file with a manifest; the second call processes no file."""
    out, man = _fresh(spark, "terms"), _fresh(spark, "manifest")
    docs = _docs(spark, sf_dir)
    ST.incremental_terms(docs, out, man, _terms_of)
    n2 = ST.incremental_terms(docs, out, man, _terms_of)
    assert n2 == 0, "a rerun must add nothing"
    return spark.read.parquet(out).select("doc_id", "word", "tf")


@register("n1_stream_build", _sql("a1_term_frequency"))
def n1_stream_build(spark, sf_dir):
    """Document files land in a folder; a streaming job (availableNow) turns
    every unseen file into term rows."""
    src, out, ck = _fresh(spark, "inbox"), _fresh(spark, "terms"), _fresh(spark, "stream-ckpt")
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("file"), "text")
    docs.repartition("file").write.partitionBy("file").parquet(src)
    stream_build(spark, src, "doc_id long, text string, file string", out, ck, _terms_of)
    stream_build(spark, src, "doc_id long, text string, file string", out, ck, _terms_of)  # nothing new
    return spark.read.parquet(out).select("doc_id", "word", "tf")


@register("s2_file_listing")
def s2_file_listing(spark, sf_dir):
    return ST.list_files(spark, sf_dir).select("name", "length")


@register("s14_checksums")
def s14_checksums(spark, sf_dir):
    """Checksums compared against a manifest taken from a second read."""
    expected = ST.checksums(spark, sf_dir).select("name", "sha256")
    return ST.checksums(spark, sf_dir, expected=expected)
