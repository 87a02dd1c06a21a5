"""Storage helpers: fallbacks, resume, restart, checksums, streaming build."""

import uuid

from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sources import storage as ST


def fresh(spark, name):
    return scratch_path(spark, f"t-{name}-{uuid.uuid4().hex}")


def test_read_preferred_and_stats_fallback(spark):
    base = fresh(spark, "pref")
    spark.createDataFrame([(1, 2.0)], "a long, b double").write.json(base + ".json")
    assert ST.read_preferred(spark, base).count() == 1
    spark.createDataFrame([(7, 1.0), (8, 1.0)], "a long, b double").write.parquet(base + ".parquet")
    assert ST.read_preferred(spark, base).count() == 2
    r = ST.read_stats(spark, fresh(spark, "none"), corpus_size=3, avg_doc_len=1.5).first()
    assert (r.corpus_size, r.avg_doc_len) == (3, 1.5)


def test_incremental_restart_and_resume(spark):
    docs = spark.createDataFrame([(1, "a", "x y"), (2, "a", "y z"), (3, "b", "z")],
                                 "doc_id long, file string, text string")
    out, man = fresh(spark, "out"), fresh(spark, "man")

    def build(d):
        return d.select("file", "doc_id", F.explode(F.split("text", " ")).alias("word"))
    assert ST.incremental_terms(docs, out, man, build) == 2
    assert ST.incremental_terms(docs, out, man, build) == 0
    more = docs.unionByName(spark.createDataFrame([(4, "c", "q")], "doc_id long, file string, text string"))
    assert ST.incremental_terms(more, out, man, build) == 1
    assert spark.read.parquet(out).count() == 6
    assert ST.incremental_terms(more, out, man, build, restart=True) == 3
    assert spark.read.parquet(out).count() == 6
    vec = fresh(spark, "vec")
    entries = docs.select("file", F.col("doc_id").alias("entry_id"))
    assert ST.not_yet_done(entries, vec).count() == 3
    ST.save_vectors(entries, vec, mode="overwrite")
    assert ST.not_yet_done(entries, vec).count() == 0


def test_partition_replace_keeps_other_partitions(spark):
    path = fresh(spark, "parts")
    a = spark.createDataFrame([("f1", 1), ("f2", 2)], "file string, v long")
    ST.save_vectors(a, path, mode="overwrite")
    ST.save_vectors(spark.createDataFrame([("f2", 9)], "file string, v long"), path, mode="replace")
    got = sorted((r.file, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("f1", 1), ("f2", 9)]


def test_checksums_against_manifest(spark):
    import hashlib
    d = "/root/testdata/sf0.001"
    rows = ST.checksums(spark, d, glob="region.parquet").collect()
    assert len(rows) == 1
    assert rows[0].sha256 == hashlib.sha256(open(f"{d}/region.parquet", "rb").read()).hexdigest()
    bad = spark.createDataFrame([("region.parquet", "0" * 64)], "name string, sha256 string")
    assert ST.checksums(spark, d, glob="region.parquet", expected=bad).first().ok is False


def test_checksums_of_a_file_too_large_for_one_value(spark, tmp_path):
    """binaryFile gives a file as one value of 2 GB at most; the limit is set lower here."""
    import hashlib
    import random
    data = random.Random(1).randbytes(70 << 20)
    (tmp_path / "large.parquet").write_bytes(data)
    (tmp_path / "small.parquet").write_bytes(data[:1000])
    limit = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(64 << 20))
    try:
        expected = ST.checksums(spark, str(tmp_path)).select("name", "sha256")
        got = {r.name: r for r in ST.checksums(spark, str(tmp_path), expected=expected).collect()}
    finally:
        spark.conf.set(limit, before)
    assert {n: (r.length, r.sha256, r.ok) for n, r in got.items()} == {
        "large.parquet": (70 << 20, hashlib.sha256(data).hexdigest(), True),
        "small.parquet": (1000, hashlib.sha256(data[:1000]).hexdigest(), True)}


def test_checksums_by_splits_keep_every_byte(spark, tmp_path):
    import gzip
    import hashlib
    import random
    rnd, bom = random.Random(2), b"\xef\xbb\xbf"
    files = {
        "random": rnd.randbytes(50_001), "lines": b"a\n" * 9_000, "open end": b"a\r\nb\r" * 3_000, "newlines": b"\n" * 700,
        "newline": b"\n", "one line": b"x" * 40_000, "zeros": bytes(20_000) + b"\n" + bytes(20_000),
        "mark": bom, "mark and newline": bom + b"\n", "mark, open": bom + b"a\nb", "mark, closed": bom + b"a\nb\n",
        "marks": bom + bom, "inner mark": b"\n" + bom + b"\n", "odd [1]{a,b}*?%20 \u00e9": rnd.randbytes(9_000),
    }
    files = {f"{k}.bin": v for k, v in files.items()} | {"packed.bin.gz": gzip.compress(rnd.randbytes(5_000))}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    conf = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "512"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = ST.checksums(spark, str(tmp_path), glob="*", whole=0).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.name, r.length, r.sha256) for r in got) == sorted(
        (n, len(d), hashlib.sha256(d).hexdigest()) for n, d in files.items())


def test_digest_goes_on_from_its_state():
    import hashlib

    from quarry.functions.sha256 import Sha256
    data = bytes(range(256)) * 3
    for cut in (0, 1, 63, 64, 65, 700):
        assert Sha256(Sha256().update(data[:cut]).state()).update(data[cut:]).hexdigest() == hashlib.sha256(data).hexdigest()


def test_stream_build_exactly_once(spark):
    from quarry.streaming.incremental import stream_build
    src, out, ck = fresh(spark, "inbox"), fresh(spark, "sout"), fresh(spark, "ck")
    schema = "doc_id long, text string, file string"
    spark.createDataFrame([(1, "a b", "f1")], schema).write.partitionBy("file").parquet(src)

    def build(b):
        return b.select("file", "doc_id", F.explode(F.split("text", " ")).alias("word"))
    stream_build(spark, src, schema, out, ck, build)
    spark.createDataFrame([(2, "c", "f2")], schema).write.mode("append").partitionBy("file").parquet(src)
    stream_build(spark, src, schema, out, ck, build)
    stream_build(spark, src, schema, out, ck, build)
    assert sorted(r.word for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_stream_build_keeps_all_parts_of_a_source(spark):
    """A second part file of the same source, and one source over several micro-batches."""
    from quarry.streaming.incremental import stream_build
    src, out, ck = fresh(spark, "inbox2"), fresh(spark, "sout2"), fresh(spark, "ck2")
    schema = "doc_id long, text string, file string"
    spark.createDataFrame([(1, "a", "f1"), (2, "b", "f1")], schema).repartition(2, "doc_id").write.partitionBy("file").parquet(src)

    def build(b):
        return b.select("file", "doc_id", F.explode(F.split("text", " ")).alias("word"))
    stream_build(spark, src, schema, out, ck, build, max_files_per_trigger=1)
    spark.createDataFrame([(3, "c", "f1")], schema).write.mode("append").partitionBy("file").parquet(src)
    stream_build(spark, src, schema, out, ck, build, max_files_per_trigger=1)
    assert sorted(r.word for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_only_a_missing_path_counts_as_absent(spark):
    import pytest
    from pyspark.errors import AnalysisException
    path = fresh(spark, "other")
    spark.createDataFrame([(1,)], "x long").write.parquet(path)
    entries = spark.createDataFrame([("f", 1)], "file string, entry_id long")
    with pytest.raises(AnalysisException):
        ST.not_yet_done(entries, path).count()
