"""Builds are read only when whole: killed, truncated and finished runs."""

import pytest
from pyspark.sql import functions as F

from quarry.sources import builds as B
from quarry.sources import storage as ST


def postings(spark, n):
    return spark.range(n).select((F.col("id") % 3).cast("int").alias("shard"), F.concat(F.lit("w"), "id").alias("word"),
                                 F.col("id").alias("doc_int"))


def keys(df):
    return sorted(tuple(r) for r in df.select("shard", "word", "doc_int").collect())


def test_a_killed_run_is_not_read(spark, tmp_path):
    path, want = str(tmp_path / "shards"), postings(spark, 20)
    assert not B.is_complete(spark, path)
    B.write_part(want.filter("shard = 0"), path, "shard")   # killed before it was listed
    assert not B.is_complete(spark, path)
    with pytest.raises(ValueError):
        B.read_build(spark, path)
    assert ST.write_shards(want, path) and keys(B.read_build(spark, path)) == keys(want)
    assert not ST.write_shards(want.limit(1), path) and keys(B.read_build(spark, path)) == keys(want)
    assert ST.write_shards(want.limit(5), path, overwrite=True) and len(keys(B.read_build(spark, path))) == 5


def test_a_listed_part_that_lost_rows_is_rebuilt(spark, tmp_path):
    path, want = str(tmp_path / "shards"), postings(spark, 20)
    part = B.write_part(want.limit(7), path, "shard")
    B.list_part(spark, path, spark.createDataFrame([(part, None, 20)], B.MANIFEST))
    assert not B.is_complete(spark, path)
    assert ST.write_shards(want, path) and keys(B.read_build(spark, path)) == keys(want)


def test_an_empty_build_is_complete(spark, tmp_path):
    path = str(tmp_path / "none")
    assert ST.write_shards(postings(spark, 0), path) and B.is_complete(spark, path)
    assert not ST.write_shards(postings(spark, 3), path)


def test_files_are_resumed(spark, tmp_path):
    path = str(tmp_path / "files")
    docs = spark.createDataFrame([("a", 1), ("a", 2), ("01", 3), (None, 4), ("empty", 5)], "file string, v long")
    seen = []

    def build(d):
        seen.append(sorted(str(r["file"]) for r in d.select("file").distinct().collect()))
        return d.filter("v <> 5").withColumn("twice", F.col("v") * 2)

    assert B.resume_files(docs.filter("file = 'a'"), path, build) == 1
    B.write_part(build(docs.filter("file = '01'")), path)
    part = B.write_part(build(docs.filter("file is null")).limit(0), path)
    B.list_part(spark, path, spark.createDataFrame([(part, None, 1)], B.MANIFEST))
    seen.clear()
    assert B.resume_files(docs, path, build) == 3 and seen == [["01", "None", "empty"]]
    assert B.resume_files(docs, path, build) == 0
    got = sorted((str(r["file"]), r["twice"]) for r in B.read_files(spark, path).collect())
    assert got == [("01", 6), ("None", 8), ("a", 2), ("a", 4)]


def test_appended_parts(spark, tmp_path):
    path = str(tmp_path / "parts")
    assert B.append_part(postings(spark, 4), path) == 4 and B.append_part(postings(spark, 0), path) == 0
    B.write_part(postings(spark, 9), path)
    assert B.append_part(postings(spark, 2), path) == 2 and B.read_build(spark, path).count() == 6
