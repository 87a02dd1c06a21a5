"""Index walk, prefix ranges, range join, document store, map merge, question plug-in."""

import random

from pyspark.sql import functions as F

from quarry.operators import evaluate as EV
from quarry.operators import index as IX
from quarry.operators import terms as TM
from quarry.operators.terms import first_char_bucket
from quarry.sources import builds as B
from quarry.sources import docstore as DS
from quarry.sources import storage as ST


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def words(spark, ws):
    return spark.createDataFrame([(w,) for w in ws], "word string")


def plan(df):
    return df._jdf.queryExecution().toString()


def test_walk_stops_when_every_word_is_found(spark, tmp_path):
    post = spark.range(640).select((F.col("id") / 10).cast("long").alias("shard"),
                                   F.concat(F.lit("w"), (F.col("id") / 5).cast("long").cast("string")).alias("word"),
                                   F.col("id").alias("doc_int"))
    ST.write_shards(post, str(tmp_path / "s"))
    stored = B.read_build(spark, str(tmp_path / "s"))
    got, read = IX.sorted_walk(words(spark, ["w0", "w5", "w5"]), stored)
    assert read == 3 and sorted(r["doc_int"] for r in got.collect()) == [0, 1, 2, 3, 4, 25, 26, 27, 28, 29]
    got, read = IX.sorted_walk(words(spark, ["w127", "nowhere"]), stored)
    assert read == 64 and got.count() == 5
    got, read = IX.sorted_walk(words(spark, []), stored)
    assert read == 0 and got.count() == 0
    assert IX.sorted_walk(words(spark, ["a"]), stored.limit(0))[1] == 0


def test_prefix_ranges():
    rnd = random.Random(3)
    alphabet = "ab퟿\U0010FFFF"
    pool = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    for n, most in ((0, 4), (1, 4), (9, 100), (60, 100), (60, 3)):
        pre = pool[:n] + [""]
        got = IX.prefix_ranges(pre, most)
        assert len(got) <= most

        def inside(w):
            return any(w >= lo and (hi is None or w < hi) for lo, hi in got)

        for w in pool:
            if any(p and w.startswith(p) for p in pre):
                assert inside(w)
            elif most == 100:
                assert not inside(w)
    assert IX.next_prefix("az") == "a{" and IX.next_prefix("\U0010FFFF") is None and IX.next_prefix("a퟿") == "a"


def test_prefix_scan_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "p")
    IX.write_by_word(words(spark, [f"{a}{b}{i}" for a in "abcdef" for b in "xyz" for i in range(30)]), path)
    got = IX.prefix_scan(spark.read.parquet(path), ["ax", "fz1"])
    assert got.count() == 30 + 11
    text = plan(got)
    assert "GreaterThanOrEqual(word,ax)" in text and "LessThan(word,ay)" in text
    assert IX.prefix_scan(spark.read.parquet(path), [""]).count() == 0


def test_words_to_chunks_without_broadcast_of_the_chunks(spark):
    rnd = random.Random(8)
    voc = {"".join(rnd.choice("abz09é") for _ in range(rnd.randint(1, 5))) for _ in range(500)}
    chunks = IX.vocab_chunks(words(spark, voc).withColumn("num_docs", F.lit(1)), 7).checkpoint()
    asked = [(i, "".join(rnd.choice("abz09éq") for _ in range(rnd.randint(1, 5)))) for i in range(600)] + [(9, "a")] * 3
    q = spark.createDataFrame(asked, "query_id long, word string")
    table = chunks.collect()
    bucket = {r["word"]: r["b"] for r in q.select("word", first_char_bucket("word").alias("b")).distinct().collect()}
    want = sorted(((i, w, c["bucket"], c["chunk"]) for i, w in asked for c in table
                   if c["bucket"] == bucket[w] and c["lo"] <= w <= c["hi"]), key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = IX.words_to_chunks(q, chunks)
        assert rows(got.select("query_id", "word", "bucket", "chunk")) == want
        assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_document_store(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    data = [(f"f{i % 3}", i, f"text {i}") for i in range(500)] + [("f0", 3_000_000_000, "far"), (None, 7, "no file"), ("f1", 1, "again")]
    docs = spark.createDataFrame(data, "file string, entry_id long, text string")
    assert DS.build(docs, path, 8) and not DS.build(docs.limit(1), path, 8)
    keys = spark.createDataFrame([("f0", 3_000_000_000), ("f1", 1), ("f1", 1), ("f2", 1), (None, 7), ("f0", None), ("gone", 5)],
                                 "file string, entry_id long")
    want = [("f0", 3_000_000_000, "far"), ("f1", 1, "again"), ("f1", 1, "text 1")]
    found = DS.lookup(spark, path, keys)
    assert rows(found.select("file", "entry_id", "text")) == sorted(want, key=str)
    one = DS.lookup(spark, path, keys.limit(1))
    assert "PartitionFilters: [isnotnull(bucket" in plan(one) and "PushedFilters" in plan(one) and "entry_id" in plan(one)
    monkeypatch.setattr(DS, "PUSHED_KEYS", 0)
    monkeypatch.setattr(DS, "BROADCAST_KEYS", 0)
    assert rows(DS.lookup(spark, path, keys).select("file", "entry_id", "text")) == sorted(want, key=str)
    assert DS.lookup(spark, path, keys.limit(0)).count() == 0


def test_maps_merge_in_blocks(spark):
    data = [("f1", 1, "a", 2), ("f1", 9, "a", 1), ("f2", 3, "a", 5), ("f2", 3, "b", 1), (None, 4, "a", 7)]
    t = spark.createDataFrame(data, "file string, doc_id long, word string, tf long")
    got = rows(TM.merge_maps(TM.partial_maps(t, 5)))
    assert got == [("a", 0, 14, 3, [1, 3, 4], [2, 5, 7]), ("a", 1, 1, 1, [9], [1]), ("b", 0, 1, 1, [3], [1])]


def test_question_plugin(spark):
    df = spark.createDataFrame([(1, "One. Two."), (2, None), (3, "")], "id long, paragraph string")
    assert rows(EV.generate_questions(df).select("id", "query")) == [(1, "One."), (2, None), (3, "")]

    def build():
        return lambda texts: [f"what is {len(t)}?" for t in texts]

    assert rows(EV.generate_questions(df, build=build).select("id", "query")) == [(1, "what is 9?"), (2, None), (3, "what is 0?")]
    assert EV.generate_questions(df.limit(0), build=build).count() == 0


def test_prefix_scan_holds_rows_against_few_ranges(spark, tmp_path):
    path = str(tmp_path / "p")
    pool = [f"{a}{b}{c}" for a in "bdfhj" for b in "aceg" for c in "acegik"]
    IX.write_by_word(words(spark, pool), path)
    got = IX.prefix_scan(spark.read.parquet(path), pool)
    assert sorted(r["word"] for r in got.collect()) == sorted(pool)
    assert got._jdf.queryExecution().optimizedPlan().toString().count(">=") <= 16


def test_prefix_lookup_counts_a_document_once(spark, tmp_path):
    from quarry.plans.q_index import i8_prefix_lookup
    docs = [(1, "apple applet"), (1, "apple"), (2, "apply apple"), (None, "apple"), (3, "banana")]
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("source", F.lit("s")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "appl ban applet"), (8, "appl zz")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = rows(i8_prefix_lookup(spark, str(tmp_path)))
    assert got == [(7, "appl", 3, 2), (7, "applet", 1, 1), (7, "ban", 1, 1), (8, "appl", 3, 2)]
