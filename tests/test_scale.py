"""Sums, merges and splits that stay in small tasks and move their rows once."""

import pytest
from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.functions import tokenizer as WT
from quarry.operators import chunk as C
from quarry.operators import index as IX
from quarry.operators import search as S
from quarry.operators import stored
from quarry.operators import terms as TM
from quarry.sources import builds as B


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    """The rows, and the plan as it ran (a cached frame's partitions are known only then)."""
    rows = df.collect()
    text = executed(df)
    assert "== Final Plan ==" in text
    return rows, text.split("== Initial Plan ==")[0]


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["i5_weighted_doc_idf", "i6_word_idf_filter", "a11_idf_mass"])
def test_sums_over_query_and_document_are_not_shuffled(spark, tmp_path, no_auto_broadcast, name):
    from quarry.plans.catalog import load_all
    docs = [(i, f"word{i % 3} common tail{i}") for i in range(9)]
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("source", F.lit("s")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "word1 common"), (8, "tail4")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got, ran = final(load_all()[name].build(spark, str(tmp_path)))
    assert "hashpartitioning(query_id" not in ran
    if name == "a11_idf_mass":
        assert {(r["query_id"], r["doc_id"]) for r in got} == {(7, i) for i in range(9)} | {(8, 4)}


def test_candidates_meet_the_scores_by_document(spark, no_auto_broadcast):
    docs = spark.createDataFrame([(i, "red green") for i in range(6)], "doc_id long, text string")
    q = spark.createDataFrame([(1, "red"), (2, "green")], "query_id long, query string")
    cand = spark.createDataFrame([(1, 0), (1, 0), (1, 3), (2, 4), (2, 99), (None, 5)], "query_id long, doc_id long")
    got, ran = final(S.bm25_scores(q, TM.SparseIndex(docs, "basic", DEFAULT), DEFAULT.with_(broadcast_max_rows=3), candidates=cand))
    assert "hashpartitioning(query_id" not in ran
    assert sorted((r["query_id"], r["doc_id"]) for r in got) == [(1, 0), (1, 3), (2, 4)]


def test_merge_across_files_finds_its_lists_in_place(spark):
    t = spark.createDataFrame([("f1", 1, "a", 2), ("f2", 3, "a", 5)], "file string, doc_id long, word string, tf long")
    assert executed(TM.merge_maps(TM.partial_maps(t, 5))).count("Exchange hashpartitioning") == 1


def test_stored_postings_are_dealt_to_tasks_of_few_documents(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"red w{i}") for i in range(20)], "doc_id long, text string")
    stored.build(TM.SparseIndex(docs, "basic", DEFAULT), str(tmp_path), n_shards=2)
    idx = stored.StoredIndex(spark, str(tmp_path), DEFAULT)
    monkeypatch.setattr(S, "DOCS_PER_TASK", 1)
    post = S._by_doc(idx, idx.terms)
    assert post.rdd.getNumPartitions() == 20 and post.count() == 40


def test_recursive_split_tokenises_a_piece_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def toks(text):
        calls.add(1)
        return list(range(1, len(text.split()) + 1))

    text = "\n".join(" ".join(f"x{i}_{j}" for j in range(200)) for i in range(2)) + "\n\nshort"
    out = C.recursive_split(spark.createDataFrame([(1, text)], "doc_id long, text string"), DEFAULT,
                            tokenizer=F.udf(toks, "array<bigint>")).collect()
    assert sorted(r["path"] for r in out) == [f".000000.00000{i}.{h}" for i in (0, 1) for h in (0, 1)] + [".000001"]
    assert calls.value == 2 + 2 + 4   # paragraphs, lines, halves


@pytest.mark.parametrize("k, digits", [(2, 6), (50, None)])
def test_large_batch_is_scored_block_by_block(spark, monkeypatch, k, digits):
    """Same rows as the join: ties, words of all documents, repeated and null ids, documents without a word."""
    rows = [(i, f"every tone{i % 7} rare{i} " + "deep " * (i % 3)) for i in range(400)]
    rows += [(5, "tone1 every again"), (None, "tone2 tone3"), (1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    q = spark.createDataFrame([(1, "tone1 deep"), (2, "every"), (3, "rare17 tone3 deep every"), (4, "absent"), (4, "tone5 every"),
                               (4, "tone5"), (None, "rare9 tone2")], "query_id long, query string")
    p = DEFAULT.with_(top_k=k)

    def search():
        return sorted(map(repr, [(r[0], r[1], r[2], round(r[3], 9)) for r in S.search_bm25(q, TM.SparseIndex(docs), p, score_digits=digits).collect()]))

    joined = search()
    monkeypatch.setattr(S, "BATCH_TERMS", 0)
    whole = search()
    monkeypatch.setattr(S, "SLICE_TERMS", 4)
    monkeypatch.setattr(S, "BLOCK_POSTINGS", 300)
    assert joined == whole == search() and len(joined) > 2 * k
    assert "FlatMapCoGroupsInArrow" in executed(S.search_bm25(q, TM.SparseIndex(docs), p))   # no row per (query, document)


def test_large_batch_is_scored_in_rounds(spark, monkeypatch):
    """Same rows in rounds of one slice; only the last is left to the caller, whatever a slice's words or results are."""
    rows = [(i, f"every tone{i % 7} rare{i} " + "deep " * (i % 3)) for i in range(60)]
    rows += [(5, "tone1 every again"), (5, "tone1 every again"), (None, "tone2 tone3"), (1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    q = spark.createDataFrame([(i, f"tone{i} rare{3 * i} every absent") for i in range(6)] + [(None, "deep"), (7, "")],
                              "query_id long, query string")
    p = DEFAULT.with_(top_k=4)

    def search(params=p):
        return S.search_bm25(q, TM.SparseIndex(docs, "basic", params), params)

    want = sorted(map(repr, search().collect()))
    for name, value in (("BATCH_TERMS", 0), ("SLICE_TERMS", 10), ("BLOCK_POSTINGS", 60), ("ROUND_POSTINGS", 1)):
        monkeypatch.setattr(S, name, value)
    kept, store = [], S._stored
    monkeypatch.setattr(S, "_stored", lambda df, name: kept.append(name) or store(df, name))
    got = search()
    assert kept.count("bm25-best") >= 1 and kept.count("bm25-documents") == 1
    assert sorted(map(repr, got.collect())) == want
    monkeypatch.setattr(S, "SLICE_TERMS", 1000)
    monkeypatch.setattr(S, "SLICE_RESULTS", 10)
    kept.clear()
    assert sorted(map(repr, search(p.with_(broadcast_max_rows=2)).collect())) == want   # words joined by shuffle
    assert kept.count("bm25-best") >= 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_full_profile_stays_in_tasks_of_few_documents(spark, monkeypatch, no_auto_broadcast):
    monkeypatch.setattr(TM, "DOCS_PER_TASK", 1)
    docs = spark.createDataFrame([(i, f"running tones{i} every every") for i in range(12)], "doc_id long, text string")
    idx = TM.SparseIndex(docs, "full")
    got, ran = final(idx.terms)
    assert idx._counted.rdd.getNumPartitions() == 12 and "SortMergeJoin [doc_id" not in ran and "ShuffledHashJoin [token" in ran
    assert sorted((r["doc_id"], r["word"], r["tf"], r["doc_len"]) for r in got if r["doc_id"] == 3) == [
        (3, "everi", 2, 4), (3, "run", 1, 4), (3, "tones3", 1, 4)]


def test_postings_pass_by_ids_and_shards_unsorted(spark, no_auto_broadcast):
    terms = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, "a")], "doc_id long, word string")
    ids = spark.createDataFrame([(1, 10), (2, 20)], "doc_id long, doc_int long")
    shards = spark.createDataFrame([("a", 0), ("b", 1)], "word string, shard long")
    got, ran = final(IX.sharded_postings(IX.postings_rows(terms, ids), shards))
    assert sorted(map(tuple, got)) == [(0, "a", 10), (0, "a", 20), (1, "b", 20)]
    assert "SortMergeJoin" not in ran and ran.count("ShuffledHashJoin") >= 2


def test_a_build_lists_the_folders_of_a_part_once(spark, tmp_path, monkeypatch):
    B.append_part(spark.range(5).toDF("id"), str(tmp_path))
    seen, read = [], B._read
    monkeypatch.setattr(B, "_read", lambda s, path, **o: seen.append(path) or read(s, path, **o))
    assert B.read_build(spark, str(tmp_path)).count() == 5 and len([p for p in seen if "/part-" in p]) == 1


def test_word_rules_look_only_at_texts_they_can_change(spark):
    texts = ["", " ", "Cannot we? 'Tis D'ye say \"no\", it's 1,5: ok.", "a,\nb: Then `so` -- (x) y... Z", "they'll, GONNA wanna go:", "x'"]
    plain = F.col("t")
    for pattern, by in WT.SENTENCES + WT.RULES:
        plain = F.regexp_replace(plain, pattern, by)
    df = spark.createDataFrame([(t,) for t in texts + [None]], "t string")
    rows = df.select(F.filter(F.split(plain, "[ \n]+"), lambda w: w != "").alias("want"), WT.word_tokenize("t").alias("got")).collect()
    assert all(r["want"] == r["got"] for r in rows)
    assert set(WT.NEEDS) | set(WT.PLAIN) <= {p for p, _ in WT.RULES} and len(WT.CONTRACTED) == 10
