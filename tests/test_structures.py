"""Chunking, sharding, BFS and evaluation goldens (FIXTURES 3.3-3.4)."""

from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.operators import chunk as C
from quarry.operators import evaluate as EV
from quarry.operators import graph as G
from quarry.operators import index as IX


def test_window_starts(spark):
    df = spark.createDataFrame([(128,), (129,), (200,), (0,)], "n int")
    toks = F.sequence(F.lit(1), F.greatest(F.col("n"), F.lit(1)))
    toks = F.when(F.col("n") == 0, F.array().cast("array<int>")).otherwise(toks)
    got = [r[0] for r in df.select(C.windows(toks, 128, 64)).collect()]
    assert got == [[0], [0, 64], [0, 64, 128], [0]]


def test_chunk_coverage_and_padding(spark):
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ch = C.direct_split(docs, DEFAULT, "\n\n").orderBy("win_no").collect()
    assert [c.n_tokens for c in ch] == [128, 128, 72]
    assert all(len(c.tokens) == 128 for c in ch)
    assert ch[-1].tokens[72:] == [0] * 56
    assert all(c.text_idx == 0 and c.text_len == len(text) for c in ch)


def test_repeated_paragraph_offsets(spark):
    docs = spark.createDataFrame([(1, "a\n\nb\n\na")], "doc_id long, text string")
    first = [r.text_idx for r in C.split_pieces(docs, "\n\n").orderBy("piece_no").collect()]
    true = [r.text_idx for r in C.split_pieces(docs, "\n\n", true_offsets=True).orderBy("piece_no").collect()]
    assert first == [0, 3, 0] and true == [0, 3, 6]


def test_recursive_split_fits(spark):
    text = "\n".join(" ".join(f"x{i}_{j}" for j in range(300)) for i in range(2))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    out = C.recursive_split(docs, DEFAULT).collect()
    assert all(r.n_tokens <= 128 for r in out)
    assert sum(r.n_tokens for r in out) == 600


def test_shards(spark):
    dfs = spark.createDataFrame([("w1", 6), ("w2", 5), ("w3", 4), ("w4", 3)], "word string, num_docs long")
    got = {r.word: r.shard for r in IX.shard_by_df(dfs, 10).collect()}
    assert got == {"w1": 0, "w2": 1, "w3": 1, "w4": 2}


def test_shards_are_the_greedy_cut(spark):
    import random
    rnd = random.Random(8)
    for cap in (1, 7, 50, 400):
        data = [(f"w{i:03d}", int(rnd.paretovariate(0.8))) for i in range(200)]
        want, shard, total = {}, 0, 0
        for w, d in sorted(data, key=lambda x: (-x[1], x[0])):
            if total and total + d > cap:
                shard, total = shard + 1, 0
            want[w], total = shard, total + d
        dfs = spark.createDataFrame(data, "word string, num_docs long")
        assert {r.word: r.shard for r in IX.shard_by_df(dfs, cap).collect()} == want


def test_sequential_ids_dense(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    ids = IX.sequential_ids(df, [F.col("k")], "seq")
    rows = ids.collect()
    assert sorted(r.seq for r in rows) == list(range(1, 5001))
    assert all(r.seq == r.k + 1 for r in rows)


def test_bfs(spark):
    edges = spark.createDataFrame(
        [("A", "B"), ("A", "C"), ("A", "D"), ("B", "E"), ("C", "A"), ("E", "F")], "src string, dst string")
    starts = spark.createDataFrame([(1, "A")], "query_id long, node string")
    got = {r.node: r.depth for r in G.bfs(starts, edges, 2, 2).collect()}
    assert got == {"A": 0, "B": 1, "C": 1, "E": 2}


def test_recall(spark):
    res = spark.createDataFrame([(1, 3, 10), (2, 12, 20), (3, 1, 99)], "query_id long, rank long, doc_id long")
    truth = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "query_id long, doc_id long")
    r = EV.recall(res, truth).first()
    assert r.n_queries == 3
    assert abs(r.recall_at_5 - 1 / 3) < 1e-6 and abs(r.recall_at_10 - 1 / 3) < 1e-6
    assert abs(r.recall_at_25 - 2 / 3) < 1e-6


def test_known_item_truth_matches_brute_force(spark):
    from quarry.sources import tables
    sf = "/root/testdata/sf0.01"
    items = tables.benchmark_queries(spark, sf)
    docs = tables.documents(spark, sf)
    got = {(r.query_id, r.doc_id) for r in EV.known_item_truth(items, docs).collect()}
    it = [(r.query_id, r.query) for r in items.collect()]
    ds = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    brute = {(q, d) for q, t in it for d, x in ds if t in x}
    assert got == brute and len(got) > 0


def test_weighted_sample_reproducible(spark):
    lens = spark.createDataFrame([(i, i % 50) for i in range(1, 400)], "doc_id long, doc_len long")
    a = [r.doc_id for r in EV.weighted_sample(lens, 5, 1234).orderBy("sample_rank").collect()]
    b = [r.doc_id for r in EV.weighted_sample(lens.repartition(7), 5, 1234).orderBy("sample_rank").collect()]
    assert a == b and len(set(a)) == 5
    assert all(x % 50 > 1 for x in a)


def test_sequential_ids_on_unordered_shuffled_input(spark):
    """Ids must be consistent even when the input's row order inside
    partitions differs between evaluations (aggregated, persisted input)."""
    from pyspark import StorageLevel
    base = spark.range(0, 20000).select((F.col("id") % 3000).alias("k"), F.col("id"))
    agg = base.groupBy("k").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    ids = IX.sequential_ids(agg, [F.desc("n"), F.asc("k")], "seq").collect()
    got = {r.k: r.seq for r in ids}
    expect = {k: i + 1 for i, (k, _) in enumerate(sorted(((r.k, r.n) for r in agg.collect()),
                                                          key=lambda x: (-x[1], x[0])))}
    assert got == expect
    sums = IX.running_sum(agg, "n", [F.asc("k")], "cum").collect()
    assert max(r.cum for r in sums) == 20000 and len({r.cum for r in sums}) == 3000


def test_known_item_truth_of_short_items(spark):
    """Items without an interior token match inside words, as ``contains`` does."""
    docs = spark.createDataFrame([(1, "xx hello worlds end"), (2, "hello world"), (3, "hell o world"), (4, None)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "hello world"), (2, "ell"), (3, "xx hello worlds"), (4, "nowhere"), (5, "")],
                                  "query_id long, query string")
    from quarry.operators import evaluate as EV
    got = {(r.query_id, r.doc_id) for r in EV.known_item_truth(items, docs).collect()}
    assert got == {(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (3, 1)}


def test_recursive_split_keeps_unsplittable_pieces(spark):
    """Two tokens per character and room for one: every token comes out."""
    from quarry.config import DEFAULT
    from quarry.operators.chunk import recursive_split
    docs = spark.createDataFrame([(1, "ab cd ef"), (2, ""), (3, None)], "doc_id long, text string")

    def two(c):
        return F.flatten(F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.array(F.ascii(x).cast("long"), F.ascii(x).cast("long"))))
    got = recursive_split(docs, DEFAULT.with_(context_length=1, overlap=0), two).collect()
    text = sorted((r["text_idx"], r["path"], chr(r["tokens"][0])) for r in got)
    assert "".join(c for _, _, c in text) == "aabbccddeeff" and {r["n_tokens"] for r in got} == {1}


def test_splitter_is_literal(spark):
    from quarry.operators.chunk import split_pieces
    docs = spark.createDataFrame([(1, "a.b|c\\Ed")], "doc_id long, text string")
    for sep, want in ((".", ["a", "b|c\\Ed"]), ("|", ["a.b", "c\\Ed"]), ("\\E", ["a.b|c", "d"])):
        assert [r["piece"] for r in split_pieces(docs, sep).orderBy("piece_no").collect()] == want


def test_prefix_matches(spark):
    from quarry.operators.candidates import prefix_matches
    pre = spark.createDataFrame([("a",), ("appl",), ("zz",), ("",)], "prefix string")
    voc = spark.createDataFrame([("apple",), ("appliance",), ("a",), ("banana",)], "word string")
    assert {tuple(r) for r in prefix_matches(pre, voc).collect()} == {
        ("a", "apple"), ("a", "appliance"), ("a", "a"), ("appl", "apple"), ("appl", "appliance")}


def test_restricted_index_must_cover_the_batch(spark):
    import pytest
    from quarry.operators import search as S
    from quarry.operators import terms as TM
    docs = spark.createDataFrame([(1, "red apple"), (2, "green pear")], "doc_id long, text string")
    idx = TM.SparseIndex(docs, "basic").restrict(spark.createDataFrame([("apple",)], "word string"))
    q = spark.createDataFrame([(1, "green apple")], "query_id long, query string")
    with pytest.raises(ValueError):
        S.search_bm25(q, idx)
