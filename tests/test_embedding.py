"""Hashed vectors: the JVM expression, its numpy plug-in twin, and plain arithmetic."""

import hashlib

from pyspark.sql import functions as F

from quarry.config import DEFAULT as P
from quarry.operators import chunk as C
from quarry.operators import dense as D
from quarry.operators import rerank as RR


def plain(tokens, dims, pad, positions=0):
    if tokens is None:
        return None
    out = [0] * dims
    for t in tokens:
        if t != pad:
            c = int(hashlib.md5(str(t).encode()).hexdigest()[:8], 16) % (2 * dims)
            out[c // 2] += 1 if c % 2 else -1
    return [x / max(len(tokens), positions, 1) for x in out]


CASES = [None, [], [0, 0, 0, 0], [5], [5, 5, 7, 0], list(range(64)), [3] * 128 + [9] * 128, [29999, 1, 30000, 0]]


def test_hashed_vector(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "i int, tokens array<bigint>").orderBy("i")
    for dims, positions in ((64, 0), (8, 128), (200, 0)):
        want = [plain(t, dims, 0, positions) for t in CASES]
        near = [None if w is None else [round(x, 5) for x in w] for w in want]
        for build in (None, lambda d=dims, p=positions: D.hashing_fn(d, 0, p)):
            vec = D.embedding(F.col("tokens"), P.with_(dims=dims, pad_token_id=0), build, positions)
            got = [r[0] for r in df.select(vec).collect()]
            assert [None if g is None else [round(x, 5) for x in g] for g in got] == near


def test_default_embedding_stays_in_the_jvm(spark):
    docs = spark.createDataFrame([(1, "a b c\n\nd e f")], "doc_id long, text string")
    vec = RR.embed_chunks(docs, P)
    assert "Python" not in vec._jdf.queryExecution().toString()
    assert vec.count() == 2
    assert "ArrowEvalPython" in RR.embed_chunks(docs, P, lambda: D.hashing_fn(P.dims, 0))._jdf.queryExecution().toString()


def test_queries_and_chunks_have_the_same_vector(spark):
    docs = spark.createDataFrame([(1, "Some Words here")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "some words HERE"), (2, None), (3, "w " * 500)], "query_id long, query string")
    qv = {r["query_id"]: r["qvec"] for r in RR.embed_queries(q, P).collect()}
    assert qv[1] == RR.embed_chunks(docs, P).first()["vector"] and qv[2] is None
    assert abs(sum(x * x for x in qv[3]) - 1) < 1e-6   # one word, all 500 positions


def test_lookup_of_long_ids(spark, tmp_path):
    from quarry.plans.q_misc import s13_bulk_lookup
    spark.createDataFrame([(3_000_000_000, "Title\ntext", "s", "en")], "doc_id long, text string, source string, lang string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "no key", "")], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["key"]: (r["file"], r["entry"], r["title"]) for r in s13_bulk_lookup(spark, str(tmp_path)).collect()}
    assert got == {"s.zim3000000000": ("s", "3000000000", "Title"), "no key": ("", "", "")}


def test_batch_tokenizer_gives_the_ids_of_the_hash_tokenizer(spark):
    texts = [None, "", "  ", "a", " Some\tWords\r\n\x0bhere ", "ÄÖ İ \u00a0x", "w " * 300, "a\n\nb a\x0cb", "\t", None]
    for rows in (texts, [None, None], [""]):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").orderBy("i")
        got = df.select(C.hash_tokenizer(F.col("t")).alias("a"), C.batch_hash_tokenizer(F.col("t")).alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got]
        assert [r["b"] is None for r in got] == [t is None for t in rows]


def test_stored_vectors_are_those_of_the_expression(spark):
    """The vectors of the storage queries come from Arrow batches, tokens and sums alike."""
    from quarry.plans.catalog import load_all
    load_all()
    from quarry.plans.q_storage import _file_vectors
    rows = [(1, "f", 1, "a b\n\nc " + "d e f " * 60), (2, "g", 2, " "), (3, "g", 3, None), (4, "f", 4, "x"), (4, "h", 4, "y\n\n"), (None, "f", 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, file string, entry_id long, text string")
    cols = ["file", "entry_id", "doc_id", "piece_no", "win_no", "vector"]
    vec = _file_vectors(docs)
    want = RR.embed_chunks(docs.select("doc_id", "text"), P).join(docs.drop("text"), "doc_id").select(*cols)
    assert sorted(map(str, vec.collect())) == sorted(map(str, want.collect()))
    plan = vec._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan and "md5" not in plan


def test_vectors_are_embedded_once_for_both_writes(spark, tmp_path, monkeypatch):
    from quarry.plans.catalog import load_all
    load_all()
    from quarry.plans import q_storage as Q
    spark.createDataFrame([(1, "a b\n\nc", "f"), (2, "d", "g")], "doc_id long, text string, source string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    save, kept = Q.ST.save_vectors, []

    def spy(vec, path, mode):
        kept.append(vec.storageLevel.useMemory)
        save(vec, path, mode)
    monkeypatch.setattr(Q.ST, "save_vectors", spy)
    assert Q.s9_vector_table(spark, str(tmp_path)).count() == 3 and kept == [True, True]
