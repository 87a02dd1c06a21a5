"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import ann, common, decontam, license, linededup, mixing, sharding, simhash, suffix, toxicity, urlfilter
from tests.llm import brute

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use for helper columns, as further input columns.
CLASH = {"h": 1, "fp": 2, "size": 3, "t": "x", "lo": 4, "key": "k", "shard": 9, "rank": 1, "words": "w", "label": 7,
         "block": 1, "src": "q", "tie": 5, "score": 0.5, "spans": 1, "pi": 0.1, "kept": "no", "pos": 3, "host": "h"}


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    vocab = ["w" + "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(300)]

    def prose(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))

    passage, long_ = prose(60), "\n".join(prose(12) for _ in range(400))
    out = [None, "", " ", "\n", "one", "Two words", "ÀÉ upper É", passage, passage + " " + prose(40), prose(50) + "\n" + passage,
           long_, long_, long_ + " tail", "aaaa" * 300, "ab " * 500, "x\r\n  SHARED Line \n\n" + prose(5)]
    out += [f"  Shared line\n{prose(8)}\nshared LINE\t" for _ in range(12)]
    out += [prose(30) for _ in range(8)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    data = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    data += [data[7], data[7], data[4], (None, texts[8], None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(data, DOC)


def with_clash(docs):
    return docs.withColumns({k: F.lit(v) for k, v in CLASH.items() if k not in docs.columns})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def ids(docs):
    return rows(docs.select("doc_id", "text"))


# ------------------------------------------------------------------ simhash
def test_simhash_edges(docs, empty):
    got = rows(simhash.near_duplicates(with_clash(docs)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id"))
    assert sorted(got, key=str) == sorted(brute.components(ids(docs)), key=str)
    assert rows(simhash.near_duplicates(empty)) == []


@pytest.mark.parametrize("bits", [0, 1, 2, 4, 6])
def test_simhash_other_distances(spark, bits):
    rnd = random.Random(bits)
    base = [rnd.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for p in rnd.sample(range(64), rnd.randint(1, 8)):
                x ^= 1 << p
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = set(rows(simhash.candidate_links(spark.createDataFrame([(x,) for x in signed], "fp long"), bits)))
    want = {(min(a, b), max(a, b)) for a in signed for b in signed
            if a != b and bin((a ^ b) & (2 ** 64 - 1)).count("1") <= bits}
    assert got == want


def test_simhash_keys_of_nodes_are_not_broadcast(spark, tmp_path):
    # a small file by its size, but 68 keys a fingerprint on one side of the join
    path = str(tmp_path / "fps")
    spark.range(1000).select(F.xxhash64("id").alias("fp")).write.parquet(path)
    links = simhash.candidate_links(spark.read.parquet(path))
    links.collect()
    assert "Broadcast" not in links._jdf.queryExecution().executedPlan().toString()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 300)], "a long, b long")
    got = dict(rows(simhash.components(edges)))
    assert all(got[i] == 0 for i in range(61)) and {got[i] for i in (100, 200, 300)} == {100}


def test_simhash_keep_one(docs, empty):
    d = with_clash(docs)
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    got = [r for r in rows(kept.select("doc_id", "text"))]
    comp = {(d_, c) for d_, _, c in brute.components(ids(docs))}
    groups = {c for _, c in comp}
    assert len(got) == len(groups) and {r[0] for r in got} == groups
    assert rows(simhash.keep_one(empty)) == []


def test_side_beyond_the_bound_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "ids")
    spark.range(1000).write.parquet(path)
    side = spark.read.parquet(path)
    rows_ = spark.range(50).select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("n"), "id")
    for bound, there in ((8000, True), (7999, False)):
        j = rows_.join(common.small(side, 8, bound), "id")
        assert j.count() == 500
        j.collect()
        assert ("Broadcast" in j._jdf.queryExecution().executedPlan().toString()) == there


# ------------------------------------------------------------------ suffix
@pytest.mark.parametrize("block", [1 << 19, 700])
def test_suffix_edges(docs, empty, texts, block, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)
    want = [(d, *r) for (d, _), r in zip(ids(docs), brute.repeats([t for _, t in ids(docs)]))]
    got = rows(suffix.remove_repeats(with_clash(docs)).select(
        "doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert rows(suffix.remove_repeats(empty)) == []


@pytest.mark.parametrize("block", [1 << 19, 700])
def test_suffix_keep_first(spark, texts, block, monkeypatch):
    """Also with blocks so small that the anchors are settled by digests."""
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)
    data = [(i, t) for i, t in enumerate(texts[7:16])]
    left = {r[0]: bytes(r[1]) for r in rows(suffix.remove_repeats(
        spark.createDataFrame(data, "doc_id long, text string"), keep_first=True).select("doc_id", "kept"))}
    seen, size = set(), 200
    order = {(i, t): n for n, (i, t) in enumerate(data)}
    for i, t in sorted(data, key=lambda x: order[x]):
        b = t.encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - size + 1):
            if b[p:p + size] in seen:
                gone[p:p + size] = True
            seen.add(b[p:p + size])
        assert left[i] == bytes(c for c, g in zip(b, gone) if not g)


@pytest.mark.parametrize("size", [200, 260])
def test_suffix_largest_start_of_a_block(spark, size):
    """The start that sorts last keeps its match, one of exactly 200 bytes too."""
    rnd = random.Random(size)

    def noise(n):
        return "".join(rnd.choice("abcdefghij") for _ in range(n))

    shared = "z" + noise(size - 1)
    texts = [noise(150) + "k" + shared + "l" + noise(150), noise(90) + "m" + shared + "n" + noise(210)]
    at = [t.index(shared) for t in texts]
    g = pd.DataFrame({"doc_id": [0, 1], "h": [0, 1], "many": [False, False], "lo": [0, 0],
                      "n": [len(t) - 199 for t in texts], "t": [t.encode() for t in texts]})
    got = suffix._block(g, 200)
    assert got[got["kind"] == "later"][["doc_id", "lo", "hi"]].values.tolist() == [[1, at[1], at[1] + size]]
    assert got[got["kind"] == "copy"][["doc_id", "lo", "hi"]].values.tolist() == [[i, at[i], at[i] + size] for i in (0, 1)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r[0]: bytes(r[1]).decode() for r in rows(suffix.remove_repeats(d).select("doc_id", "kept"))}
    assert left == {i: t.replace(shared, "") for i, t in enumerate(texts)}


def test_lpf_is_the_longest_previous_factor():
    rnd = random.Random(1)
    for n in (1, 2, 30, 120):
        codes = np.array([rnd.choice([1, 2, 3]) for _ in range(n)])
        sa, lcp = suffix.suffix_array(codes, 256)
        got = suffix.lpf(sa.tolist(), lcp.tolist())
        for i in range(n):
            best = max((next((k for k in range(n - i) if codes[i + k] != codes[j + k]), n - i) for j in range(i)), default=0)
            assert got[i][0] == best
            if best:
                j = got[i][1]
                assert j < i and (codes[j:j + best] == codes[i:i + best]).all()


# ------------------------------------------------------------------ lines
def test_lines_edges(docs, empty):
    d = with_clash(docs)
    got = rows(linededup.apply_bitmaps(d, linededup.keep_bitmaps(d)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256)))
    assert sorted(got, key=str) == sorted(brute.lines(ids(docs)), key=str)
    assert any(r[2] for r in got)
    assert rows(linededup.apply_bitmaps(empty, linededup.keep_bitmaps(empty))) == []


def test_lines_keep_first_and_long_documents(spark):
    many = "\n".join(f"l{i % 150}" for i in range(1000))
    d = spark.createDataFrame([(1, many), (2, "l3\nnew\nL3 "), (3, "new")], "doc_id long, text string")
    got = dict(rows(linededup.apply_bitmaps(d, linededup.keep_bitmaps(d, min_docs=1, keep_first=True)).select("doc_id", "kept")))
    assert got[1] == "\n".join(f"l{i}" for i in range(150)) and got[2] == "new" and got[3] == ""


# ------------------------------------------------------------------ decontamination
def test_decontam_edges(spark, docs, empty, texts):
    w = brute.words(texts[7])
    items = [(1, " ".join(w[5:17]).upper()), (2, "two WORDS"), (3, None), (4, ""), (2, "two WORDS"), (5, "not there at all"),
             (None, "one"), (6, " ".join(w[8:18]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontam.contamination(with_clash(docs), bench).select(
        "doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), F.col("n_hit") > 0))
    assert sorted(got, key=str) == sorted(brute.contamination(ids(docs), items), key=str)
    kept = decontam.clean_documents(with_clash(docs), bench)
    bad = {r[0] for r in brute.contamination(ids(docs), items) if r[5]}
    assert kept.columns == with_clash(docs).columns
    assert sorted((r for r in rows(kept.select("doc_id"))), key=str) == sorted(((d,) for d, t in ids(docs) if not any(
        x[5] for x in brute.contamination([(d, t)], items))), key=str) and bad
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r[3] == 0 for r in rows(decontam.contamination(docs, none)))
    assert rows(decontam.contamination(empty, bench)) == []


def test_proximity(spark):
    rnd = random.Random(5)
    data = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(60))) for i in range(60)]
    items = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(4))) for i in range(10)]
    d, b = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    wins, _ = decontam.phrases(b)
    vocab = decontam.vocabulary(wins)
    index = decontam.build_index(d, vocab)
    cf = {r[0]: r[1] for r in rows(index.join(vocab, "term").groupBy("word").count())}
    term = dict(rows(vocab.select("word", "term")))
    for slop in (0, 1, 2):
        m = decontam.matches(d, index, wins, vocab, slop=slop)
        got = {(r[0], tuple(r[1]), r[2]) for r in rows(m.join(wins, "win").select("doc_id", "words", "start"))}
        want = set()
        for i, t in data:
            w = t.split()
            for _, p in items:
                p = p.split()
                off = min(range(len(p)), key=lambda k: (cf.get(p[k], 0), k, term[p[k]]))
                for at in (k for k, x in enumerate(w) if x == p[off]):
                    s = at - off
                    if all(any(0 <= s + k + e < len(w) and w[s + k + e] == x for e in range(-slop, slop + 1)) for k, x in enumerate(p)):
                        want.add((i, tuple(p), s))
        assert got == want


def test_candidates_leave_their_documents(spark, monkeypatch):
    """Where the windows are too many to broadcast, no exchange carries a document's words."""
    import contextlib
    import io

    d = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "x y")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "b c d e")], "item_id long, text string")
    wins, _ = decontam.phrases(b)
    vocab = decontam.vocabulary(wins)
    index = decontam.build_index(d, vocab)
    monkeypatch.setattr(decontam, "small", lambda df, *_: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = decontam.matches(d, index, wins, vocab)
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            m.explain("formatted")
        assert [r["start"] for r in m.collect()] == [1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [p for p in plan.getvalue().split("\n\n") if ") Exchange" in p]
    assert len(moved) >= 2 and not any(re.search(r"\bws#", p.split("Arguments")[0]) for p in moved)
    assert any("here#" in p for p in moved)


# ------------------------------------------------------------------ urls
def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Example.ORG/es/1", "http://example.org", "http://a.example.org/en/1x?q",
            "http://xorg/", "http://b.com/fr/#z", "http://b.com/de/1", "x://y://z/p?q", "http://c.net/en/5"]
    urls += [f"http://a{i}.org/good/{i}" for i in range(40)] + [f"http://b{i}.com/de/bad/{i}" for i in range(40)]
    urls += ["http://a7.net/good/7", "http://b7.net/de/bad/7", "http://a7.net/good/7"]
    d = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("score", F.lit(1)).withColumn("host", F.lit("x"))
    got = {r["page_id"]: r for r in urlfilter.judge(d).collect()}
    assert len(got) == len(urls)
    assert (got[0]["host"], got[0]["path"], got[0]["rule"]) == ("", "", None) and got[2]["host"] == ""
    assert (got[4]["host"], got[4]["rule"], got[4]["verdict"]) == ("example.org", "example.org/es/", "block")
    assert got[5]["path"] == "" and got[5]["rule"] is None
    assert got[6]["rule"] == "example.org/en/1" and got[7]["rule"] is None and got[8]["rule"] == "com/fr/"
    assert (got[10]["host"], got[10]["path"]) == ("y:", "//z/p")
    n = len(urls)
    assert got[n - 3]["verdict"] == "allow" and got[n - 2]["verdict"] == "block" and got[n - 1]["verdict"] == "allow"
    lone = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in urlfilter.judge(lone).collect()} == {"allow"}
    assert urlfilter.judge(d.limit(0)).collect() == []


# ------------------------------------------------------------------ sharding
def test_shard_edges(docs, empty):
    got = sharding.interleave(with_clash(docs), rows_per_bucket=7).toPandas()
    n = docs.count()
    assert len(got) == n
    per = got.groupby("shard")["slot"].apply(sorted)
    sizes = [len(per.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and all(list(v) == list(range(len(v))) for v in per)
    one = sharding.interleave(docs).toPandas()
    key = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert sorted(map(str, got[key].values.tolist())) == sorted(map(str, one[key].values.tolist()))  # buckets do not matter
    assert rows(sharding.interleave(empty)) == []
    few = sharding.interleave(docs.filter("doc_id in (1, 2, 3)"), n_shards=16).toPandas()
    assert sorted(few["slot"]) == [0, 0, 0]


def test_shard_many_sources(spark):
    """More sources than a bucket's rows, most of one row: they tie at 0.5 and are cut by source."""
    data = [(i, f"s{i % 700}" if i < 1000 else f"one{i}", f"t{i}") for i in range(4000)]
    d = spark.createDataFrame(data, "doc_id long, source string, text string")
    key = ["doc_id", "shard", "slot"]
    want = sorted(map(tuple, sharding.interleave(d).select(*key).collect()))
    assert sorted(map(tuple, sharding.interleave(d, rows_per_bucket=50).select(*key).collect())) == want
    src = spark.createDataFrame([(0.5, f"x{i:05d}", i + 1) for i in range(900)], "frac double, _src string, _sr long")
    got = sharding._positions(src, 900, 900, 50)
    assert sorted(map(tuple, got.select("_sr", "_pos").collect())) == [(i + 1, i) for i in range(900)]


# ------------------------------------------------------------------ mixing
def test_mix_edges(docs, empty):
    got = mixing.mix(with_clash(docs), block_rows=4).toPandas()
    assert len(got) == docs.count() and got["taken"].ge(0).all() and (got["taken"] <= 3 * got["size"]).all()
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").encode().split())
    want = brute.targets(sizes)
    for s, t in want.items():
        g = got[got["src"].isna()] if s is None else got[got["src"] == s]
        assert np.allclose(g["target"], t) and abs(g["taken"].sum() - t) <= g["size"].max()
    again = mixing.mix(docs.repartition(5), block_rows=4).toPandas()
    key = ["doc_id", "src", "size", "taken"]
    assert sorted(map(str, got[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))
    assert rows(mixing.mix(empty)) == []
    d = with_clash(docs)
    mixed = mixing.mixed_documents(d)
    assert mixed.columns == d.columns
    n = {}
    for r in mixed.select("doc_id", "text").collect():
        n[r] = n.get(r, 0) + 1
    whole = mixing.mix(d).groupBy("doc_id", "tie").agg(F.sum("copies")).toPandas()["sum(copies)"]
    assert sum(n.values()) == int(whole.sum())
    assert rows(mixing.mixed_documents(empty)) == []


def test_flight_keeps_totals():
    rng = np.random.default_rng(4)
    size = rng.integers(0, 500, 3000).astype(float)
    pi = np.full(3000, 0.37)
    out = mixing.flight(size, pi, rng)
    open_ = (out > 0) & (out < 1)
    assert open_.sum() <= 2
    assert abs(out.sum() - pi.sum()) < 1e-6 and abs((size * out).sum() - (size * pi).sum()) < 1e-3
    assert set(np.unique(mixing.land(size, out))) <= {0.0, 1.0}
    hits = np.mean([mixing.flight(size[:50], pi[:50], np.random.default_rng(s)) for s in range(600)], axis=0)
    assert np.abs(hits - 0.37).max() < 0.1  # inclusion probabilities hold


# ------------------------------------------------------------------ toxicity
def test_toxicity_edges(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (999, 1)], "doc_id long, toxic int")
    for lab in (none, odd):
        m = toxicity.fit(docs, lab)
        d = with_clash(docs).drop("score")
        got = toxicity.score_rows(d, m)
        assert got.columns == [*d.columns, "score"] and all(0 <= r["score"] <= 1 for r in got.collect())
        low, high = (toxicity.score_rows(spark.createDataFrame([(1, t)], "doc_id long, text string"), m).first()["score"]
                     for t in ("a calm text", "you idiot, worthless, shut up"))
        assert low < 0.7 < high
        blank = {r["score"] for r in toxicity.score_rows(docs.filter("text is null or text = ''"), m).collect()}
        assert len(blank) == 1
    assert rows(toxicity.clean_documents(empty, none)) == []
    assert toxicity.clean_documents(docs, none).count() == docs.count()


def test_label_model_weighs_correlated_voters():
    rng = np.random.default_rng(0)
    y = (rng.random(4000) < 0.2).astype(int)
    good = [((rng.random(4000) < p) & (y == 1)) | (rng.random(4000) < 0.01) for p in (0.7, 0.6, 0.8)]
    noise = rng.random(4000) < 0.3
    votes = np.stack([*good, noise, noise], axis=1).astype(float)
    q, fire1, fire0 = toxicity.label_model(votes, y)
    assert ((q > 0.5) == (y == 1)).mean() > 0.96
    assert (fire1[:3] / fire0[:3] > 5).all() and (fire1[3:] / fire0[3:] < 2).all()


def test_noisy_labels_are_outvoted():
    rng = np.random.default_rng(1)
    y = (rng.random(5000) < 0.2).astype(int)
    votes = np.stack([((rng.random(5000) < 0.5) & (y == 1)) | (rng.random(5000) < 0.005) for _ in range(8)], axis=1).astype(float)
    gold = np.where(rng.random(5000) < 0.1, 1 - y, y)   # one label in ten is wrong
    q, _, _ = toxicity.label_model(votes, gold)
    wrong = gold != y
    assert ((q[wrong] > 0.5) == (y[wrong] == 1)).mean() > 0.9 and ((q > 0.5) == (y == 1)).mean() > 0.96
    bins = toxicity.calibration(np.array([0.05, 0.07, 0.95, 1.0]), np.array([0, 1, 1, 1]))
    assert [n for n, _, _ in bins] == [2, 2] and [round(s, 2) for _, _, s in bins] == [0.5, 1.0]


def test_featurizer_finds_what_the_rules_find():
    f = toxicity.Featurizer([("abcd", 1), ("abcd", 2), ("abcde", 1), ("xyz1", 1)])
    texts = ["you are such an idiot", "YOU'RE PATHETIC!!!", "hate you, shut up", "x idiotic 1idiot _moron", "f**k sh@@ a*b", "!!",
             "abcdef abcdx ABCDE", "vermin dummkopf abruti escoria", "drop dead now", "kill yourself", "you loser", "you fools", None, ""]
    for t in texts:
        low = (t or "").lower()
        fired = {i for i, r in enumerate(f.rules) if r.search(low)}
        n = {s: sum(w.startswith(s) for w in toxicity._WORD.findall(low)) for s in f.stem_at}
        fired |= {k for s, at in f.stem_at.items() for c, k in at if n[s] >= c}
        assert f(t)[0] == sorted(fired), t


# ------------------------------------------------------------------ licences
def test_license_inheritance(spark):
    files = [("/a/LICENSE", "Licensed under the Apache License, Version 2.0"), ("/a/x.py", "code"), ("/a/b/c/y.py", "code"),
             ("/a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
             ("/a/b/z.py", "# Released under the MIT License.\ncode"), ("/a/b/c/d/e.py", ""), ("/q/w.py", None), (None, "code"),
             ("w.py", "code"), (None, "Licensed under CC BY-NC 4.0."), ("/a/x.py", "code"), ("/ab/n.py", "code"),
             ("/long.txt", "word " * 20000 + "\nReleased under the MIT License.")]
    d = spark.createDataFrame(files, "path string, text string").withColumn("license", F.lit("no")).withColumn("how", F.lit(1))
    got = [(r["path"], r["license"], r["how"], r["from_path"]) for r in license.scan(d).collect()]
    assert len(got) == len(files)
    by = {}
    for p, *rest in got:
        by.setdefault(p, []).append(tuple(rest))
    assert by["/a/LICENSE"] == [("Apache-2.0", "file", None)] and by["/a/b/COPYING"] == [("GPL-3.0", "file", None)]
    assert by["/a/x.py"] == [("Apache-2.0", "inherited", "/a/LICENSE")] * 2
    assert by["/a/b/c/y.py"] == by["/a/b/c/d/e.py"] == [("GPL-3.0", "inherited", "/a/b/COPYING")]
    assert by["/a/b/z.py"] == [("MIT", "header", None)] and by["/long.txt"] == [("MIT", "header", None)]
    assert by["/q/w.py"] == by["w.py"] == by["/ab/n.py"] == [(None, "none", None)]
    assert sorted(by[None], key=str) == [("CC-BY-NC-4.0", "header", None), (None, "none", None)]
    assert license.scan(d.limit(0)).collect() == []


def test_license_paths_of_documents(spark, tmp_path):
    from quarry.llm import queries
    said = "Licensed under the Apache License, Version 2.0."
    data = [(0, said, "en", "web"), (None, said, "en", "web"), (5, "plain words", "en", "web"), (1005, "plain words", "en", "web"),
            (6, "plain words", None, "web"), (7, "plain words", "en", None)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["path"]: (r["license"], r["how"], r["from_path"]) for r in queries.op9_license_scan(spark, str(tmp_path)).collect()}
    first = "/web/en/0/LICENSE"
    assert got[first][:2] == ("Apache-2.0", "file") and got["/web/en/0/5.txt"] == ("Apache-2.0", "inherited", first)
    assert got[None][1] == "header" and len(got) == 6
    assert {got[p][1] for p in ("/web/en/1/1005.txt", "/web/(none)/0/6.txt", "/(none)/en/0/7.txt")} == {"none"}


def test_url_grams_in_one_pass(spark):
    urls = ["a", "ab", "http://x.org/é🙂/" + "q" * 30, "漢" * 9, "🙂🙂🙂🙂🙂🙂", "a\nb\nc\nd\ne"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    for order in (1, 4):
        want = sorted((u, ("\x02" + u)[max(0, p - order):p], u[p - 1]) for u in urls for p in range(1, len(u) + 1))
        assert sorted(rows(urlfilter.pairs(df, order, "url"))) == want


def test_very_long_url(spark):
    import time
    long_ = "http://long.net/" + "abcdefghij" * 40_000
    d = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.com/de/y"), (3, long_)], "page_id long, url string")
    start = time.time()
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(d).collect()}
    assert set(got) == {1, 2, 3} and got[1] == "allow" and got[2] == "block" and time.time() - start < 90


COMMON = "/usr/share/common-licenses/"
MIT_TEXT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction."""


def test_license_wrapped_headers(spark):
    """Notices over several lines, without the word licence, inside one long line."""
    want, files = {}, []
    gpl = ("# This program is free software; you can redistribute it and/or modify\n"
           "# it under the terms of the GNU General Public License as published by\n"
           "# the Free Software Foundation; either version {} of the License, or\n# (at your option) any later version.\ncode")
    long_ = " ".join(f"w{i % 90}" for i in range(240))
    for path, text, said in (("/h/gpl2.py", gpl.format(2), "GPL-2.0"), ("/h/gpl3.py", gpl.format(3), "GPL-3.0"), ("/h/mit.c", MIT_TEXT, "MIT"),
                             ("/h/long.txt", long_ + " Licensed under the Apache License, Version 2.0", "Apache-2.0")):
        files.append((path, text))
        want[path] = (said, "header")
    files.append(("/h/none.txt", "The permission was granted and the license of the driver is in the domain of the state."))
    want["/h/none.txt"] = (None, "none")
    got = license.scan(spark.createDataFrame(files, "path string, text string")).collect()
    assert {r["path"]: (r["license"], r["how"]) for r in got} == want


def test_license_full_texts(spark):
    """Whole licence texts; the files beside them inherit."""
    want, files = {}, []
    for name, said in (("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2.1", "LGPL-2.1"),
                       ("LGPL-3", "LGPL-3.0"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("BSD", "BSD-3-Clause")):
        with open(COMMON + name) as f:
            files += [(f"/{name}/LICENSE", f.read()), (f"/{name}/x.py", "code")]
        want |= {f"/{name}/LICENSE": (said, "file"), f"/{name}/x.py": (said, "inherited")}
    got = license.scan(spark.createDataFrame(files, "path string, text string")).collect()
    assert {r["path"]: (r["license"], r["how"]) for r in got} == want


# ------------------------------------------------------------------ vectors
def test_vectors_edges(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(300, 8))
    data = [(i, [float(x) for x in v], 1) for i, v in enumerate(m)]
    data += [(1000 + i, [1.0] * 8, 1) for i in range(40)]  # a very common vector
    data += [(2000, None, 1), (2001, [0.0] * 8, 1), (2002, [float("nan")] * 8, 1), (2003, [1.0, None] + [1.0] * 6, 1),
             (2004, [1.0] * 7, 1), (2005, [], 1), (None, [1.0] * 8, 1), (5, [float(x) for x in m[5]], 1), (2020, [float("inf")] * 8, 1)]
    d = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(1)).withColumn("v", F.lit(2))
    got = ann.search(d, lambda i: i % 20 == 0, block_rows=16, recall=1.0).toPandas()
    want = ann.exact(d, sorted({*range(0, 300, 20), 1000, 1020}))
    assert set(got["query_id"]) == set(want["query_id"]) and len(got) == len(want)
    for q in (1000, 1020):  # ties go to the smaller id
        g = got[(got["query_id"] == q) & np.isclose(got["score"], 8.0)].sort_values("rank")
        assert list(g["vec_id"]) == sorted(g["vec_id"])
    hit = got.merge(want, on=["query_id", "vec_id"])
    assert len(hit) >= 0.95 * len(want)
    few = ann.search(d.filter("vec_id in (0, 1, 2)"), lambda i: i % 20 == 0).toPandas()
    assert sorted(few["vec_id"]) == [1, 2]
    assert rows(ann.search(d.limit(0), lambda i: i % 20 == 0)) == []


def test_rows_that_share_an_id_are_all_candidates(spark):
    data = [(20, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [9.0, 0.0]), (2, [0.7, 0.0]), (20, [3.0, 0.0])]
    d = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(d, lambda i: i % 20 == 0).collect())
    one, three = [(1, 9.0), (20, 3.0), (2, 0.7), (1, 0.5)], [(1, 27.0), (20, 3.0), (2, 2.1), (1, 1.5)]
    want = sorted((20, n, i, s) for found in (one, three) for n, (i, s) in enumerate(found, 1))
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want])


def test_clustered_vectors_need_a_small_scan(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(80, 16)) * 4
    m = centre[rng.integers(0, 80, 6000)] + rng.normal(size=(6000, 16)) * 0.2
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    c1, c2 = ann.kmeans(m[:, :8], 32, ann.SEED), ann.kmeans(m[:, 8:], 32, ann.SEED + 1)
    assert ann.calibrate(m, c1, c2, ann.TOP_K, ann.RECALL) < 0.1
    got = ann.search(d, lambda i: i % 50 == 0).toPandas()
    want = ann.exact(d, list(range(0, 6000, 50)))
    assert len(got) == len(want) and len(got.merge(want, on=["query_id", "vec_id"])) >= 0.9 * len(want)


def test_only_visited_cells_are_scored():
    rng = np.random.default_rng(4)
    m, js = rng.normal(size=(200, 6)), rng.integers(0, 5, 200)
    ids = np.arange(200)
    top = ann._block_top(ids, ids, m, js, 8)
    visited = np.zeros((3, 8), np.uint8)
    visited[0, 2], visited[1, [0, 4]] = 1, 1
    rows_, _, found, scores = top(np.array([0, 1, 2]), np.array([0, 1, 2]), m[:3], visited)
    for q, cells in ((0, [2]), (1, [0, 4]), (2, [])):
        mine = [(-s, i) for r, i, s in zip(rows_, found, scores) if r == q]
        want = sorted((-float(m[i] @ m[q]), int(i)) for i in ids if js[i] in cells and i != q)[:8]
        assert [i for _, i in mine] == [i for _, i in want]


def test_walk_is_sorted_and_complete():
    rng = np.random.default_rng(7)
    a, b, n = rng.normal(size=9), rng.normal(size=7), rng.integers(0, 4, size=(9, 7))
    cells = ann.walk(a, b, n, int(n.sum()) + 1)
    assert len(set(cells)) == 63 and [a[i] + b[j] for i, j in cells] == sorted((x + y for x in a for y in b), reverse=True)


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages_on_odd_rows(spark, docs, empty):
    sf = "/root/testdata/sf0.001"
    for d in (docs, empty, with_clash(docs)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, sf)
            assert name == "sharding" or out.columns == d.columns
            out.write.format("noop").mode("overwrite").save()


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
