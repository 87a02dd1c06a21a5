"""Line frequency, pivot clustering and token alignment against plain versions and edge cases."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import linefreq, pivotkmeans, queries, tokenalign
from quarry.sources.tables import table

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
A_FILE = Path(queries.TOKENIZERS, "byte_bpe_50k.json")
B_FILE = Path(queries.TOKENIZERS, "piece_bpe_32k.model")
DOC = "doc_id long, text string, source string"
CLASH = {"host": "x", "d": 1, "h": 2, "line": "l", "n": 3, "pos": 4, "pairs": "p", "times": 5, "row": 6, "pair": 7,
         "n_a": 8, "v": 9, "near": 1.0, "cluster": 4, "distance": 3, "s": "s", "kept": True, "best": 1}


def rows(df):
    return [tuple(r) for r in df.collect()]


def plus(df):
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items() if k not in df.columns})


# ---- line frequency

def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def plain_signals(t):
    w = words(t)
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(win)
    hit = {i + k for i, x in enumerate(win) if n[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(hit)


def test_repeat_words_against_plain():
    rnd = random.Random(5)
    for n in range(0, 40):
        w = [rnd.choice("abc") for _ in range(n)]
        assert linefreq.repeat_words(w) == plain_signals(" ".join(w))[4], w


@pytest.fixture(scope="module")
def pages(spark):
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(4000)]

    def prose(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))

    nav = "Home  About 12 items"
    data = [(i, f"{nav}\n{prose(90)}", "a") for i in range(30)]          # boilerplate, kept
    data += [(100 + i, f"\t{nav.upper()}\n" * 30 + prose(52), "a") for i in range(3)]          # mostly boilerplate
    data += [(200 + i, f"{nav}\n{prose(90)}", "b") for i in range(15)]                         # below b's limit
    copy = prose(80) + "\n" + prose(30)
    data += [(300 + i, copy, "a") for i in range(60)]                                          # copies are one document
    data += [(400, None, "a"), (401, "", "b"), (402, " \n\t\n", None), (403, prose(60), None), (None, copy, "a"),
             (None, None, None), (404, "x y z " * 40, "b"), (405, "\n".join(prose(9) for _ in range(9000)), "b")]
    return spark.createDataFrame(data + data[:2], DOC)


def test_line_frequency_cases(pages):
    got = {(r["doc_id"], r["n_words"]): r for r in linefreq.judge(pages).collect()}
    for r in pages.collect():
        g = got[r["doc_id"], len(words(r["text"]))]
        assert tuple(g[c] for c in linefreq._NAMES) == plain_signals(r["text"])
    by_id = {k: v for (k, _), v in got.items()}
    assert all(by_id[i]["removed_words"] == 4 and by_id[i]["kept"] for i in range(30))
    assert all(by_id[100 + i]["depleted"] and not by_id[100 + i]["kept"] for i in range(3))
    assert all(by_id[200 + i]["removed_words"] == 0 and by_id[200 + i]["kept"] for i in range(15))
    assert all(by_id[300 + i]["removed_words"] == 0 and by_id[300 + i]["kept"] for i in range(60))
    assert by_id[400]["base_failed"] and by_id[401]["base_failed"] and by_id[404]["base_failed"] and by_id[403]["kept"]
    assert linefreq.judge(pages).count() == pages.count()


def test_removed_lines_and_clashing_names(spark, pages):
    bad = linefreq.frequent_lines(pages)
    assert [r["n_docs"] for r in bad.collect()] == [33]
    left = {r["doc_id"]: r["text"] for r in linefreq.remove_lines(plus(pages), bad).collect()}
    was = {r["doc_id"]: r["text"] for r in pages.collect()}
    assert all(left[i] == was[i].split("\n", 1)[1] for i in range(30))
    assert all(left[i] == was[i] for i in (*range(200, 215), 300, 400, 401, 402, 404, 405))
    assert sorted(rows(linefreq.judge(plus(pages))), key=str) == sorted(rows(linefreq.judge(pages)), key=str)
    empty = spark.createDataFrame([], DOC)
    assert rows(linefreq.judge(empty)) == [] and rows(linefreq.remove_lines(empty, bad)) == []


def test_line_frequency_without_broadcast(pages, monkeypatch):
    want = sorted(rows(linefreq.judge(pages)), key=str)
    monkeypatch.setattr(linefreq, "BROADCAST_BYTES", -1)
    assert sorted(rows(linefreq.judge(pages)), key=str) == want


# ---- pivot clustering

def plain_clusters(vectors, k=16, rounds=3):
    """Lists of (id, integer vector): every distance computed with Python integers."""
    order = sorted(range(len(vectors)), key=lambda i: (
        vectors[i][0] is None, hashlib.sha256(f"1:{vectors[i][0]}".encode()).hexdigest(), vectors[i][1]))
    cents = [vectors[i][1] for i in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        who = [near(v)[1] for _, v in vectors]
        for j in range(len(cents)):
            mine = [v for (_, v), w in zip(vectors, who) if w == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, near(v)[1], near(v)[0]) for i, v in vectors]


VEC = "vec_id long, embedding array<double>"


def test_clusters_equal_plain(spark):
    rnd = random.Random(11)
    data = [(i, [rnd.choice([0.0, 0.25, -0.3, 2.0]) for _ in range(64)]) for i in range(60)]
    data += [(60 + i, list(data[3][1])) for i in range(25)] + [(3, list(data[3][1])), (3, [9.0] * 64), (None, [0.5] * 64)]
    bad = [(500, None), (501, []), (502, [1.0] * 63), (503, [float("nan")] + [0.0] * 63), (504, [float("inf")] + [0.0] * 63),
           (505, [None] + [0.0] * 63), (506, [1e300] * 64)]
    df = spark.createDataFrame(data + bad, VEC)
    got = rows(pivotkmeans.cluster(df).select("vec_id", "cluster", "distance"))
    want = plain_clusters([(i, [int(np.floor(64 * x)) for x in v]) for i, v in data])
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sorted(rows(pivotkmeans.cluster(plus(df)).select("vec_id", "cluster", "distance")), key=str) == sorted(want, key=str)


def test_few_equal_and_no_vectors(spark):
    one = spark.createDataFrame([(7, [0.5] * 64)], VEC)
    r = pivotkmeans.cluster(one).first()
    assert (r["cluster"], r["distance"], r["inertia"]) == (0, 0, 0)
    assert r["centroid_sha256"] == hashlib.sha256(",".join(["32"] * 64).encode()).hexdigest()
    same = spark.createDataFrame([(i, [0.5] * 64) for i in range(40)], VEC)
    assert {r["cluster"] for r in pivotkmeans.cluster(same).collect()} == {0}
    assert rows(pivotkmeans.cluster(spark.createDataFrame([], VEC))) == []
    big = spark.createDataFrame([(1, [2.0 ** 20] * 64), (2, [-2.0 ** 20] * 64)], VEC)
    assert {r["distance"] for r in pivotkmeans.cluster(big).collect()} == {0}


def test_bounds_never_exceed_and_prune(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(-400, 400, (16, 64))
    v = centre[rng.integers(0, 16, 4000)] + rng.integers(-12, 12, (4000, 64))
    piv = v[:16]
    cents = centre + rng.integers(-3, 3, centre.shape)
    low = pivotkmeans.bounds(pivotkmeans._to_pivots(v, piv), pivotkmeans._to_pivots(cents, piv), pivotkmeans.pivot_pairs(piv))
    exact = ((v[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (low <= exact).all() and (low > 0.25 * exact).mean() > 0.5
    df = spark.createDataFrame([(int(i), (x / 64).tolist()) for i, x in enumerate(v)], VEC)
    stats = {}
    pivotkmeans.cluster(df, stats=stats)
    assert stats["vectors"] == [4000] * 3
    assert all(c < 0.4 * 16 * 4000 for c in stats["computed"]), stats["computed"]


# ---- token alignment

def plain_alignment(data):
    """Groups by the offsets where both tokenizers' tokens end, over the libraries' own encoders."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    ta = Tokenizer.from_file(str(A_FILE))
    ta.encode_special_tokens = True
    tb = SentencePieceProcessor(model_file=str(B_FILE))
    spare = [b for b in range(256) if b not in set(tokenalign.PRINTABLE)]
    byte = {chr(b): b for b in tokenalign.PRINTABLE} | {chr(256 + i): b for i, b in enumerate(spare)}

    def bytes_a(i):
        return bytes(byte[c] for c in ta.id_to_token(i))

    def bytes_b(i):
        p = tb.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode()

    out = []
    for _, text in data:
        groups = []
        if text:
            want = (" " + text).encode()
            a, b = ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)
            if b"".join(map(bytes_a, a)) == want == b"".join(map(bytes_b, b)):
                i = j = x = y = 0
                ga, gb = [], []
                while i < len(a) or j < len(b):
                    if x <= y and i < len(a):
                        x += len(bytes_a(a[i]))
                        ga.append(a[i])
                        i += 1
                    else:
                        y += len(bytes_b(b[j]))
                        gb.append(b[j])
                        j += 1
                    if x == y and ga and gb:
                        groups.append((ga, gb))
                        ga, gb = [], []
        out.append(groups)
    docs = {}
    for (i, text), groups in zip(data, out):
        docs[i, text] = Counter((p, q) for ga, gb in groups for p in ga for q in gb)
    n = Counter(p for c in docs.values() for p in c)
    top = Counter()
    for (p, _), c in n.items():
        top[p] = max(top[p], c)
    res = []
    for (i, text), groups in zip(data, out):
        c = docs[i, text]
        line = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        res.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(c.values()),
                    sum(t for p, t in c.items() if n[p] == top[p[0]]), sum(t * n[p] for p, t in c.items()),
                    hashlib.sha256(line.encode()).hexdigest() if groups else ""))
    return res


@pytest.mark.parametrize("sf", [SMALL, MID])
def test_alignment_of_documents(spark, sf):
    got = rows(queries.op13_token_alignment(spark, sf))
    want = plain_alignment(rows(table(spark, sf, "documents").select("doc_id", "text")))
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.fixture(scope="module")
def odd(spark):
    texts = [None, "", " ", "\n", "a", "  two  spaces ", "tab\tand\r\nlines\n\n", "</s><s><unk> <|endoftext|> <0x41>", "▁x ▁",
             "漢字仮名交じり文🙂 é é ​", "\u0000\u0001", "a" * 5000, " " * 3000, "ab " * 4000, "I'll don't we've 12,345.67",
             "漢字仮名" * 700, "zqxj" * 900]
    data = list(enumerate(texts)) + [(4, "a"), (4, "a"), (4, "other"), (None, "a"), (None, None)]
    return data, spark.createDataFrame(data, "doc_id long, text string")


def test_alignment_cases(spark, odd):
    data, df = odd
    a, b = A_FILE.read_bytes(), B_FILE.read_bytes()
    want = sorted(plain_alignment(data), key=str)
    assert sorted(rows(tokenalign.alignment(df, a, b)), key=str) == want
    assert sorted(rows(tokenalign.alignment(plus(df), a, b)), key=str) == want
    assert rows(tokenalign.alignment(spark.createDataFrame([], "doc_id long, text string"), a, b)) == []


def test_alignment_with_few_broadcast_pairs(odd, monkeypatch):
    data, df = odd
    a, b = A_FILE.read_bytes(), B_FILE.read_bytes()
    want = sorted(plain_alignment(data), key=str)
    for room in (0, 8, 200):
        monkeypatch.setattr(tokenalign, "BROADCAST_BYTES", room * tokenalign.ROW_BYTES)
        assert sorted(rows(tokenalign.alignment(df, a, b)), key=str) == want


def test_links_in_runs_and_wide_slices(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 7, 260)
    cut_a, cut_b = np.array([1, 2, 90, 91, 300]), np.array([1, 60, 61, 200, 260])
    want = Counter()
    for i, j, k, m in zip([0, *cut_a[:-1]], cut_a, [0, *cut_b[:-1]], cut_b):
        want.update(int(x) * 7 + int(y) for x in a[i:j] for y in b[k:m])
    for run in (1, 10, 100, 5000, 1 << 21):
        monkeypatch.setattr(tokenalign, "RUN", run)
        codes, times = tokenalign.links(a, b, cut_a, cut_b, 7)
        assert dict(zip(codes.tolist(), times.tolist())) == want and (np.diff(codes) > 0).all()
