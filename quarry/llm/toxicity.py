"""Toxicity by weak supervision.

Voters: lexicons by category, regex patterns, and word-stem patterns mined
from the labelled rows ("at least c words begin with this stem", where that is
far likelier in toxic documents; counts over all labelled rows of the learning
fold). A voter fires on a text or does not; no label votes.

Label model: a generative model with a fire rate per class and voter, fitted by
EM; the labels give the class balance and anchor the rates, and a posterior
comes from the votes alone. Correlations that remain between voters given the class shrink the weight
of voters that say the same thing, so a stem seen at three lengths does not
count three times. It gives every row of the fit sample a posterior label, which
may contradict the given one; ``Model.calibration`` holds it against the labels.

Classifier: logistic regression on the posterior labels over the voters and
hashed word stems, so that texts no voter knows are scored too. It is a few
thousand weights; every text is scored whole, in the tasks that read it.

Bounds: model and classifier are fitted on at most ``fit_rows`` labelled rows
(smallest id hashes of the learning fold); mining counts cover all of them.
The learning fold is ``crc32(doc_id) mod 3 != 1``; held-out rows, language,
source and id never enter a score.

Defined cases: null and empty texts have no features and get the intercept's
score; unlabelled rows and labels without text are ignored; of conflicting
labels the larger counts; without usable labels (none, or one class) the
lexicons and patterns alone score, each with the same fixed weight; empty
tables give no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise

THRESHOLD = 0.7
FIT_ROWS = 10_000
#: Mined stems: lengths, numbers of words, least toxic documents, least odds ratio.
STEM_LENGTHS = (4, 5, 6, 7)
STEM_COUNTS = (1, 2, 3)
MIN_SUPPORT = 5
MIN_ODDS = 30.0
HASH_BITS = 14
#: Share of the evidence of a voter that does not fire.
SILENCE = 0.2
#: Words whose features a worker remembers.
KNOWN_WORDS = 200_000

# Word stems by category, matched at the start of a word.
LEXICONS = {
    "insult": ["idiot", "moron", "imbecile", "loser", "clown", "stupid", "dumbass", "fool", "cretin", "dimwit", "jerk"],
    "degrade": ["worthless", "pathetic", "disgusting", "scum", "trash", "garbage", "filth", "vermin", "useless", "lowlife"],
    "hostile": ["hate you", "shut up", "drop dead", "get lost", "go to hell", "kill yourself"],
    "profane": ["bastard", "bullshit", "asshole", "damn you", "crap", "shit", "fuck", "bitch"],
    "german": ["abschaum", "dummkopf", "trottel", "wertlos", "ekelhaft", "erbärmlich", "arschloch", "scheiß"],
    "french": ["imbécile", "ordure", "minable", "connard", "salaud", "dégueulasse", "crétin", "abruti"],
    "spanish": ["imbécil", "estúpid", "basura", "patétic", "asqueros", "inútil", "cabrón", "escoria"],
}
PATTERNS = {
    "second_person": r"\byou(?:'re| are)? (?:such )?(?:an? )?(?:idiot|moron|loser|clown|fool|stupid|pathetic|worthless)",
    "masked": r"\b[a-z]+[*#@$]{2,}[a-z]*\b",
    "exclaimed": r"!{3,}",
}
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    stems: list[tuple[str, int]] = field(default_factory=list)
    bias: float = -2.5
    voter_weights: list[float] = field(default_factory=list)
    hash_weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << HASH_BITS))
    accuracies: dict[str, tuple[float, float]] = field(default_factory=dict)
    #: (rows, mean posterior, share of label 1) of the fit sample by tenths of the posterior.
    calibration: list[tuple[int, float, float]] = field(default_factory=list)

    @property
    def voters(self) -> list[str]:
        return [*LEXICONS, *PATTERNS, *(f"{s}* x{c}" for s, c in self.stems)]


class Featurizer:
    """Voters that fire on a text, and its distinct hashed stems.

    What a word contributes is worked out once and remembered. A lexicon or
    pattern is searched for only in texts with a word (or sign) that any of its
    matches must hold.
    """

    def __init__(self, stems: list[tuple[str, int]]):
        self.rules = [re.compile(r"\b(?:" + "|".join(map(re.escape, w)) + ")") for w in LEXICONS.values()]
        self.rules += [re.compile(p) for p in PATTERNS.values()]
        self.openings: dict[str, set[int]] = {"you": {len(LEXICONS) + list(PATTERNS).index("second_person")}}
        for i, entries in enumerate(LEXICONS.values()):
            for e in entries:
                self.openings.setdefault(e.split(" ")[0], set()).add(i)
        self.signs = {len(LEXICONS) + list(PATTERNS).index("masked"): "*#@$", len(LEXICONS) + list(PATTERNS).index("exclaimed"): "!"}
        self.open_lengths = sorted({len(o) for o in self.openings})
        self.stem_at: dict[str, list[tuple[int, int]]] = {}
        for i, (s, c) in enumerate(stems):
            self.stem_at.setdefault(s, []).append((c, len(self.rules) + i))
        self.lengths = sorted({len(s) for s in self.stem_at})
        self.known: dict[str, tuple[int, tuple[str, ...], tuple[int, ...]]] = {}

    def word(self, w: str) -> tuple[int, tuple[str, ...], tuple[int, ...]]:
        """Hash of the word's beginning, the mined stems it begins with, rules it may be the start of."""
        stems = tuple(s for s in {w[:n] for n in self.lengths} if s in self.stem_at)
        rules = {i for n in self.open_lengths for i in self.openings.get(w[:n], ())}
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        got = self.known[w] = (zlib.crc32(w[:5].encode()) & ((1 << HASH_BITS) - 1), stems, tuple(rules))
        return got

    def __call__(self, text: str | None) -> tuple[list[int], list[int]]:
        low = (text or "").lower()
        hashed: set[int] = set()
        counts: dict[str, int] = {}
        maybe = {i for i, signs in self.signs.items() if any(x in low for x in signs)}
        known = self.known.get
        for w, c in Counter(_WORD.findall(low)).items():
            h, stems, rules = known(w) or self.word(w)
            hashed.add(h)
            for s in stems:
                counts[s] = counts.get(s, 0) + c
            if rules:
                maybe.update(rules)
        fired = [i for i in maybe if self.rules[i].search(low)]
        fired += [k for s, n in counts.items() for c, k in self.stem_at[s] if n >= c]
        return sorted(fired), sorted(hashed)


def stem_counts(found: Counter, lengths, wanted=None) -> dict[str, int]:
    """How many words of the text begin with each stem (only ``wanted`` ones, if given)."""
    n: dict[str, int] = {}
    for size in lengths:
        for w, c in found.items():
            s = w[:size]
            if len(s) == size and (wanted is None or s in wanted):
                n[s] = n.get(s, 0) + c
    return n


# ---------------------------------------------------------------- learning fold
def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; 1 is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % 3


def learning_labels(labels: DataFrame) -> DataFrame:
    """``l_id, y``: one label per id of the learning fold."""
    y = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("toxic").cast("int").alias("y"))
    return y.filter("l_id is not null and y in (0, 1)").filter(fold(F.col("l_id")) != 1).groupBy("l_id").agg(F.max("y").alias("y"))


def mine_stems(rows: DataFrame) -> list[tuple[str, int]]:
    """Stems and word counts that mark toxic documents of ``rows(text, y)``; counts over all rows."""
    names = [f"{k}{c}" for c in STEM_COUNTS for k in ("neg", "pos")]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, list[int]] = {}
            for t, y in zip(b.column("text"), b.column("y").to_pylist()):
                for s, n in stem_counts(Counter(_WORD.findall((t.as_py() or "").lower())), STEM_LENGTHS).items():
                    row = seen.setdefault(s, [0] * len(names))
                    for k, c in enumerate(STEM_COUNTS):
                        if n >= c:
                            row[2 * k + y] += 1
            # sums of the batch: at most one row per stem
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.string()), *(pa.array([r[k] for r in seen.values()], pa.int64()) for k in range(len(names)))],
                ["stem", *names])

    n = rows.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    n_pos, n_neg = n[0] or 0, n[1] or 0
    if not n_pos or not n_neg:
        return []
    sums = rows.select("text", "y").mapInArrow(part, "stem string, " + ", ".join(f"{x} long" for x in names)).groupBy("stem").agg(
        *[F.sum(x).alias(x) for x in names])
    each = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"neg{c}").alias("neg"), F.col(f"pos{c}").alias("pos")) for c in STEM_COUNTS])
    c = sums.filter(F.col(f"pos{STEM_COUNTS[0]}") >= MIN_SUPPORT).select("stem", F.inline(each)).filter(F.col("pos") >= MIN_SUPPORT)
    odds = ((F.col("pos") + 0.5) / (n_pos - F.col("pos") + 0.5)) / ((F.col("neg") + 0.5) / (n_neg - F.col("neg") + 0.5))
    c = materialise(c.filter(odds >= MIN_ODDS).select("stem", "c", "pos"), "toxic-stems")
    # a longer stem says nothing new where its beginning has as many documents
    shorter = F.array(*[F.when(F.length("stem") > n, F.left("stem", F.lit(n))) for n in STEM_LENGTHS])
    begins = c.select("stem", "c", "pos", F.explode(shorter).alias("begin")).filter("begin is not null")
    of = c.select(F.col("stem").alias("begin"), "c", F.col("pos").alias("begin_pos"))
    same = begins.join(of, ["begin", "c"]).filter(F.col("pos") >= 0.95 * F.col("begin_pos")).select("stem", "c").distinct()
    kept = c.join(same, ["stem", "c"], "left_anti").orderBy(F.desc("pos"), F.length("stem"), "stem", "c")
    return [(r["stem"], r["c"]) for r in kept.collect()]  # the voters of the model


# ---------------------------------------------------------------- label model
def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 per row, and the fire rates per voter in class 1 and 0.

    ``votes``: rows x voters, 0/1. The labels ``gold`` give the class balance and
    anchor the fire rates, as counts that weigh as much as the posterior's own; a
    row's posterior itself comes from its votes alone. A voter that does not fire
    mostly abstains (``SILENCE`` of its evidence counts), and that all are silent
    is evidence of its own.
    """
    v = votes.astype(np.float64)
    balance = float(np.clip(gold.mean(), 0.001, 0.999))
    silent = (v.sum(axis=1) == 0).astype(np.float64)
    given = gold.astype(np.float64)
    q, share = given, np.ones(v.shape[1])
    fire1 = fire0 = np.full(v.shape[1], 0.5)
    for k in range(rounds):
        one, zero = q + given, 2 - q - given
        fire1, fire0 = (one @ v + 0.5) / (one.sum() + 1.0), (zero @ v + 0.5) / (zero.sum() + 1.0)
        none1, none0 = (one @ silent + 0.1) / (one.sum() + 1.0), (zero @ silent + 0.1) / (zero.sum() + 1.0)
        if k in (0, rounds // 2):
            rest = v - (q[:, None] * fire1 + (1 - q)[:, None] * fire0)
            sd = np.sqrt((rest ** 2).mean(axis=0)) + 1e-9
            corr = (rest.T @ rest) / max(len(v), 1) / np.outer(sd, sd)
            np.fill_diagonal(corr, 0)
            share = (1 + np.where(np.abs(corr) > 0.3, np.abs(corr), 0).sum(axis=1)) ** -0.5
        quiet = SILENCE * (share * np.log((1 - fire1) / (1 - fire0))).sum()
        z = math.log(balance / (1 - balance)) + v @ (share * np.log(fire1 / fire0)) + silent * math.log(none1 / none0) + quiet
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return q, fire1, fire0


def calibration(q: np.ndarray, gold: np.ndarray, bins: int = 10) -> list[tuple[int, float, float]]:
    """Rows, mean posterior and share of label 1 in each tenth of the posterior that has rows."""
    at = np.minimum((q * bins).astype(int), bins - 1)
    return [(int((at == b).sum()), float(q[at == b].mean()), float(gold[at == b].mean())) for b in range(bins) if (at == b).any()]


def fit_linear(rows: list[tuple[list[int], list[int]]], q: np.ndarray, n_voters: int,
               steps: int = 300, l2: float = 1e-4) -> tuple[float, np.ndarray]:
    """Logistic regression on soft labels: voters as 0/1, hashed stems scaled to
    unit length; full-batch Adam."""
    dim = n_voters + (1 << HASH_BITS)
    ptr, idx, val = [0], [], []
    for voters, hashed in rows:
        idx += voters
        val += [1.0] * len(voters)
        idx += [n_voters + h for h in hashed]
        val += [len(hashed) ** -0.5] * len(hashed)
        ptr.append(len(idx))
    idx_, val_ = np.array(idx, dtype=np.int64), np.array(val)
    of = np.repeat(np.arange(len(rows)), np.diff(ptr))
    w, b = np.zeros(dim), 0.0
    m, s, mb, sb = np.zeros(dim), np.zeros(dim), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(of, w[idx_] * val_, minlength=len(rows)) + b
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - q) / len(rows)
        g, gb = np.bincount(idx_, err[of] * val_, minlength=dim) + l2 * w / 10, err.sum()
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        mb, sb = 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb * gb
        rate = 0.1 / math.sqrt(1 + t / 50)
        fix1, fix2 = 1 - 0.9 ** t, 1 - 0.99 ** t
        w -= rate * (m / fix1) / (np.sqrt(s / fix2) + 1e-8)
        b -= rate * (mb / fix1) / (math.sqrt(sb / fix2) + 1e-8)
    return float(b), w


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The model learnt from the labelled documents of the learning fold."""
    n_rules = len(LEXICONS) + len(PATTERNS)
    default = Model(voter_weights=[4.0] * n_rules)
    y = materialise(learning_labels(labels), "toxic-labels")
    n = y.count()
    side = F.broadcast(y) if n * 16 <= 32 * 1024 * 1024 else y
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(side, F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "y")
    stems = mine_stems(rows)
    featurize = Featurizer(stems)
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)  # bounded: fit_rows ids
    sample = rows.join(F.broadcast(chosen), "doc_id", "left_semi")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            feats = [featurize(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array([np.array(f[0], dtype=np.int32).tobytes() for f in feats], pa.binary()),
                 pa.array([np.array(f[1], dtype=np.int32).tobytes() for f in feats], pa.binary())], ["doc_id", "y", "v", "x"])

    # repeated ids: one row each, so the sample stays within fit_rows
    got = (sample.mapInArrow(part, "doc_id long, y int, v binary, x binary").dropDuplicates(["doc_id"])
           .orderBy("doc_id").collect())
    gold = np.array([r["y"] for r in got], dtype=np.int64)
    if len(set(gold.tolist())) < 2:
        return default
    feats = [(np.frombuffer(r["v"], np.int32).tolist(), np.frombuffer(r["x"], np.int32).tolist()) for r in got]
    n_voters = n_rules + len(stems)
    votes = np.zeros((len(got), n_voters), dtype=np.float32)
    for i, (v, _) in enumerate(feats):
        votes[i, v] = 1
    q, fire1, fire0 = label_model(votes, gold)
    bias, w = fit_linear(feats, q, n_voters)
    model = Model(stems, bias, w[:n_voters].tolist(), w[n_voters:])
    model.accuracies = {v: (float(a), float(c)) for v, a, c in zip(model.voters, fire1, fire0)}
    model.calibration = calibration(q, gold)
    return model


def score_rows(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``: probability of label 1. Every other column is kept."""
    featurize = Featurizer(model.stems)
    vw, hw, bias = np.array(model.voter_weights), model.hash_weights, model.bias

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        z = np.empty(len(texts))
        for i, t in enumerate(texts):
            v, x = featurize(t)
            z[i] = bias + vw[v].sum() + (hw[x].sum() / math.sqrt(len(x)) if x else 0.0)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn(out, scored(docs["text"].cast("string")))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` without the texts that score ``threshold`` or more; all columns kept."""
    scored = score_rows(docs, fit(docs, labels, fit_rows), "__toxic_score")
    return scored.filter(F.col("__toxic_score") < threshold).drop("__toxic_score")
