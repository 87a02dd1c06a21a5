"""URL filter: host/path rules, and a character language-model ratio for the rest.

Rules judge what they fit (longest rule wins). The URLs they judge train two
character models, one of accepted and one of rejected URLs: variable-order
Markov chains with Witten-Bell smoothing, in which a context of ``order``
characters backs off to its shorter suffixes as far as it was not seen. A URL's
score is the log-likelihood difference per character. The cut is calibrated on
a held-out part of the judged URLs (MD5 digit below ``3``): the middle of the
scores with the least sum of both error rates.

Counts are taken over the distinct judged URLs outside that part. (context, character) pairs are
counted at the highest order first and summed to the lower orders from there;
likelihoods are worked out once per distinct pair, so the corpus meets the
model in one join.

Defined cases: null URL or one without ``://`` has empty host and path and is
judged by the method; an empty URL scores 0; repeated URLs train once and are
returned each; without accepted or without rejected URLs there is no model and
everything the rules leave is allowed; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, materialise, small

ORDER = 4
ALPHABET = 256
BINS = 100
_START = "\x02"

#: (action, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(h: Column, p: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as ``struct<size, rule, verdict>``, else null."""
    every = F.array(*[F.struct(F.lit(len(rh + rp)).alias("size"), F.lit(rh + rp).alias("rule"), F.lit(a).alias("verdict"),
                               F.lit(rh).alias("host"), F.lit(rp).alias("path")) for a, rh, rp in rules])
    return F.array_max(F.filter(every, lambda r: ((h == r["host"]) | F.endswith(h, F.concat(F.lit("."), r["host"])))
                                & F.startswith(p, r["path"])))


def pairs(urls: DataFrame, order: int, *keep: str) -> DataFrame:
    """``keep..., ctx, ch`` for every character of ``urls(url)``.

    The grams of a URL are cut in one pass over it: the first characters have
    what there is before them as context, the others ``order`` characters.
    """
    s = F.concat(F.lit(_START), F.col("url"))
    early = F.slice(F.sequence(F.lit(1), F.least(F.lit(order), F.char_length("s"))), 2, order)
    first = F.transform(early, lambda p: F.struct(
        F.substring("s", F.lit(1), p - 1).alias("ctx"), F.substring("s", p, F.lit(1)).alias("ch")))
    whole = F.transform(F.regexp_extract_all("s", F.lit(f"(?s)(?=(.{{{order + 1}}}))."), F.lit(1)), lambda g: F.struct(
        F.left(g, F.lit(order)).alias("ctx"), F.right(g, F.lit(1)).alias("ch")))
    cut = urls.filter("url <> ''").select(*keep, s.alias("s")).select(*keep, F.concat(first, whole).alias("grams"))
    return cut.select(*keep, F.explode("grams").alias("g")).select(*keep, "g.ctx", "g.ch")


def _suffixes(order_col: str = "ctx") -> Column:
    return F.explode(F.transform(F.sequence(F.lit(0), F.char_length(order_col)), lambda k: F.struct(
        k.alias("k"), F.right(F.col(order_col), k).alias("c"))))


def train(urls: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """Models of ``urls(url, ok)``: ``(c, ch, na, nr)`` counts of a character
    after a context in accepted and rejected URLs, and ``(c, sa, ta, sr, tr)``
    totals and distinct followers of the context."""
    top = pairs(urls, order, "ok").groupBy("ctx", "ch").agg(
        F.sum(F.col("ok").cast("long")).alias("na"), F.sum((~F.col("ok")).cast("long")).alias("nr"))
    g = materialise(top.select("ch", "na", "nr", _suffixes().alias("s")).groupBy(F.col("s.c").alias("c"), "ch").agg(
        F.sum("na").alias("na"), F.sum("nr").alias("nr")), "url-grams")
    t = materialise(g.groupBy("c").agg(
        F.sum("na").alias("sa"), F.sum((F.col("na") > 0).cast("long")).alias("ta"),
        F.sum("nr").alias("sr"), F.sum((F.col("nr") > 0).cast("long")).alias("tr")), "url-contexts")
    return g, t


def likelihoods(wanted: DataFrame, model: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``ctx, ch, llr`` for every distinct ``wanted(ctx, ch)``: log P accepted - log P rejected."""
    g, t = model
    w = wanted.select("ctx", "ch").distinct()
    rows = w.select("ctx", "ch", _suffixes().alias("s")).select("ctx", "ch", "s.k", "s.c")
    rows = rows.join(t, "c", "left").join(g, ["c", "ch"], "left").na.fill(0, ["na", "nr", "sa", "ta", "sr", "tr"])
    steps = F.array_sort(F.collect_list(F.struct("k", "na", "nr", "sa", "ta", "sr", "tr")))

    def prob(n: str, total: str, kinds: str) -> Column:
        return F.aggregate(F.col("steps"), F.lit(1.0 / ALPHABET), lambda p, e: F.when(
            e[total] == 0, p).otherwise((e[n] + e[kinds] * p) / (e[total] + e[kinds])))

    rows = rows.groupBy("ctx", "ch").agg(steps.alias("steps"))
    return rows.select("ctx", "ch", (F.log(prob("na", "sa", "ta")) - F.log(prob("nr", "sr", "tr"))).alias("llr"))


def scores(urls: DataFrame, model: tuple[DataFrame, DataFrame], order: int = ORDER) -> DataFrame:
    """``url, score`` of distinct ``urls(url)``: mean ``llr`` per character (empty: no row)."""
    keyed = urls.select("url", F.unhex(F.md5("url")).alias("u"))
    p = pairs(keyed, order, "u")
    llr = small(materialise(likelihoods(p, model), "url-llr"), 64).withColumnsRenamed({"ctx": "l_ctx", "ch": "l_ch"})
    j = p.join(llr, (F.col("ctx") == F.col("l_ctx")) & (F.col("ch") == F.col("l_ch")))
    rated = j.groupBy("u").agg(F.round(F.avg("llr"), 9).alias("score"))
    return keyed.join(rated, "u").select("url", "score")


def calibrate(scored: DataFrame) -> float | None:
    """The cut for ``scored(score, ok)``; null without both classes. The work
    is one row per score bin."""
    b = scored.groupBy(F.floor(F.col("score") * BINS).alias("b")).agg(
        F.sum(F.col("ok").cast("long")).alias("a"), F.sum((~F.col("ok")).cast("long")).alias("r")).collect()
    n_a, n_r = sum(x["a"] for x in b), sum(x["r"] for x in b)
    if not n_a or not n_r:
        return None
    lost, held, best = 0, n_r, []
    for x in sorted(b, key=lambda x: x["b"]):  # cut at the lower edge of each bin
        best.append((lost * n_r + held * n_a, x["b"]))
        lost, held = lost + x["a"], held - x["r"]
    best.append((lost * n_r + held * n_a, max(x["b"] for x in b) + 1))
    least = min(best)[0]
    cuts = [c for e, c in best if e == least]
    return (min(cuts) + max(cuts)) / (2.0 * BINS)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, score`` of every row of
    ``pages(page_id, url)``; ``score`` is null where a rule decides."""
    u = F.col("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumns({"host": host(u), "path": path(u)})
    rows = rows.withColumn("r", best_rule(F.col("host"), F.col("path"), rules))
    urls = materialise(rows.groupBy(F.coalesce("url", F.lit("")).alias("url")).agg(
        F.first("r.verdict").alias("v")), "urls")
    judged = urls.filter("v is not null and url <> ''").select("url", (F.col("v") == "allow").alias("ok"))
    held = F.substring(F.md5("url"), 1, 1) < "3"
    model = train(judged.filter(~held), order)
    held_out = judged.filter(held).withColumnRenamed("url", "h_url")
    rated = materialise(scores(urls.filter("v is null").select("url").unionByName(
        held_out.select(F.col("h_url").alias("url"))), model, order), "url-scores")
    cut = calibrate(rated.join(held_out, F.col("url") == F.col("h_url")).select("score", "ok"))
    rated = rated.withColumnRenamed("url", "s_url")
    out = rows.join(rated, F.col("r").isNull() & (F.coalesce("url", F.lit("")) == F.col("s_url")), "left")
    score = F.when(F.col("r").isNull(), F.coalesce("score", F.lit(0.0)))
    own = F.lit("allow") if cut is None else F.when(score >= cut, "allow").otherwise("block")
    return out.select("page_id", "url", "host", "path", F.col("r.rule").alias("rule"),
                      F.coalesce("r.verdict", own).alias("verdict"), score.alias("score"))


def accepted(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """The judged pages that stay."""
    return judge(pages, rules, order).filter("verdict = 'allow'")
