"""Quality rules with cross-document line frequency.

Base signals are taken from each whole text in Arrow batches. Then every line is
normalised (A-Z lower-cased, white-space runs to one space, ends trimmed) and hashed (128 bits), and the distinct documents of a host that
have it are counted. Lines of more documents than the host's limit, the larger
of ``max_docs`` and ``max_share`` of its documents, are boilerplate: they are
removed, and a document that has lost lines is rejected as depleted when fewer
than ``min_left_words`` words or less than ``min_left_share`` of its words are
left.

Documents of a host with the same text are one document, so a page that was
fetched a thousand times makes no line frequent. A hot host or line is spread:
the distinct step groups by (host, line, document), the counts are partial/final
sums, and only lines above the limit meet the documents again, broadcast while
their measured size allows.

Defined cases: a null text has no words and fails the base rules, as does an
empty one; lines without a word are never counted or removed; rows with a null
host form one host; repeated rows get the same verdict each; an empty table
gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.llm.common import BROADCAST_BYTES, ascii_lower, materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCS = 20
MAX_SHARE = 0.01
MIN_LEFT_WORDS = 25
MIN_LEFT_SHARE = 0.5

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SIGNALS = StructType([StructField(n, LongType()) for n in _NAMES])


def repeat_words(words: list[str], n: int = 3) -> int:
    """Words inside ``n``-word windows that occur at least twice."""
    if len(words) <= n:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code = ids
    for k in range(1, n):  # windows of k + 1 words, renumbered so that codes never overflow
        code = np.unique(code[:-1] * len(number) + ids[k:], return_inverse=True)[1]
    twice = np.bincount(code)[code] > 1
    hit = np.zeros(len(words), bool)
    for k in range(n):
        hit[k:k + len(twice)] |= twice
    return int(hit.sum())


def text_signals(text: str | None) -> tuple[int, int, int, int, int]:
    words = _WORD.findall(text or "")
    if not words:
        return 0, 0, len(_SYMBOL.findall(text or "")), 0, 0
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return (len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), len(lines) - len(set(lines)),
            repeat_words(words))


@F.pandas_udf(_SIGNALS)
def _signals(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_signals(t) for t in texts], columns=_NAMES)


def _inputs(docs: DataFrame, host: str) -> DataFrame:
    text = F.col("text").cast("string")
    name = F.col(host).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.when(name.isNull(), "").otherwise(F.concat(F.lit("h"), name)).alias("host"),
                       text.alias("text"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("d"))


def normalised(line: Column) -> Column:
    return ascii_lower(F.trim(F.regexp_replace(line, _SPACE, " ")))


def _lines(src: DataFrame) -> DataFrame:
    """``host, d, pos, line, n``: every line with a word, normalised, and its words."""
    cut = src.select("host", "d", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "raw"))
    rows = cut.select("host", "d", "pos", normalised(F.col("raw")).alias("line")).filter(F.col("line") != "")
    return rows.select("host", "d", "pos", F.unhex(F.md5("line")).alias("line"),
                       F.size(F.split("line", " ")).alias("n"))


def _line_docs(src: DataFrame) -> DataFrame:
    """``host, line, d``: one row per host, line and document."""
    return _lines(src).select("host", "line", "d").distinct()


def _limited(lines: DataFrame, hosts: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """``host, line, n_docs`` of the lines above their host's limit."""
    n = lines.groupBy("host", "line").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > max_docs)
    return n.join(hosts, "host").filter(F.col("n_docs") > F.col("host_docs") * max_share).select("host", "line", "n_docs")


def _bounded(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` written, with a broadcast hint while rows x ``row_bytes`` is within the bound."""
    df = materialise(df, "line-side")
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _host_docs(base: DataFrame) -> DataFrame:
    return base.select("host", "d").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))


def frequent_lines(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS,
                   max_share: float = MAX_SHARE) -> DataFrame:
    """``host, line, n_docs``: the boilerplate lines, as MD5 of their normal form."""
    src = _inputs(docs, host)
    return _limited(_line_docs(src), _host_docs(src), max_docs, max_share)


def judge(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE,
          min_left_words: int = MIN_LEFT_WORDS, min_left_share: float = MIN_LEFT_SHARE) -> DataFrame:
    """Per row: the base signals, ``removed_words``, ``base_failed``, ``depleted`` and ``kept``."""
    src = _inputs(docs, host)
    base = materialise(src.withColumn("s", _signals("text")).select("doc_id", "host", "d", "s.*"), "line-signals")
    bad = _bounded(_limited(_line_docs(src), _bounded(_host_docs(base), 96), max_docs, max_share).select("host", "line"), 96)
    hit = _lines(src).join(bad, ["host", "line"]).groupBy("host", "d", "pos").agg(F.max("n").alias("n"))
    gone = _bounded(hit.groupBy("host", "d").agg(F.sum("n").alias("removed_words")), 96)
    j = base.join(gone, ["host", "d"], "left").withColumn(
        "removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("removed_words") > 0) & ((left < min_left_words) | (left < min_left_share * F.col("n_words")))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words",
                    failed.alias("base_failed"), depleted.alias("depleted"), (~failed & ~depleted).alias("kept"))


def remove_lines(docs: DataFrame, bad: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id, text`` of every row without the lines listed in ``bad``."""
    src = _inputs(docs, host)
    hit = _lines(src).join(_bounded(bad.select("host", "line"), 96), ["host", "line"])
    gone = _bounded(hit.groupBy("host", "d").agg(F.collect_set("pos").alias("gone")), 256)
    j = src.join(gone, ["host", "d"], "left")
    at = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    flagged = F.filter(at, lambda s: ~F.array_contains("gone", s["i"]))
    return j.select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(flagged, lambda s: s["x"]), "\n")).alias("text"))
