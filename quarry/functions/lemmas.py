"""Noun lemmas as a table (T9): an exception list and detachment rules.

No lexical database ships here, so the words that are given act as the
lexicon: a rule's result counts only if it is one of them. An exception decides; else
the shortest of the results and the word itself (then the first in order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: irregular plurals, and noun endings with what replaces them.
EXCEPTIONS = {
    "children": "child", "feet": "foot", "geese": "goose", "lice": "louse", "men": "man", "mice": "mouse",
    "oxen": "ox", "teeth": "tooth", "women": "woman", "wives": "wife", "knives": "knife", "lives": "life",
    "indices": "index", "matrices": "matrix", "vertices": "vertex", "criteria": "criterion", "phenomena": "phenomenon",
}
RULES = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
         ("men", "man"), ("ies", "y"))


def noun_lemmas(words: DataFrame) -> DataFrame:
    """``word, lemma`` for every distinct word of ``words(word)``.

    Words of up to two letters and words in "ss" have no plural to detach.
    Both joins are on the word, between vocabulary-sized tables.
    """
    words = words.select("word").distinct()
    cands = F.filter(F.array(*[
        F.when(F.col("word").endswith(a), F.concat(F.expr(f"left(word, length(word) - {len(a)})"), F.lit(b))) for a, b in RULES]),
        lambda c: c.isNotNull() & (c != ""))
    regular = words.filter((F.length("word") > 2) & ~F.col("word").endswith("ss")).select("word", F.explode(cands).alias("cand"))
    known = words.select(F.col("word").alias("k"))
    regular = regular.join(known, F.col("cand") == F.col("k"), "left_semi")
    odd = F.create_map(*[F.lit(x) for pair in EXCEPTIONS.items() for x in pair])
    every = words.select("word", F.lit(1).alias("p"), F.col("word").alias("cand")).unionByName(
        regular.select("word", F.lit(1).alias("p"), "cand")).unionByName(
        words.select("word", F.lit(0).alias("p"), F.try_element_at(odd, F.col("word")).alias("cand")).filter("cand is not null"))
    best = every.groupBy("word").agg(F.min(F.struct("p", F.length("cand").alias("n"), "cand")).alias("b"))
    return best.select("word", F.col("b.cand").alias("lemma"))
