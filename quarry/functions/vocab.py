"""Vocabulary map of the 'full' normalisation profile (U2; T3, T4, T6, T8-T10).

After lowercasing, glyph folding, punctuation removal and the first stop-word
pass, every later step acts on one token at a time, so it is done once per
*distinct raw token* of the corpus, as a chain of column expressions:

    superscripts, subscripts -> words -> numbers -> lemmas -> stems
      -> punctuation, words -> numbers -> stems -> punctuation, words -> stop words

The map has one row per token with the words it becomes. It can be kept as a
stored build: a run maps only the tokens that are not in it and appends them.
Documents then join it by token.

The lemmatiser is a table (``word, lemma``); no lexical database ships here, so
by default words pass through unchanged.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.numwords import spelt
from quarry.functions.stemmer import stemmed
from quarry.sources import builds

# FIXED VALUES: single-word contractions the tokenizer splits in two.
CONTRACTIONS = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}
# Digits of the New Tai Lue script: tokens made of them are dropped.
TAI_LUE_DIGITS = range(0x19D0, 0x19DA)
#: White space between words, as Unicode has it.
SPACES = "[\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+".encode().decode("unicode_escape")


@lru_cache(maxsize=1)
def digits() -> tuple[str, str, str]:
    """All decimal digits, their ASCII forms, and all characters that count as digits."""
    decimal, ascii_, other = [], [], []
    for i in range(0x110000):
        c = chr(i)
        if c.isdigit():
            value = unicodedata.decimal(c, None)
            if value is None:
                other.append(c)
            else:
                decimal.append(c)
                ascii_.append(str(value))
    return "".join(decimal), "".join(ascii_), "".join(decimal + other)


def split_words(c: Column) -> Column:
    """Words between white space, without trailing commas, contractions split."""
    words = F.filter(F.transform(F.split(c, SPACES), lambda w: F.rtrim(w, F.lit(","))), lambda w: w != "")
    known = F.create_map(*[x for k, v in CONTRACTIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.flatten(F.transform(words, lambda w: F.coalesce(F.try_element_at(known, w), F.array(w))))


def number_words(w: Column) -> Column:
    """A word of decimal digits spelt out; words with Tai Lue digits among digits go; others stay."""
    decimal, ascii_, every = digits()
    tai_lue = "[" + "".join(map(chr, TAI_LUE_DIGITS)) + "]"
    # no digit is a letter: a word that begins with one needs no look at the long classes
    return (F.when(w.rlike("^\\p{L}"), F.array(w))
             .when(w.rlike(f"^[{every}]*{tai_lue}[{every}]*$"), F.array().cast("array<string>"))
             .when(w.rlike(f"^[{decimal}]+$"), split_words(spelt(F.translate(w, decimal, ascii_))))
             .otherwise(F.array(w)))


def _lemmas(df: DataFrame, lemmas: DataFrame | None) -> DataFrame:
    if lemmas is None:
        return df
    table = lemmas.select(F.col("word").alias("w"), "lemma")
    return df.join(table, "w", "left").select("token", F.coalesce("lemma", "w").alias("w"))


def normal_words(vocabulary: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """``token, word``: the words of each of the (distinct) tokens, one row each."""
    w = F.col("w")
    df = vocabulary.select("token", F.explode(split_words(T.subscripts(T.superscripts("token")))).alias("w"))
    df = stemmed(_lemmas(df.select("token", F.explode(number_words(w)).alias("w")), lemmas), "w")
    df = df.select("token", F.explode(split_words(T.strip_punctuation("w"))).alias("w"))
    df = stemmed(df.select("token", F.explode(number_words(w)).alias("w")), "w")
    df = df.select("token", F.explode(split_words(T.strip_punctuation("w"))).alias("word"))
    return df.filter(T.is_kept_word(F.col("word")))


def vocabulary_map(raw_tokens: DataFrame, token_col: str = "token", lemmas: DataFrame | None = None) -> DataFrame:
    """``token, words``: each distinct raw token and the words it becomes (sorted, repeats kept)."""
    vocab = raw_tokens.select(F.col(token_col).alias("token")).distinct()
    words = normal_words(vocab, lemmas).groupBy("token").agg(F.sort_array(F.collect_list("word")).alias("words"))
    return vocab.join(words, "token", "left").select(
        "token", F.coalesce("words", F.array().cast("array<string>")).alias("words"))


def update_map(raw_tokens: DataFrame, path: str, token_col: str = "token", lemmas: DataFrame | None = None) -> int:
    """Bring the stored map at ``path`` up to date; returns how many tokens were new."""
    spark = raw_tokens.sparkSession
    new = raw_tokens.select(F.col(token_col).alias("token")).distinct()
    if builds.is_complete(spark, path):
        new = new.join(builds.read_build(spark, path), "token", "left_anti")
    return builds.append_part(vocabulary_map(new, "token", lemmas), path)


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """``token, words`` of a stored map that holds at least one token."""
    return builds.read_build(spark, path)


def token_counts(raw: DataFrame, keys: list[str], raw_col: str = "raw") -> DataFrame:
    """``keys..., token, rtf`` from raw token arrays."""
    return (raw.select(*keys, F.explode(raw_col).alias("token"))
               .groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("rtf")))


def mapped_terms(counts: DataFrame, keys: list[str], words: DataFrame) -> DataFrame:
    """``keys..., word, tf`` from token counts and a vocabulary map."""
    rows = counts.join(words, "token").select(*keys, "rtf", F.explode("words").alias("word"))
    return rows.groupBy(*keys, "word").agg(F.sum("rtf").alias("tf"))


def full_terms(raw: DataFrame, keys: list[str], raw_col: str = "raw", lemmas: DataFrame | None = None) -> DataFrame:
    """``keys..., word, tf`` for the full profile from raw token arrays."""
    counts = token_counts(raw, keys, raw_col)
    return mapped_terms(counts, keys, vocabulary_map(counts, "token", lemmas))


def normalise_token_arrays(raw: DataFrame, raw_col: str, keep: list[str], lemmas: DataFrame | None = None) -> DataFrame:
    """Per row: ``keep..., tokens`` (word multiset as an array) for the full profile.

    Used for small inputs (query batches); corpus-scale builds use
    ``full_terms`` and never rebuild per-document arrays.
    """
    t = full_terms(raw, keep, raw_col, lemmas)
    arr = t.groupBy(*keep).agg(
        F.flatten(F.collect_list(F.array_repeat("word", F.col("tf").cast("int")))).alias("tokens"))
    return raw.select(*keep).join(arr, keep, "left").select(
        *keep, F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
