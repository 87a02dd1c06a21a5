"""Porter's suffix stemmer (T10) as rule tables over columns.

Every step is a table of rules (suffix, condition on what stands before it,
replacement); the longest suffix that a word ends in decides, and its condition
may then leave the word as it is. A step is one column expression made from its
table, and conditions read the word's shape: a string of ``c`` and ``v``, one
per character, in which measure m is the number of ``v``-to-``c`` changes.
``stemmed`` runs the steps over a column of words; it is meant for the distinct
words of a corpus.

Extensions to the 1980 rules: a pool of irregular forms; "ies"/"ied" keep the e
in four-letter words; final y becomes i only after a consonant that is not the
first letter; two-letter stems vowel + consonant count as short; "alli" is
reduced before the other step-2 rules; "fulli" -> "ful"; "logi" -> "log"
measures the stem with its l.

The expressions are SQL text that Spark and other engines read alike
(``steps``); only the shape differs by dialect.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: irregular forms and their stems.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing",
    "canning": "canning", "cannings": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# FIXED VALUES: suffixes and replacements of steps 2 to 4.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "entli": "ent",
    "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
         "iti", "ous", "ive", "ize")

VOWELS, OTHERS = "aeiou", "bcdfghjklmnpqrstvwxz0123456789"
#: Conditions on the shape ``{s}`` of a stem.
POSITIVE = "contains({s}, 'vc')"
ABOVE_ONE = "({s} <> '' AND regexp_replace({s}, '^c*v+c+v+c.*$', '') = '')"
WITH_VOWEL = "contains({s}, 'v')"


def ends(word: str, suffix: str) -> str:
    return f"right({word}, {len(suffix)}) = '{suffix}'"


def before(text: str, n: int, word: str = "w") -> str:
    """``text`` (a word or its shape) without the last ``n`` characters of ``word``."""
    return f"left({text}, length({word}) - {n})"


def short(word: str, shape: str) -> str:
    return (f"((length({word}) = 2 AND {shape} = 'vc') OR (length({word}) > 2 AND right({shape}, 3) = 'cvc' "
            f"AND right({word}, 1) NOT IN ('w', 'x', 'y')))")


def table(rules: dict[str, str], condition: Callable[[str], str], other: str = "w") -> str:
    """The step of a rule table: longest suffix first, replaced if its condition holds."""
    cases = [f"WHEN {ends('w', x)} THEN CASE WHEN {condition(x)} THEN {before('w', len(x))} || {to} ELSE w END"
             for x, to in sorted(rules.items(), key=lambda r: -len(r[0]))]
    return f"CASE {' '.join(cases)} ELSE {other} END"


def _on_stem(condition: str) -> Callable[[str], str]:
    return lambda x: condition.format(s=before("s", len(x)))


def _quoted(rules: dict[str, str]) -> dict[str, str]:
    return {k: f"'{v}'" for k, v in rules.items()}


def steps() -> list[dict[str, str]]:
    """Expressions in order; each maps columns to expressions over ``w`` and its shape ``s``."""
    ie = "CASE WHEN length(w) = 4 THEN 'ie' ELSE 'i' END"
    cut = (f"CASE WHEN right(w, 3) IN ('ied', 'eed') THEN NULL "
           f"WHEN {ends('w', 'ed')} AND {WITH_VOWEL.format(s=before('s', 2))} THEN {before('w', 2)} "
           f"WHEN {ends('w', 'ing')} AND {WITH_VOWEL.format(s=before('s', 3))} THEN {before('w', 3)} END")
    cs = "left(s, length(cut))"
    uncut = table({"ied": ie, "eed": "'ee'"}, lambda x: "TRUE" if x == "ied" else POSITIVE.format(s=before("s", 3)))
    once = f"({POSITIVE.format(s=cs)} AND NOT {ABOVE_ONE.format(s=cs)})"
    mended = (f"CASE WHEN cut IS NULL THEN {uncut} WHEN right(cut, 2) IN ('at', 'bl', 'iz') THEN cut || 'e' "
              f"WHEN length(cut) > 1 AND right(cut, 1) = left(right(cut, 2), 1) AND right({cs}, 1) = 'c' THEN "
              f"CASE WHEN right(cut, 1) IN ('l', 's', 'z') THEN cut ELSE left(cut, length(cut) - 1) END "
              f"WHEN {once} AND {short('cut', cs)} THEN cut || 'e' ELSE cut END")
    y = f"CASE WHEN length(w) > 2 AND {ends('w', 'y')} AND left(right(s, 2), 1) = 'c' THEN {before('w', 1)} || 'i' ELSE w END"
    alli = f"CASE WHEN {ends('w', 'alli')} AND {POSITIVE.format(s=before('s', 4))} THEN {before('w', 2)} ELSE w END"
    logi = f"WHEN {ends('w', 'logi')} THEN CASE WHEN {POSITIVE.format(s=before('s', 3))} THEN {before('w', 1)} ELSE w END"
    second = f"CASE {logi} ELSE {table(_quoted(STEP2), _on_stem(POSITIVE))} END"

    def fourth(x: str) -> str:
        high = ABOVE_ONE.format(s=before("s", len(x)))
        return high if x != "ion" else f"{high} AND right({before('w', 3)}, 1) IN ('s', 't')"

    stem, shape = before("w", 1), before("s", 1)
    last_e = (f"CASE WHEN {ends('w', 'e')} AND ({ABOVE_ONE.format(s=shape)} OR ({POSITIVE.format(s=shape)} AND NOT "
              f"{short(f'({stem})', f'({shape})')})) THEN {stem} ELSE w END")
    last_l = f"CASE WHEN {ends('w', 'll')} AND {ABOVE_ONE.format(s=shape)} THEN {stem} ELSE w END"
    return [
        {"w": table({"sses": "'ss'", "ies": ie, "ss": "'ss'", "s": "''"}, lambda x: "TRUE")},
        {"cut": cut}, {"w": mended}, {"w": y}, {"w": alli}, {"w": second},
        {"w": table(_quoted(STEP3), _on_stem(POSITIVE))},
        {"w": table({x: "''" for x in STEP4}, fourth)}, {"w": last_e}, {"w": last_l},
    ]


def whole(word: str, stem: str) -> str:
    """Irregular forms and words of one or two letters are not stemmed."""
    pool = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR.items())
    return f"CASE WHEN length({word}) < 3 THEN {word} ELSE CASE {word} {pool} ELSE {stem} END END"


def shape(word: Column) -> Column:
    """``c``/``v`` per character: y is a consonant at the start and after a vowel."""
    def classes(runs):
        def run(r, i):
            after_c = (i > 0) & ~F.right(F.get(runs, i - 1), F.lit(1)).isin(*"aeiou")
            ys = F.substring(F.repeat(F.when(after_c, "vc").otherwise("cv"), F.length(r)), F.lit(1), F.length(r))
            return F.when(r.startswith("y"), ys).otherwise(
                F.translate(F.regexp_replace(r, "[^aeiou]", "."), "aeiou.", "vvvvvc"))
        return F.array_join(F.transform(runs, run), "")
    runs = F.regexp_extract_all(word, F.lit("[^y]+|y+"), F.lit(0))
    general = F.element_at(F.transform(F.array(runs), classes), 1)
    # without y, and of letters and digits only, a word needs no runs
    return F.when(word.rlike(f"[^{VOWELS}{OTHERS}]"), general).otherwise(
        F.translate(word, VOWELS + OTHERS, "v" * len(VOWELS) + "c" * len(OTHERS)))


def native(sql: str) -> str:
    """The same expression with Spark's test of an ending, which makes no substring."""
    return re.sub(r"right\((\w+), (\d+)\) = '(\w*)'",
                  lambda m: f"endswith({m[1]}, '{m[3]}')" if len(m[3]) == int(m[2]) else m[0], sql)


def stemmed(words: DataFrame, col: str) -> DataFrame:
    """``words`` with column ``col`` replaced by its stem."""
    rest = [c for c in words.columns if c != col]
    df = words.select(*[F.col(c).alias(f"_{c}") for c in rest], F.col(col).alias("o"), F.col(col).alias("w"))
    for i, step in enumerate(steps()):
        # a word that the step before left as it was keeps its shape
        s = shape(F.col("w")) if i == 0 else F.when(F.col("w") == F.col("p"), F.col("s")).otherwise(shape(F.col("w")))
        df = df.withColumn("s", s).withColumns({"p": F.col("w")} | {k: F.expr(native(v)) for k, v in step.items()})
    return df.select(*[F.col(f"_{c}").alias(c) for c in rest], F.expr(whole("o", "w")).alias(col))
