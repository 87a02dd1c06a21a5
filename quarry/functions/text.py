"""Text scalar functions as JVM column expressions.

Each function takes and returns a ``Column``; nothing here leaves the JVM,
so every call stays inside whole-stage codegen (higher-order array functions
are evaluated in place). Patterns use explicit character classes so the same
pattern means the same thing to Java regex and to RE2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.config import (PUNCT_FROM, PUNCT_TO, STOPWORDS, SUBSCRIPT_DIGITS,
                           SUPERSCRIPT_DIGITS, WS_PATTERN, enclosed_number_map)

_ENCLOSED_CLASS = "[①-⓿❶-➓㉑-㉟㊱-㊿]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# T1
def lowercase(c) -> Column:
    return F.lower(_c(c))


# Enclosed / parenthesised number glyphs -> "(n)". One regexp_replace per
# number (all glyphs of that number in one class), only evaluated on rows that
# contain such a glyph at all.
def special_numbers(c) -> Column:
    c = _c(c)
    by_number: dict[str, list[str]] = {}
    for glyph, rep in enclosed_number_map().items():
        by_number.setdefault(rep, []).append(glyph)
    folded = c
    for rep, glyphs in by_number.items():
        folded = F.regexp_replace(folded, "[" + "".join(glyphs) + "]", rep.replace("$", "\\$"))
    return F.when(c.rlike(_ENCLOSED_CLASS), folded).otherwise(c)


def _script_digits(c: Column, digits: str) -> Column:
    # a run of script digits -> "^" + plain digits + " "
    cls = "[" + digits + "]"
    marked = F.regexp_replace(c, "(" + cls + "+)", "^$1 ")
    return F.translate(marked, digits, "0123456789")


# T3
def superscripts(c) -> Column:
    return _script_digits(_c(c), SUPERSCRIPT_DIGITS)


# T4 (the caret is also used for subscripts)
def subscripts(c) -> Column:
    return _script_digits(_c(c), SUBSCRIPT_DIGITS)


# T5: ',' and "'" deleted, the other ASCII punctuation -> space.
def strip_punctuation(c) -> Column:
    return F.translate(_c(c), PUNCT_FROM, PUNCT_TO)


# T6 (whitespace tokeniser; empties dropped)
def tokenize(c) -> Column:
    return F.filter(F.split(_c(c), WS_PATTERN), lambda w: w != "")


def is_kept_word(w: Column) -> Column:
    """T7 predicate: longer than one character and not a stop word."""
    return (F.length(w) > 1) & ~w.isin(STOPWORDS)


# T7 on an array of tokens
def drop_stopwords(arr) -> Column:
    return F.filter(_c(arr), is_kept_word)


def basic_tokens(text) -> Column:
    """The JVM-only 'basic' profile: T1, T5, T6, T7 -> array<string>."""
    return drop_stopwords(F.split(strip_punctuation(lowercase(text)), WS_PATTERN))


def raw_tokens(text) -> Column:
    """Front of the 'full' profile (T1, T2, T5, T6, first T7) -> array<string>.

    The remaining steps act one token at a time and run once per distinct
    token (see ``quarry.functions.vocab``).
    """
    return drop_stopwords(F.split(strip_punctuation(special_numbers(lowercase(text))), WS_PATTERN))


# S3: decode bytes as UTF-8 dropping undecodable sequences (each becomes
# U+FFFD, which is then removed; a genuine U+FFFD goes too).
def decode_utf8_dropping(c) -> Column:
    return F.replace(F.make_valid_utf8(_c(c).cast("string")), F.lit("\ufffd"), F.lit(""))


# Lines, splitting on the same breaks as str.splitlines (common ones).
LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"


def lines(c) -> Column:
    return F.split(_c(c), LINE_BREAK)


# First line that is not blank (unstripped); '' if none.
def title(c) -> Column:
    ls = F.filter(lines(c), lambda x: strip(x) != "")
    return F.coalesce(F.try_element_at(ls, F.lit(1)), F.lit(""))


# FIXED VALUES: the characters that str.strip() removes.
WS_CLASS = ("[\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
            "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
STRIP_WS = f"^{WS_CLASS}+|{WS_CLASS}+$"


def strip(c) -> Column:
    """Python-style strip() of Unicode whitespace."""
    return F.regexp_replace(_c(c), STRIP_WS, "")


# First paragraph after the title line.
def first_paragraph(text, title_col) -> Column:
    text, t = _c(text), _c(title_col)
    ls = lines(text)
    pos = F.array_position(ls, t)  # 1-based, 0 if absent
    after = F.slice(ls, F.greatest(pos + 1, F.lit(1)), F.greatest(F.size(ls), F.lit(1)))
    cands = F.filter(F.transform(after, strip), lambda x: (x != "") & (x != t))
    return F.coalesce(F.try_element_at(cands, F.lit(1)), t)


# Remove {{...}} and <...> (non-greedy, not across lines).
def scrub_markup(c) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(c), "\\{\\{[^\\n]*?\\}\\}", ""), "<[^\\n]*?>", "")


# Paragraphs split on a blank line, stripped, empties dropped.
def paragraphs(c) -> Column:
    return F.filter(F.transform(F.split(_c(c), "\\n\\n"), strip), lambda x: x != "")


# T17
def sha256_hex(c) -> Column:
    return F.sha2(_c(c), 256)


# text[s:e] on code points.
def span_slice(text, start, end) -> Column:
    return F.substring(_c(text), _c(start) + 1, _c(end) - _c(start))


# T19
def ln(c) -> Column:
    return F.log(_c(c))
