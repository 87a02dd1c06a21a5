"""Word tokeniser with contractions, quotes and ends of sentences.

An ordered cascade of regular expressions over the text, the rules of the
Penn Treebank tokeniser as commonly used for English, as column expressions
only. White space becomes one space, each sentence a line; the rules put spaces
around what is a token of its own, and a split on them ends it.

A sentence ends at ``.``, ``?`` or ``!`` (and closing quotes or brackets)
before white space and an upper-case letter, a digit or an opening sign; no
trained list of abbreviations is used. Word characters beside an apostrophe are
the ASCII ones. Null text gives null, text without words an empty array.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import WS_CLASS

#: (pattern, replacement): white space, then the sentences as lines.
SENTENCES = [
    (WS_CLASS + "+", " "),
    (r"""([.?!]["')\]}»”’]*) ([\p{Lu}\p{Nd}"'(\[«“‘])""", "$1\n$2"),
]
# FIXED VALUES: the tokeniser's rules, in their order.
RULES = [
    # opening quotes
    ("([«“‘„]|[`]+)", " $1 "),
    ('(?m)^"', "`` "),
    ("(``)", " $1 "),
    (r"""([ (\[{<])("|'{2})""", "$1 `` "),
    (r"'([a-ce-lo-ru-zA-CE-LO-RU-Z0-9_])\b", "' $1"),
    # punctuation
    (r"""(?m)([^.\n])(\.)([\])}>"'»”’ ]*)$""", "$1 $2 $3 "),
    (r"([:,])([^0-9])", " $1 $2"),
    (r"(?m)([:,])$", " $1 "),
    (r"(\.{2,})", " $1 "),
    ("([;@#$%&])", " $1 "),
    ("([?!])", " $1 "),
    ("([^'])' ", "$1 ' "),
    # brackets and dashes
    (r"([\]\[\(\)\{\}<>])", " $1 "),
    ("--", " -- "),
    # every line between spaces, for the rules below
    ("(?m)^", " "),
    ("(?m)$", " "),
    # closing quotes and clitics
    ("([»”’])", " $1 "),
    ("''", " '' "),
    ('"', " '' "),
    ("([^' ])('[sS]|'[mM]|'[dD]|') ", "$1 $2 "),
    ("([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
    # contractions
    (r"(?i)\b(can)(not)\b", " $1 $2 "),
    (r"(?i)\b(d)('ye)\b", " $1 $2 "),
    (r"(?i)\b(gim)(me)\b", " $1 $2 "),
    (r"(?i)\b(gon)(na)\b", " $1 $2 "),
    (r"(?i)\b(got)(ta)\b", " $1 $2 "),
    (r"(?i)\b(lem)(me)\b", " $1 $2 "),
    (r"(?i)\b(more)('n)\b", " $1 $2 "),
    (r"(?i)\b(wan)(na) ", " $1 $2 "),
    (r"(?i) ('t)(is)\b", " $1 $2 "),
    (r"(?i) ('t)(was)\b", " $1 $2 "),
]


#: What a text must hold, one of them, for a rule to find anything; rules that are not
#: named here look at every text. Contractions (``CONTRACTED``) are sought in lower case.
NEEDS = {
    "([«“‘„]|[`]+)": "«“‘„`", '(?m)^"': '"', "(``)": ["``"], r"""([ (\[{<])("|'{2})""": ['"', "''"],
    r"'([a-ce-lo-ru-zA-CE-LO-RU-Z0-9_])\b": "'", r"(\.{2,})": [".."], "([;@#$%&])": ";@#$%&", "([?!])": "?!",
    "([^'])' ": ["' "], r"([\]\[\(\)\{\}<>])": "][(){}<>", "--": ["--"], "([»”’])": "»”’", "''": ["''"], '"': '"',
    "([^' ])('[sS]|'[mM]|'[dD]|') ": "'", "([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ": "'",
}
#: Rules about the ends of lines, which are line feeds by then, without a regular expression.
PLAIN = {
    "(?m)^": lambda x: F.concat(F.lit(" "), F.replace(x, F.lit("\n"), F.lit("\n "))),
    "(?m)$": lambda x: F.concat(F.replace(x, F.lit("\n"), F.lit(" \n")), F.lit(" ")),
}
CONTRACTED = ("cannot", "d'ye", "gimme", "gonna", "gotta", "lemme", "more'n", "wanna ", " 'tis", " 'twas")


def _if_any(c: Column, parts, then: Callable[[Column], Column], look=lambda x: x) -> Column:
    """``then(c)`` where ``look(c)`` holds one of ``parts``, else ``c``; ``c`` is computed once."""
    def one(x):
        return F.when(reduce(or_, [F.contains(look(x), F.lit(p)) for p in parts]), then(x)).otherwise(x)
    return F.element_at(F.transform(F.array(c), one), 1)


def _apply(c: Column, rules) -> Column:
    for pattern, by in rules:
        if pattern in PLAIN:
            c = PLAIN[pattern](c)
        elif pattern == "(?m)([:,])$":
            c = _if_any(c, [":\n", ",\n"], lambda x, p=pattern, b=by: F.regexp_replace(x, p, b), lambda x: F.concat(x, F.lit("\n")))
        elif pattern in NEEDS:
            c = _if_any(c, NEEDS[pattern], lambda x, p=pattern, b=by: F.regexp_replace(x, p, b))
        else:
            c = F.regexp_replace(c, pattern, by)
    return c


def word_tokenize(text) -> Column:
    """The tokens of ``text`` in order, an array of strings."""
    c = F.col(text) if isinstance(text, str) else text
    first = next(i for i, (pattern, _) in enumerate(RULES) if "(can)(not)" in pattern)
    c = _apply(c, SENTENCES + RULES[:first])
    c = _if_any(c, CONTRACTED, lambda x: _apply(x, RULES[first:]), F.lower)
    return F.filter(F.split(c, "[ \n]+"), lambda w: w != "")
