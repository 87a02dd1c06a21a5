"""English cardinal numbers in words (T8, short scale) as column expressions:
1234 -> "one thousand, two hundred and thirty-four".

The digits are cut into groups of three from the right; each group is spelt from
the tables of units and tens and named from the table of scales, and the groups
are put together in order. Tens and units are joined by a hyphen; a last group
below one hundred is attached with " and ", any other with ", ". Scale names
are built from the Latin prefixes up to 10^303 (centillion); longer digit
strings are spelt in pieces of 306 digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: English number names and Latin scale prefixes.
ONES = ("zero one two three four five six seven eight nine ten eleven twelve thirteen "
        "fourteen fifteen sixteen seventeen eighteen nineteen").split()
TENS = "_ _ twenty thirty forty fifty sixty seventy eighty ninety".split()
SMALL_SCALES = ("thousand", "million", "billion", "trillion", "quadrillion", "quintillion",
                "sextillion", "septillion", "octillion", "nonillion")
SCALE_UNITS = ("", "un", "duo", "tre", "quattuor", "quin", "sex", "sept", "octo", "novem")
SCALE_TENS = ("dec", "vigint", "trigint", "quadragint", "quinquagint", "sexagint",
              "septuagint", "octogint", "nonagint")

MAX_DIGITS = 306


def scale_name(k: int) -> str:
    """Name of 10^(3k), k >= 1."""
    if k <= len(SMALL_SCALES):
        return SMALL_SCALES[k - 1]
    if k == 101:
        return "centillion"
    i = k - 11  # 10^33 = decillion is i = 0
    return SCALE_UNITS[i % 10] + SCALE_TENS[i // 10] + "illion"


#: What follows a group by its number from the right.
SCALES = [""] + [" " + scale_name(k) for k in range(1, MAX_DIGITS // 3)]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _pick(names: list[str], at: Column) -> Column:
    return F.get(F.array(*map(F.lit, names)), at)


def _below_hundred(n: Column) -> Column:
    unit = F.when(n % 10 > 0, F.concat(F.lit("-"), _pick(ONES, n % 10))).otherwise("")
    return F.when(n < 20, _pick(ONES, n)).otherwise(F.concat(_pick(TENS, F.floor(n / 10).cast("int")), unit))


def _below_thousand(n: Column) -> Column:
    rest = n % 100
    hundreds = F.concat(_pick(ONES, F.floor(n / 100).cast("int")), F.lit(" hundred"),
                        F.when(rest > 0, F.concat(F.lit(" and "), _below_hundred(rest))).otherwise(""))
    return F.when(n < 100, _below_hundred(n)).otherwise(hundreds)


def _numbered(length: Column, step: int) -> Column:
    return F.sequence(F.lit(0), F.ceil(length / step).cast("int") - 1)


def _piece(digits: Column) -> Column:
    """A number of at most 306 digits, without leading zeros, in words."""
    width = (F.ceil(F.length(digits) / 3) * 3).cast("int")

    def groups(padded):
        each = F.transform(_numbered(F.length(padded), 3), lambda i: F.struct(
            F.substring(padded, i * 3 + 1, F.lit(3)).cast("int").alias("n"),
            ((F.length(padded) / 3).cast("int") - 1 - i).alias("k")))
        return F.filter(each, lambda g: g["n"] > 0)

    def joined(g, i):
        link = F.when(i == 0, "").when((g["k"] == 0) & (g["n"] < 100), " and ").otherwise(", ")
        return F.concat(link, _below_thousand(g["n"]), _pick(SCALES, g["k"]))

    words = _let(F.lpad(digits, width, F.lit("0")), groups)
    return F.when(digits == "", "zero").otherwise(F.array_join(F.transform(words, joined), ""))


def spelt(digits: Column) -> Column:
    """A string of ASCII digits in words."""
    def pieces(d):
        cut = F.transform(_numbered(F.length(d), MAX_DIGITS),
                          lambda i: F.substring(d, i * MAX_DIGITS + 1, F.lit(MAX_DIGITS)))
        return F.array_join(F.transform(cut, lambda p: _let(F.ltrim(p, F.lit("0")), _piece)), " ")
    return _let(digits, pieces)


def spelt_sql(digits: str) -> str:
    """The same in DuckDB SQL."""
    def names(xs, at):
        return f"[{', '.join(repr(x) for x in xs)}][({at}) + 1]"

    def below_hundred(n):
        return (f"CASE WHEN {n} < 20 THEN {names(ONES, n)} ELSE {names(TENS, f'{n} // 10')} || "
                f"CASE WHEN {n} % 10 > 0 THEN '-' || {names(ONES, f'{n} % 10')} ELSE '' END END")

    def below_thousand(n):
        return (f"CASE WHEN {n} < 100 THEN {below_hundred(n)} ELSE {names(ONES, f'{n} // 100')} || ' hundred' || "
                f"CASE WHEN {n} % 100 > 0 THEN ' and ' || {below_hundred(f'({n} % 100)')} ELSE '' END END")

    piece = f"""CASE WHEN ltrim(p, '0') = '' THEN 'zero' ELSE array_to_string(list_transform(
      list_filter(list_transform(range(CAST(ceil(length(ltrim(p, '0')) / 3) AS INTEGER)), lambda i: {{
        'k': CAST(ceil(length(ltrim(p, '0')) / 3) AS INTEGER) - 1 - i,
        'n': TRY_CAST(substr(lpad(ltrim(p, '0'), CAST(ceil(length(ltrim(p, '0')) / 3) AS INTEGER) * 3, '0'), CAST(i * 3 + 1 AS BIGINT), 3) AS INTEGER)}}),
        lambda g: g.n > 0),
      lambda g, j: CASE WHEN j = 1 THEN '' WHEN g.k = 0 AND g.n < 100 THEN ' and ' ELSE ', ' END
        || {below_thousand('g.n')} || {names(SCALES, 'g.k')}), '') END"""
    return (f"array_to_string(list_transform(list_transform(range(CAST(ceil(length({digits}) / {MAX_DIGITS}) AS INTEGER)), "
            f"lambda i: substr({digits}, CAST(i * {MAX_DIGITS} + 1 AS BIGINT), {MAX_DIGITS})), lambda p: {piece}), ' ')")
