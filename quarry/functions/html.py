"""HTML to text (S4) and link extraction.

Two variants:

* ``html_to_text``: a JVM chain of ``regexp_replace`` calls — drop script and
  style blocks and comments, drop tags (no separator, like concatenating the
  text nodes), decode character references (numeric, and the HTML 4 names). Stays in codegen.
* ``html_to_text_parser``: an Arrow-batched pandas UDF over the standard
  library ``html.parser`` (full entity decoding, malformed markup), for
  when fidelity matters more than speed.
"""

from __future__ import annotations

from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# FIXED VALUES: regular expressions of the markup that carries no text.
SCRIPT_BLOCK = "(?is)<script[^>]*>.*?</script[ \\t\\n\\r]*>"
STYLE_BLOCK = "(?is)<style[^>]*>.*?</style[ \\t\\n\\r]*>"
COMMENT = "(?s)<!--.*?-->"
TAG = "<[^>]*>"
HREF = "(?i)\\bhref[ \\t\\n\\r]*=[ \\t\\n\\r]*(\"[^\"]*\"|'[^']*')"
TITLE = "(?is)<title[^>]*>(.*?)</title>"
# A character reference, decimal, hexadecimal or named.
REFERENCE = "&(?:#[0-9]{1,6}|#[xX][0-9a-fA-F]{1,5}|[a-zA-Z][a-zA-Z0-9]*);"
# ``&name;`` -> character for the HTML 4 names, from the standard library's table.
ENTITIES = {f"&{name};": chr(code) for name, code in sorted(name2codepoint.items())} | {"&apos;": "'"}


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def decode_entities(c) -> Column:
    """Every reference decoded once ("&amp;lt;" gives "&lt;"); unknown names stay."""
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def one(e: Column) -> Column:
        hexa = F.lower(F.substring(e, 3, 1)) == "x"
        digits = F.when(hexa, F.substring(e, F.lit(4), F.length(e) - 4)).otherwise(
            F.conv(F.substring(e, F.lit(3), F.length(e) - 3), 10, 16))
        char = F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")
        return F.when(F.substring(e, 2, 1) == "#", char).otherwise(F.coalesce(F.try_element_at(names, e), e))

    parts = F.split(_c(c), REFERENCE, -1)
    found = F.transform(F.regexp_extract_all(_c(c), F.lit(REFERENCE), F.lit(0)), one)
    return F.array_join(F.zip_with(parts, F.concat(found, F.array(F.lit(""))), lambda p, e: F.concat(p, e)), "")


def strip_markup(c) -> Column:
    out = _c(c)
    for pat in (SCRIPT_BLOCK, STYLE_BLOCK, COMMENT, TAG):
        out = F.regexp_replace(out, pat, "")
    return out


def html_to_text(c) -> Column:
    return decode_entities(strip_markup(c))


def html_title(c) -> Column:
    return decode_entities(F.regexp_extract(_c(c), TITLE, 1))


def hrefs(c) -> Column:
    """Every quoted ``href`` value in document order."""
    return F.transform(F.regexp_extract_all(_c(c), F.lit(HREF), 1), lambda x: F.substring(x, F.lit(2), F.length(x) - 2))


def _parse_text(html: str) -> str:
    from html.parser import HTMLParser

    class _P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.skip = [], 0

        def handle_starttag(self, tag, attrs):
            if tag in ("script", "style", "template"):
                self.skip += 1

        def handle_endtag(self, tag):
            if tag in ("script", "style", "template") and self.skip:
                self.skip -= 1

        def handle_data(self, data):
            if not self.skip:
                self.out.append(data)

    p = _P()
    p.feed(html)
    p.close()
    return "".join(p.out)


@F.pandas_udf(StringType())
def html_to_text_parser(html: pd.Series) -> pd.Series:
    return html.map(lambda h: None if h is None else _parse_text(h))
