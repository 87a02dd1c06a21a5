"""Registered text-function queries (T1-T19, S3, S4) over whole tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quarry.config import (PUNCT_FROM, PUNCT_TO, SUBSCRIPT_DIGITS, SUPERSCRIPT_DIGITS,
                           enclosed_number_map)
from quarry.functions import html as H
from quarry.functions import text as T
from quarry.functions.tokenizer import RULES, SENTENCES, word_tokenize
from quarry.plans.catalog import register
from quarry.plans.sql import STOP_LIST, WS, basic_tokens, lit
from quarry.sources import tables

# ---- SQL spellings of the same expressions ----------------------------------------

LINE_BREAK_RE = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]"
STRIP_RE = T.STRIP_WS


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(STRIP_RE)}, '', 'g')"


def sql_lines(x: str) -> str:
    return f"regexp_split_to_array({x}, {lit(LINE_BREAK_RE)})"


def sql_special_numbers(x: str) -> str:
    out = x
    for glyph, rep in enclosed_number_map().items():
        out = f"replace({out}, {lit(glyph)}, {lit(rep)})"
    return out


def sql_script_digits(x: str, digits: str) -> str:
    return (f"translate(regexp_replace({x}, '([{digits}]+)', '^\\1 ', 'g'), "
            f"{lit(digits)}, '0123456789')")


def sql_html_text(x: str) -> str:
    out = x
    for pat in (H.SCRIPT_BLOCK, H.STYLE_BLOCK, H.COMMENT, H.TAG):
        out = f"regexp_replace({out}, {lit(pat)}, '', 'g')"
    names = ", ".join(lit(e) for e in H.ENTITIES)
    chars = ", ".join(lit(c) for c in H.ENTITIES.values())
    # text between the references, and the references decoded, in turn
    parts = f"regexp_split_to_array({out}, {lit(H.REFERENCE)})"
    code = "CAST(CASE WHEN lower(e[3]) = 'x' THEN '0x' || e[4:len(e) - 1] ELSE e[3:len(e) - 1] END AS INTEGER)"
    one = f"CASE WHEN e[2] = '#' THEN chr({code}) ELSE coalesce(list_extract([{chars}], list_position([{names}], e)), e) END"
    refs = f"list_transform(regexp_extract_all({out}, {lit(H.REFERENCE)}), lambda e: {one})"
    out = (f"array_to_string(list_transform(list_zip({parts}, list_append({refs}, '')), "
           "lambda z: z[1] || z[2]), '')")
    return out


def _docs(spark, sf_dir):
    return tables.documents(spark, sf_dir)


# ---- T1 .. T19 ----------------------------------------------------------------------

@register("t1_lowercase", "SELECT doc_id, lower(text) AS value FROM documents")
def t1_lowercase(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.lowercase("text").alias("value"))


@register("t2_special_numbers",
          f"SELECT doc_id, {sql_special_numbers('text')} AS value FROM documents")
def t2_special_numbers(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.special_numbers("text").alias("value"))


@register("t3_superscripts",
          f"SELECT doc_id, {sql_script_digits('text', SUPERSCRIPT_DIGITS)} AS value FROM documents")
def t3_superscripts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.superscripts("text").alias("value"))


@register("t4_subscripts",
          f"SELECT doc_id, {sql_script_digits('text', SUBSCRIPT_DIGITS)} AS value FROM documents")
def t4_subscripts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.subscripts("text").alias("value"))


@register("t5_punctuation",
          f"SELECT doc_id, translate(text, {lit(PUNCT_FROM)}, {lit(PUNCT_TO)}) AS value FROM documents")
def t5_punctuation(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.strip_punctuation("text").alias("value"))


@register("t6_tokenize", f"""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, token FROM (
  SELECT doc_id, generate_subscripts(toks, 1) - 1 AS pos, unnest(toks) AS token
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(
          translate(lower(text), {lit(PUNCT_FROM)}, {lit(PUNCT_TO)}), {WS}), lambda w: w <> '') AS toks
        FROM documents))""")
def t6_tokenize(spark, sf_dir):
    d = _docs(spark, sf_dir)
    toks = T.tokenize(T.strip_punctuation(T.lowercase("text")))
    return d.select("doc_id", F.posexplode(toks).alias("pos", "token")) \
            .withColumn("pos", F.col("pos").cast("long"))


def _cascade_sql(c: str) -> str:
    """The word tokeniser's rules one after the other; groups are written as backslash and number."""
    for pattern, by in SENTENCES + RULES:
        c = f"regexp_replace({c}, {lit(pattern)}, {lit(re.sub('[$]([0-9])', lambda m: chr(92) + m[1], by))}, 'g')"
    return c


@register("t6_word_tokenize", f"""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, token FROM (
  SELECT doc_id, generate_subscripts(toks, 1) - 1 AS pos, unnest(toks) AS token
  FROM (SELECT doc_id, list_filter(regexp_split_to_array({_cascade_sql('text')}, '[ \n]+'), lambda w: w <> '') AS toks
        FROM documents))""")
def t6_word_tokenize(spark, sf_dir):
    """Contractions, quotes and ends of sentences as tokens of their own."""
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(word_tokenize("text")).alias("pos", "token")) \
                               .withColumn("pos", F.col("pos").cast("long"))


@register("t7_stopwords", f"""
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens,
       CAST(len(list_filter(toks, lambda w: length(w) > 1 AND NOT list_contains({STOP_LIST}, w))) AS BIGINT) AS n_kept
FROM (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(lower(text), {lit(PUNCT_FROM)}, {lit(PUNCT_TO)}), {WS}), lambda w: w <> '') AS toks
      FROM documents)""")
def t7_stopwords(spark, sf_dir):
    d = _docs(spark, sf_dir)
    toks = T.tokenize(T.strip_punctuation(T.lowercase("text")))
    return d.select("doc_id", F.size(toks).cast("long").alias("n_tokens"),
                    F.size(T.drop_stopwords(toks)).cast("long").alias("n_kept"))


@register("t11_bag_of_words", f"""
SELECT doc_id, CAST(len(list_distinct(toks)) AS BIGINT) AS n_distinct, CAST(len(toks) AS BIGINT) AS n_words
FROM (SELECT doc_id, {basic_tokens('text')} AS toks FROM documents)""")
def t11_bag_of_words(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", T.basic_tokens("text").alias("toks"))
    return d.select("doc_id", F.size(F.array_distinct("toks")).cast("long").alias("n_distinct"),
                    F.size("toks").cast("long").alias("n_words"))


@register("t12_lines", f"""
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, {sql_lines("regexp_replace(text, '(' || " + lit(LINE_BREAK_RE) + " || ')$', '')")} AS ls
        FROM documents))""")
def t12_lines(spark, sf_dir):
    d = _docs(spark, sf_dir)
    body = F.regexp_replace("text", "(" + T.LINE_BREAK + ")$", "")
    return d.select("doc_id", F.posexplode(T.lines(body)).alias("line_no", "line")) \
            .withColumn("line_no", F.col("line_no").cast("long"))


@register("t13_title", f"""
SELECT doc_id, coalesce(list_filter({sql_lines('text')}, lambda x: {sql_strip('x')} <> '')[1], '') AS title
FROM documents""")
def t13_title(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.title("text").alias("title"))


@register("t14_first_paragraph", f"""
SELECT doc_id, title, coalesce(list_filter(
         list_transform(list_slice(ls, coalesce(list_position(ls, title), 0) + 1, len(ls)),
                        lambda x: {sql_strip('x')}),
         lambda x: x <> '' AND x <> title)[1], title) AS first_paragraph
FROM (SELECT doc_id, ls, coalesce(list_filter(ls, lambda x: {sql_strip('x')} <> '')[1], '') AS title
      FROM (SELECT doc_id, {sql_lines('text')} AS ls FROM documents))""")
def t14_first_paragraph(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", "text", T.title("text").alias("title"))
    return d.select("doc_id", "title", T.first_paragraph("text", "title").alias("first_paragraph"))


@register("t15_scrub_markup", """
SELECT page_id, regexp_replace(regexp_replace(html, '\\{\\{[^\\n]*?\\}\\}', '', 'g'), '<[^\\n]*?>', '', 'g') AS value
FROM pages""")
def t15_scrub_markup(spark, sf_dir):
    return tables.pages(spark, sf_dir).select("page_id", T.scrub_markup("html").alias("value"))


@register("t16_paragraphs", f"""
SELECT doc_id, CAST(para_no AS BIGINT) AS para_no, paragraph FROM (
  SELECT doc_id, generate_subscripts(ps, 1) - 1 AS para_no, unnest(ps) AS paragraph
  FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10) || chr(10)),
                 lambda x: {sql_strip('x')}), lambda x: x <> '') AS ps FROM documents))""")
def t16_paragraphs(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select("doc_id", F.posexplode(T.paragraphs("text")).alias("para_no", "paragraph")) \
            .withColumn("para_no", F.col("para_no").cast("long"))


@register("t17_sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def t17_sha256(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.sha256_hex("text").alias("digest"))


@register("t18_span_slice", """
WITH raw AS (
  SELECT doc_id, text, generate_subscripts(ps, 1) - 1 AS piece_no, unnest(ps) AS piece
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS ps FROM documents)),
spans AS (
  SELECT doc_id, text, piece_no, length(piece) AS len,
         coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY piece_no
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM raw)
SELECT doc_id, CAST(piece_no AS BIGINT) AS piece_no, CAST(start AS BIGINT) AS span_start,
       CAST(start + len AS BIGINT) AS span_end, substring(text, CAST(start AS BIGINT) + 1, len) AS span_text
FROM spans WHERE len > 0""")
def t18_span_slice(spark, sf_dir):
    """Every line of every document cut out of the text by its span [s, e)."""
    from quarry.operators.chunk import split_pieces
    d = _docs(spark, sf_dir).select("doc_id", "text")
    sp = split_pieces(d, "\n", true_offsets=True).select(
        "doc_id", "piece_no", F.col("text_idx").alias("span_start"),
        (F.col("text_idx") + F.col("text_len")).alias("span_end"))
    j = sp.join(d, "doc_id")
    return j.select("doc_id", "piece_no", "span_start", "span_end",
                    T.span_slice("text", F.col("span_start"), F.col("span_end")).alias("span_text"))


@register("t19_logs", f"""
SELECT doc_id, round(CASE WHEN len(toks) > 0 THEN ln(len(toks)) END, 6) AS ln_len,
       round(ln(2 * (SELECT count(*) FROM documents) + 1), 6) AS ln_oov
FROM (SELECT doc_id, {basic_tokens('text')} AS toks FROM documents)""")
def t19_logs(spark, sf_dir):
    d = _docs(spark, sf_dir)
    n = d.agg(F.count(F.lit(1)).alias("n")).scalar()
    toks = d.select("doc_id", F.size(T.basic_tokens("text")).alias("len"))
    return toks.select(
        "doc_id", F.round(F.when(F.col("len") > 0, F.log("len")), 6).alias("ln_len"),
        F.round(F.log(2 * n + 1), 6).alias("ln_oov"))


# ---- S3, S4 --------------------------------------------------------------------------

@register("s3_decode_utf8", "SELECT doc_id, 'AB' || replace(text, chr(65533), '') AS text FROM documents")
def s3_decode_utf8(spark, sf_dir):
    """Every text with broken bytes around it: FF is never valid, C3 lacks its second byte."""
    d = _docs(spark, sf_dir)
    raw = F.concat(F.unhex(F.lit("41FF42")), F.encode("text", "UTF-8"), F.unhex(F.lit("C3")))
    return d.select("doc_id", T.decode_utf8_dropping(raw).alias("text"))


@register("s4_html_text", f"SELECT page_id, {sql_html_text('html')} AS text FROM pages")
def s4_html_text(spark, sf_dir):
    return tables.pages(spark, sf_dir).select("page_id", H.html_to_text("html").alias("text"))


@register("s4_html_text_parser")
def s4_html_text_parser(spark, sf_dir):
    return tables.pages(spark, sf_dir).select("page_id", H.html_to_text_parser("html").alias("text"))
