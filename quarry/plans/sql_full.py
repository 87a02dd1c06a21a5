"""SQL of the full normalisation profile: the chain over distinct tokens as CTEs."""

from __future__ import annotations

from quarry.config import PUNCT_FROM, PUNCT_TO, STOPWORDS, SUBSCRIPT_DIGITS, SUPERSCRIPT_DIGITS
from quarry.functions import stemmer
from quarry.functions.numwords import spelt_sql
from quarry.functions.vocab import CONTRACTIONS, SPACES, TAI_LUE_DIGITS, digits
from quarry.plans.q_text import sql_script_digits, sql_special_numbers
from quarry.plans.sql import WS, lit, str_list

KEPT = f"length(x) > 1 AND NOT list_contains({str_list(STOPWORDS)}, x)"


def punctuation(x: str) -> str:
    return f"translate({x}, {lit(PUNCT_FROM)}, {lit(PUNCT_TO)})"


def raw_tokens(text: str) -> str:
    folded = punctuation(sql_special_numbers(f"lower({text})"))
    return f"list_filter(regexp_split_to_array({folded}, {WS}), lambda x: {KEPT})"


def split_words(x: str) -> str:
    two = " ".join(f"WHEN {lit(k)} THEN {str_list(v)}" for k, v in CONTRACTIONS.items())
    words = (f"list_filter(list_transform(regexp_split_to_array({x}, {lit(SPACES)}), lambda x: rtrim(x, ',')), "
             f"lambda x: x <> '')")
    return f"flatten(list_transform({words}, lambda x: CASE x {two} ELSE [x] END))"


def shape(w: str) -> str:
    runs = f"regexp_extract_all({w}, '[^y]+|y+')"
    return (f"array_to_string(list_transform({runs}, lambda r, i: CASE WHEN left(r, 1) = 'y' THEN left(repeat("
            f"CASE WHEN i > 1 AND right({runs}[i - 1], 1) NOT IN ('a', 'e', 'i', 'o', 'u') THEN 'vc' ELSE 'cv' END, "
            f"length(r)), length(r)) ELSE translate(regexp_replace(r, '[^aeiou]', '.', 'g'), 'aeiou.', 'vvvvvc') END), '')")


def _numbers(name: str, source: str) -> str:
    decimal, ascii_, every = digits()
    tai_lue = "".join(map(chr, TAI_LUE_DIGITS))
    return f"""
{name} AS (SELECT token, unnest(CASE
    WHEN regexp_matches(w, {lit(f'^[{every}]*[{tai_lue}][{every}]*$')}) THEN []
    WHEN regexp_matches(w, {lit(f'^[{decimal}]+$')}) THEN {split_words('n')} ELSE [w] END) AS w
  FROM (SELECT token, w, CASE WHEN d IS NOT NULL THEN {spelt_sql('d')} END AS n
    FROM (SELECT token, w, CASE WHEN regexp_matches(w, {lit(f'^[{decimal}]+$')}) THEN
            translate(w, {lit(decimal)}, {lit(ascii_)}) END AS d FROM {source})))"""


def _stems(name: str, source: str) -> str:
    out = [f"\n{name}_0 AS (SELECT token, w AS o, w, CAST(NULL AS VARCHAR) AS cut FROM {source})"]
    for i, step in enumerate(stemmer.steps(), 1):
        cols = ", ".join(f"{step.get(c, c)} AS {c}" for c in ("w", "cut"))
        out.append(f"\n{name}_{i} AS (SELECT token, o, {cols} FROM (SELECT *, {shape('w')} AS s FROM {name}_{i - 1}))")
    out.append(f"\n{name} AS (SELECT token, {stemmer.whole('o', 'w')} AS w FROM {name}_{len(stemmer.steps())})")
    return ",".join(out)


def _words(name: str, source: str) -> str:
    return f"\n{name} AS (SELECT token, unnest({split_words(punctuation('w'))}) AS w FROM {source})"


def chain_ctes(raw: str) -> str:
    """CTEs from ``vocab`` to ``mapped(token, word)``; ``raw`` is a select of ``token``."""
    marked = sql_script_digits(sql_script_digits("token", SUPERSCRIPT_DIGITS), SUBSCRIPT_DIGITS)
    return f"""
vocab AS (SELECT DISTINCT token FROM ({raw})),
first_words AS (SELECT token, unnest({split_words(marked)}) AS w FROM vocab),{_numbers('spelt_once', 'first_words')},{
        _stems('stem_once', 'spelt_once')},{_words('second_words', 'stem_once')},{
        _numbers('spelt_twice', 'second_words')},{_stems('stem_twice', 'spelt_twice')},{_words('third_words', 'stem_twice')},
mapped AS (SELECT token, x AS word FROM (SELECT token, w AS x FROM third_words) WHERE {KEPT})"""


DOC_TOKENS = f"doc_tokens AS (SELECT doc_id, unnest({raw_tokens('text')}) AS token FROM documents)"
QUERY_TOKENS = f"query_tokens AS (SELECT item_id AS query_id, unnest({raw_tokens('text')}) AS token FROM benchmark)"

MAP_SQL = f"""
WITH {DOC_TOKENS},{chain_ctes('SELECT token FROM doc_tokens')}
SELECT v.token, coalesce(list_sort(list(m.word) FILTER (WHERE m.word IS NOT NULL)), []) AS words
FROM vocab v LEFT JOIN mapped m USING (token) GROUP BY v.token"""

FULL_TERMS = "full_terms AS (SELECT doc_id, word, CAST(count(*) AS BIGINT) AS tf FROM doc_tokens JOIN mapped USING (token) GROUP BY doc_id, word)"

TERMS_SQL = f"""
WITH {DOC_TOKENS},{chain_ctes('SELECT token FROM doc_tokens')},
{FULL_TERMS}
SELECT doc_id, word, tf FROM full_terms"""

#: CTEs ``terms, stats, dfs, idf, qterms`` of the full profile, as the basic profile's.
SEARCH_CTES = f"""WITH {DOC_TOKENS},
{QUERY_TOKENS},{chain_ctes('SELECT token FROM doc_tokens UNION SELECT token FROM query_tokens')},
{FULL_TERMS},
lens AS (SELECT d.doc_id, CAST(coalesce(l.n, 0) AS BIGINT) AS doc_len FROM documents d
  LEFT JOIN (SELECT doc_id, sum(tf) AS n FROM full_terms GROUP BY doc_id) l USING (doc_id)),
terms AS (SELECT t.doc_id, t.word, t.tf, l.doc_len FROM full_terms t JOIN lens l USING (doc_id)),
stats AS (SELECT CAST(count(*) AS BIGINT) AS corpus_size, avg(doc_len) AS avg_doc_len FROM lens),
dfs AS (SELECT word, CAST(count(*) AS BIGINT) AS num_docs FROM terms GROUP BY word),
idf AS (SELECT word, ln(corpus_size / num_docs) AS idf FROM dfs, stats),
qterms AS (SELECT query_id, word, CAST(count(*) AS BIGINT) AS qtf FROM query_tokens JOIN mapped USING (token)
  GROUP BY query_id, word)"""
