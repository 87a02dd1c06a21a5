"""Registered chunking queries (C1-C7) over the whole ``documents`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.config import DEFAULT
from quarry.operators import chunk as C
from quarry.plans.catalog import register
from quarry.plans.sql import WS
from quarry.sources import tables

P = DEFAULT
CTX, OV, PAD = P.context_length, P.overlap, P.pad_token_id


def sql_hash_tokens(x: str) -> str:
    return (f"list_transform(list_filter(regexp_split_to_array(lower({x}), {WS}), lambda w: w <> ''), "
            f"lambda w: CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % {C.HASH_VOCAB} + 1)")


def sql_pieces(sep_sql: str, true_offsets: bool = False) -> str:
    idx = ("coalesce(sum(length(piece) + length(" + sep_sql + ")) OVER (PARTITION BY doc_id ORDER BY piece_no "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)") if true_offsets else "instr(text, piece) - 1"
    return f"""
raw_pieces AS (
  SELECT doc_id, text, generate_subscripts(ps, 1) - 1 AS piece_no, unnest(ps) AS piece
  FROM (SELECT doc_id, text, string_split(text, {sep_sql}) AS ps FROM documents)),
pieces AS (
  SELECT * FROM (SELECT doc_id, CAST(piece_no AS BIGINT) AS piece_no, piece,
                        CAST({idx} AS BIGINT) AS text_idx, CAST(length(piece) AS BIGINT) AS text_len
                 FROM raw_pieces) WHERE piece <> '')"""


def sql_direct(sep_sql: str) -> str:
    return f"""WITH {sql_pieces(sep_sql).strip()},
tok AS (SELECT doc_id, piece_no, text_idx, text_len, {sql_hash_tokens('piece')} AS toks FROM pieces),
wins AS (
  SELECT doc_id, piece_no, text_idx, text_len, toks,
         generate_subscripts(starts, 1) - 1 AS win_no, unnest(starts) AS start
  FROM (SELECT *, generate_series(0, greatest(len(toks) - {OV} - 1, 0), {CTX - OV}) AS starts FROM tok)),
chunks AS (SELECT doc_id, piece_no, CAST(win_no AS BIGINT) AS win_no, text_idx, text_len,
                  list_slice(toks, start + 1, start + {CTX}) AS ch FROM wins)"""


DIRECT_COLS = f"""
SELECT doc_id, piece_no, win_no, text_idx, text_len, CAST(len(ch) AS BIGINT) AS n_tokens,
       list_concat(ch, list_transform(range({CTX} - len(ch)), lambda x: CAST({PAD} AS BIGINT))) AS tokens
FROM chunks"""


def _docs(spark, sf_dir):
    return tables.documents(spark, sf_dir).select("doc_id", "text")


@register("c1_direct_split", sql_direct("chr(10) || chr(10)") + DIRECT_COLS)
def c1_direct_split(spark, sf_dir):
    return C.direct_split(_docs(spark, sf_dir), P, "\n\n")


@register("c1_direct_split_lines", sql_direct("chr(10)") + DIRECT_COLS)
def c1_direct_split_lines(spark, sf_dir):
    return C.direct_split(_docs(spark, sf_dir), P, "\n")


@register("c2_piece_offsets", f"""
WITH raw_pieces AS (
  SELECT doc_id, text, generate_subscripts(ps, 1) - 1 AS piece_no, unnest(ps) AS piece
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS ps FROM documents)),
offs AS (
  SELECT doc_id, CAST(piece_no AS BIGINT) AS piece_no, piece,
         CAST(instr(text, piece) - 1 AS BIGINT) AS first_idx,
         CAST(coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY piece_no
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS true_idx
  FROM raw_pieces)
SELECT doc_id, piece_no, first_idx, true_idx, CAST(length(piece) AS BIGINT) AS text_len
FROM offs WHERE piece <> ''""")
def c2_piece_offsets(spark, sf_dir):
    d = _docs(spark, sf_dir)
    first = C.split_pieces(d, "\n")
    true = C.split_pieces(d, "\n", true_offsets=True).select("doc_id", "piece_no", F.col("text_idx").alias("true_idx"))
    return first.join(true, ["doc_id", "piece_no"]).select(
        "doc_id", "piece_no", F.col("text_idx").alias("first_idx"), "true_idx", "text_len")


@register("c7_attention_mask", sql_direct("chr(10) || chr(10)") + f"""
SELECT doc_id, piece_no, win_no,
       list_transform(list_concat(ch, list_transform(range({CTX} - len(ch)), lambda x: {PAD})),
                      lambda t: CASE WHEN t = {PAD} THEN 0 ELSE 1 END) AS mask,
       CAST(len(ch) AS BIGINT) AS n_attended
FROM chunks""")
def c7_attention_mask(spark, sf_dir):
    ch = C.direct_split(_docs(spark, sf_dir), P, "\n\n")
    m = C.attention_mask("tokens", PAD)
    return ch.select("doc_id", "piece_no", "win_no", m.alias("mask"),
                     F.aggregate(m, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_attended"))


LEVELS_SQL = f"""l1 AS (
  SELECT doc_id, text, generate_subscripts(ps, 1) - 1 AS i, unnest(ps) AS piece
  FROM (SELECT doc_id, text, string_split(text, chr(10) || chr(10)) AS ps FROM documents)),
p1 AS (SELECT doc_id, '.' || lpad(CAST(i AS VARCHAR), 6, '0') AS path, piece,
              CAST(instr(text, piece) - 1 AS BIGINT) AS text_idx,
              len({sql_hash_tokens('piece')}) AS n FROM l1 WHERE piece <> ''),
l2 AS (
  SELECT doc_id, path AS ppath, piece AS parent, text_idx AS base,
         generate_subscripts(ps, 1) - 1 AS i, unnest(ps) AS piece
  FROM (SELECT *, string_split(piece, chr(10)) AS ps FROM p1 WHERE n > {CTX})),
p2 AS (SELECT doc_id, ppath || '.' || lpad(CAST(i AS VARCHAR), 6, '0') AS path, piece,
              CAST(base + instr(parent, piece) - 1 AS BIGINT) AS text_idx,
              len({sql_hash_tokens('piece')}) AS n FROM l2 WHERE piece <> ''),"""


@register("c3_high_level_pieces", f"""
WITH {LEVELS_SQL}
allp AS (SELECT * FROM p1 WHERE n <= {CTX} UNION ALL SELECT * FROM p2)
SELECT doc_id, path, text_idx, CAST(length(piece) AS BIGINT) AS text_len, CAST(n AS BIGINT) AS n_tokens,
       n <= {CTX} AS fits
FROM allp""")
def c3_high_level_pieces(spark, sf_dir):
    d = _docs(spark, sf_dir)
    n = F.size(C.hash_tokenizer(F.col("piece")))

    def level(df, sep):
        p = df.select("doc_id", "path", F.col("piece").alias("parent"), F.col("text_idx").alias("base"),
                      F.posexplode(F.split("piece", sep)).alias("i", "piece")).filter(F.col("piece") != "")
        return p.select("doc_id", F.concat("path", F.lit("."), F.lpad(F.col("i").cast("string"), 6, "0")).alias("path"),
                        "piece", (F.col("base") + F.instr(F.col("parent"), F.col("piece")) - 1).cast("long").alias("text_idx"))
    start = d.select("doc_id", F.lit("").alias("path"), F.col("text").alias("piece"), F.lit(0).cast("long").alias("text_idx"))
    p1 = level(start, "\n\n").withColumn("n", n)
    p2 = level(p1.filter(F.col("n") > CTX).drop("n"), "\n").withColumn("n", n)
    allp = p1.filter(F.col("n") <= CTX).unionByName(p2)
    return allp.select("doc_id", "path", "text_idx", F.length("piece").cast("long").alias("text_len"),
                       F.col("n").cast("long").alias("n_tokens"), (F.col("n") <= CTX).alias("fits"))


@register("c5_recursive_chunks", f"""
WITH RECURSIVE {LEVELS_SQL}
halved AS (
  SELECT doc_id, path, piece, text_idx, n FROM p2 WHERE n > {CTX}
  UNION ALL
  SELECT doc_id, path || '.' || CAST(i AS VARCHAR), half, CAST(base + instr(parent, half) - 1 AS BIGINT),
         len({sql_hash_tokens('half')})
  FROM (SELECT doc_id, path, parent, base, unnest([0, 1]) AS i,
               unnest(CASE WHEN by_words
                 THEN [array_to_string(list_slice(parts, 1, len(parts) // 2), ' '),
                       array_to_string(list_slice(parts, len(parts) // 2 + 1, len(parts)), ' ')]
                 ELSE [array_to_string(list_slice(parts, 1, len(parts) // 2), ''),
                       array_to_string(list_slice(parts, len(parts) // 2 + 1, len(parts)), '')] END) AS half
        FROM (SELECT doc_id, path, piece AS parent, text_idx AS base,
                     CASE WHEN contains(piece, ' ') THEN string_split(piece, ' ') ELSE string_split(piece, '') END AS parts,
                     contains(piece, ' ') AS by_words
              FROM halved WHERE n > {CTX} AND length(piece) > 1))
  WHERE half <> ''),
fits AS (
  SELECT doc_id, path, piece, text_idx FROM p1 WHERE n <= {CTX}
  UNION ALL SELECT doc_id, path, piece, text_idx FROM p2 WHERE n <= {CTX}
  UNION ALL SELECT doc_id, path, piece, text_idx FROM halved WHERE n <= {CTX})
SELECT doc_id, path, text_idx, CAST(length(piece) AS BIGINT) AS text_len, CAST(len(toks) AS BIGINT) AS n_tokens,
       list_concat(toks, list_transform(range({CTX} - len(toks)), lambda x: CAST({PAD} AS BIGINT))) AS tokens
FROM (SELECT *, {sql_hash_tokens('piece')} AS toks FROM fits)""")
def c5_recursive_chunks(spark, sf_dir):
    return C.recursive_split(_docs(spark, sf_dir), P)
