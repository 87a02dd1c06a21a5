"""Licence scan: TF-IDF cosine to templates, then inheritance along the paths.

A file's candidates are its header lines (lines with a licence cue), or the
whole text for a licence file, and word windows: where an anchor word of a
template stands in the text, the window that lines up with the template is
compared with it, over line breaks and inside long lines, from
``WINDOW_COSINE`` on. The titles of licence texts are looked for in named
licence files only. Each candidate is a sparse TF-IDF vector; the
document frequencies of all template words are counted over all files, words
outside the templates weigh 1. A candidate states the licence of the template
with the largest cosine, from ``min_cosine`` on.

Licence files are files with such a name (LICENSE, COPYING, NOTICE, ...). Files
that state none inherit from the licence file in the nearest
ancestor directory: every file is joined with its ancestors by path, deepest
first.

Defined cases: null text states nothing, a null path has no directory (it
inherits nothing); several statements in a file: the largest cosine counts,
then the licence first in order; several licence files in a directory: the
first path; repeated rows are returned each; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise, small, text_hash

MIN_COSINE = 0.6
WINDOW_COSINE = 0.85
CUE = r"(?i)licen[cs]|copyright|copyleft|public domain|all rights reserved|\bGPL|\bCC[ -]?(?:BY|0)|granted|redistribution"
FILE_NAME = r"(?i)^(?:un)?licen[cs]e(?:[.-].*)?$|^copying(?:[.-].*)?$|^notice(?:[.-].*)?$"
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"

# Licence id and notice wording.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause New or Revised License"),
    ("ISC", "Licensed under the ISC License"),
    ("CC0-1.0", "Released under CC0 1.0 Universal public domain dedication"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Proprietary", "Copyright. All rights reserved. Proprietary and confidential"),
    *((f"{a}-{v}", f"under the terms of the GNU {n} General Public License as published by the Free Software Foundation, either version {w} of the License")
      for a, n, v, w in (("GPL", "", "2.0", "2"), ("GPL", "", "3.0", "3"), ("LGPL", "Lesser", "2.1", "2.1"),
                         ("LGPL", "Lesser", "3.0", "3"), ("AGPL", "Affero", "3.0", "3"))),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
)
# Titles of whole licence texts.
TITLES = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-1.0", "GNU General Public License Version 1, February 1989"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.0", "GNU Library General Public License Version 2, June 1991"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    *((f"CC-{i}-4.0", f"Creative Commons Attribution{n} 4.0 International Public License") for i, n in (
        ("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-NC", "-NonCommercial"), ("BY-ND", "-NoDerivatives"),
        ("BY-NC-SA", "-NonCommercial-ShareAlike"), ("BY-NC-ND", "-NonCommercial-NoDerivatives"))),
)
#: Words that a window is lined up at.
ANCHORS = ("license", "licensed", "copyright", "domain", "granted", "redistribution", "cc", "cc0", "commons", "endorse")
#: A text that states the second licence holds the wording of the first.
COVERED = ("BSD-2-Clause", "BSD-3-Clause")


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def templates(spark, wording=TEMPLATES) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(n).alias("license"), F.lit(w).alias("text"))
                     for i, (n, w) in enumerate(wording)])
    return spark.range(1).select(F.inline(rows))


def _anchors(spark, wording, n_notices: int) -> DataFrame:
    """``word, t, off, len, title``: where the anchor words stand in each template."""
    rows = []
    for t, (_, text) in enumerate(wording):
        w = re.findall(WORD, text.lower())
        rows += [F.struct(F.lit(x).alias("word"), F.lit(t).alias("w_t"), F.lit(i).alias("off"), F.lit(len(w)).alias("len"),
                          F.lit(t >= n_notices).alias("title")) for i, x in enumerate(w) if x in ANCHORS]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _around(words: Column, reach: int) -> Column:
    """``i, x, before, near``: each anchor word with ``reach`` words on both sides."""
    def of(w):
        at = F.filter(F.transform(w, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].isin(*ANCHORS))
        return F.transform(at, lambda s: F.struct(
            s["i"].alias("i"), s["x"].alias("x"), F.least(s["i"], F.lit(reach)).alias("before"),
            F.slice(w, F.greatest(s["i"] - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("near")))
    return F.flatten(F.transform(F.array(words), of))  # the words are split once


def scan(files: DataFrame, min_cosine: float = MIN_COSINE, wording=TEMPLATES, titles=TITLES) -> DataFrame:
    """``path, h, license, how, score, from_path`` for every row of ``files(path, text)``.

    ``how``: ``file``, ``header``, ``inherited`` or ``none``; ``h`` is the
    text's hash.
    """
    spark = files.sparkSession
    text = F.col("text").cast("string")
    src = files.select(F.col("path").cast("string").alias("path"), text_hash(text).alias("h"),
                       F.coalesce(text, F.lit("")).alias("text"))
    named = F.coalesce(F.element_at(F.split("path", "/"), -1).rlike(FILE_NAME), F.lit(False))
    n_notices, wording = len(wording), (*wording, *titles)
    tpl = templates(spark, wording).select("t", "license", F.explode(terms(F.col("text"))).alias("term")).groupBy(
        "t", "license", "term").agg(F.count("*").alias("tf"))
    tpl = materialise(tpl, "license-templates")  # bounded: the wording

    # document frequencies of the template words over all files
    vocab = tpl.select(F.col("term").alias("v")).distinct()
    seen = src.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    df = seen.join(F.broadcast(vocab), F.col("term") == F.col("v")).groupBy("term").agg(F.count("*").alias("df"))
    n_docs = F.lit(src.select("h").count())
    idf = F.log((1.0 + n_docs) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0
    weights = materialise(vocab.join(df, F.col("v") == F.col("term"), "left").select("v", idf.alias("idf")), "license-idf")
    tw = tpl.join(F.broadcast(weights), F.col("term") == F.col("v")).select("t", "license", "term", "idf", (F.col("tf") * F.col("idf")).alias("w"))
    norms = tw.groupBy(F.col("t").alias("n_t")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    tw = materialise(tw.join(F.broadcast(norms), F.col("t") == F.col("n_t")).drop("n_t"), "license-vectors")

    # candidates: cue lines of ordinary files, the whole text of licence files
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(CUE))
    cued = src.withColumn("named", named).filter(F.col("named") | F.col("text").rlike(CUE))
    held = ["path", "h", "named", F.size(terms(F.col("text"))).alias("n_words")]
    units = cued.select(*held, F.posexplode(F.when(F.col("named"), F.array("text")).otherwise(lines)).alias("u", "line")).select(
        "path", "h", "named", "n_words", F.lit(-1).alias("u_t"), "u", terms(F.col("line")).alias("line"))
    # windows: the words around an anchor, cut to line up with each template that has it
    reach = max(len(re.findall(WORD, text.lower())) for _, text in wording)
    spots = cued.select(*held, F.explode(_around(terms(F.col("text")), reach)).alias("s")).select(
        "path", "h", "named", "n_words", "s.*")
    first = F.col("before") - F.col("off")
    windows = spots.join(F.broadcast(_anchors(spark, wording, n_notices)), (F.col("x") == F.col("word")) & (
        F.col("named") | ~F.col("title"))).select(
        "path", "h", "named", "n_words", F.col("w_t").alias("u_t"), (F.col("i") - F.col("off")).alias("u"),
        F.slice("near", F.greatest(first, F.lit(0)) + 1, F.col("len") + F.least(first, F.lit(0))).alias("line"))
    units = materialise(units.unionByName(windows).distinct(), "license-lines")
    key = ["path", "h", "named", "n_words", "u_t", "u"]
    bag = units.select(*key, F.explode("line").alias("term")).groupBy(*key, "term").agg(F.count("*").alias("tf"))
    by_term = F.broadcast(weights.withColumnRenamed("idf", "w_idf"))
    bag = materialise(bag.join(by_term, F.col("term") == F.col("v"), "left").select(
        *key, "term", (F.col("tf") * F.coalesce("w_idf", F.lit(1.0))).alias("w")), "license-bags")
    size = bag.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    dot = bag.join(F.broadcast(tw.select("t", "license", F.col("term").alias("t_term"), F.col("w").alias("t_w"), "norm")),
                   (F.col("term") == F.col("t_term")) & F.when(F.col("u_t") < 0, F.col("t") < n_notices).otherwise(
                       F.col("u_t") == F.col("t"))).groupBy(*key, "t", "license", "norm").agg(
        F.sum(F.col("w") * F.col("t_w")).alias("dot"))
    keyed = size.withColumnsRenamed({k: f"s_{k}" for k in key})
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"s_{k}"))
    cos = dot.join(keyed, same).withColumn("cos", F.round(F.col("dot") / (F.col("size") * F.col("norm")), 9))
    # the largest cosine, then the template first in order
    stated = F.struct("cos", (-F.col("t")).alias("o"), "license")
    enough = F.when(F.col("u_t") < 0, min_cosine).otherwise(F.greatest(F.lit(min_cosine), F.lit(WINDOW_COSINE)))
    best = cos.filter(F.col("cos") >= enough).groupBy("path", "h", "named", "n_words").agg(
        F.max(stated).alias("b"), F.max(F.when(F.col("license") == COVERED[1], stated)).alias("more")).withColumn(
        "b", F.when((F.col("b.license") == COVERED[0]) & F.col("more").isNotNull(), F.col("more")).otherwise(F.col("b")))
    own = materialise(best.select(F.col("path").alias("o_path"), F.col("h").alias("o_h"), F.col("b.license").alias("o_license"),
                                  F.col("b.cos").alias("o_score"), F.col("named").alias("is_file")),
                      "license-own")

    # nearest licence file above
    folder = F.regexp_extract(F.col("o_path"), r"(?s)^(.*)/[^/]*$", 1)
    shelves = own.filter("is_file and o_path is not null").groupBy(folder.alias("dir")).agg(
        F.min(F.struct("o_path", "o_license", "o_score")).alias("l"))
    shelves = small(materialise(shelves, "license-dirs"), 200)
    keys = src.select("path", "h")
    mine = small(own, 120)
    j = keys.join(mine, keys["path"].eqNullSafe(mine["o_path"]) & (keys["h"] == mine["o_h"]), "left")
    bare = j.filter("o_license is null and path is not null").select("path").distinct()
    parts = F.split("path", "/")
    up = bare.select("path", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("dir")))).alias("a")).filter("size(split(path, '/')) > 1")
    got = up.join(shelves, F.col("a.dir") == F.col("dir")).groupBy(F.col("path").alias("i_path")).agg(
        F.max_by("l", "a.depth").alias("l"))
    out = j.join(got, (F.col("path") == F.col("i_path")) & F.col("o_license").isNull(), "left")
    how = (F.when(F.col("is_file"), "file").when(F.col("o_license").isNotNull(), "header")
           .when(F.col("l").isNotNull(), "inherited").otherwise("none"))
    return out.select("path", "h", F.coalesce("o_license", "l.o_license").alias("license"), how.alias("how"),
                      F.coalesce("o_score", "l.o_score").alias("score"),
                      F.when(F.col("o_license").isNull(), F.col("l.o_path")).alias("from_path"))
