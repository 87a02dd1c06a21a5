"""Parameters and fixed values.

Everything a search or build step can be tuned with lives in ``Params``;
values that must stay exactly as listed for results to line up with the
published behaviour (stop words, punctuation handling, glyph tables) are
grouped below under FIXED VALUES.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # BM25 (Robertson/Sparck Jones) saturation and length normalisation.
    k1: float = 1.2
    b: float = 0.75
    # Results per query (``max_results``); must be a positive int.
    top_k: int = 50
    # Similarity threshold: -1 = off, else keep results with score >= srt.
    srt: float = -1.0
    # Index strategies (candidate generation).
    word_idf_max: float = 1.0      # word_idf_filter keeps query words with idf < this
    doc_idf_mass_min: float = 1.0  # weighted_doc_idf keeps docs with summed idf > this
    max_word_len: int = 60         # words longer than this are not indexed in the trie view
    # Sharding of the inverted index by cumulative document frequency.
    shard_df_cap: int = 1_000_000
    vocab_chunk_words: int = 100_000
    # Passage chunking.
    context_length: int = 128
    overlap: int = 64
    pad_token_id: int = 0
    # Dense vectors.
    dims: int = 64
    # Graph expansion.
    max_depth: int = 2
    links_per_page: int = 5
    # Evaluation.
    seed: int = 1234
    sample_size: int = 5
    recall_at: tuple = (5, 10, 25)
    # Rows a side may have to be broadcast explicitly (size check).
    broadcast_max_rows: int = 2_000_000
    # Bytes of query vectors shipped to every kNN task; larger batches stay distributed
    # and meet the items in blocks of so many rows.
    knn_query_bytes: int = 32 * 1024 * 1024
    knn_block_rows: int = 16_384

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()


# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the published behaviour; do not edit.
# ---------------------------------------------------------------------------

# English stop words of the NLTK corpus (179 entries, corpus order).
STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself it "
    "it's its itself they them their theirs themselves what which who whom this "
    "that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't "
    "didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't "
    "wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# ASCII punctuation (Python's string.punctuation). Comma and apostrophe are
# deleted; every other mark becomes a space.
PUNCT_DELETE = ",'"
PUNCT_SPACE = "!\"#$%&()*+-./:;<=>?@[\\]^_`{|}~"
PUNCT_FROM = PUNCT_SPACE + PUNCT_DELETE
PUNCT_TO = " " * len(PUNCT_SPACE)

# Whitespace class used for tokenising (explicit so JVM and RE2 agree).
WS_PATTERN = "[ \\t\\n\\r\\f]+"

# Superscript and subscript digits 0-9.
SUPERSCRIPT_DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹"
SUBSCRIPT_DIGITS = "₀₁₂₃₄₅₆₇₈₉"

# Enclosed-number glyphs -> "(n)". Each row: first glyph of a run of
# consecutive code points and the number it stands for.
#   ①..⑳ 1-20, ㉑..㉟ 21-35, ㊱..㊿ 36-50, ⓪ 0, ⓵..⓾ 1-10 (double circled),
#   ➀..➉ 1-10 (sans-serif circled), ❶..❿ 1-10 (negative circled),
#   ⓫..⓴ 11-20 (negative circled), ⓿ 0, ➊..➓ 1-10 (negative sans-serif),
#   ⑴..⒇ 1-20 (parenthesised).
ENCLOSED_NUMBER_RUNS = (
    ("①", 1, 20),
    ("㉑", 21, 35),
    ("㊱", 36, 50),
    ("⓪", 0, 0),
    ("⓵", 1, 10),
    ("➀", 1, 10),
    ("❶", 1, 10),
    ("⓫", 11, 20),
    ("⓿", 0, 0),
    ("➊", 1, 10),
    ("⑴", 1, 20),
)

# Default text of a missing article in a text lookup.
MISSING_ARTICLE_TEXT = "ERROR: COULD NOT LOCATE ARTICLE {id} in {path}"

# Weight multiplier for boilerplate paragraphs in paragraph sampling, and the
# notice that marks a paragraph as boilerplate (present in every article of
# the encyclopedia dumps the sampler was written for).
BOILERPLATE_WEIGHT = 0.01
BOILERPLATE_MARKERS = (
    "This article is issued from Wikipedia. The text is available under Creative Commons "
    "Attribution-Share Alike 4.0 unless otherwise noted. Additional terms may apply for the media files.",
)


def enclosed_number_map() -> dict:
    """Glyph -> '(n)' built from ENCLOSED_NUMBER_RUNS."""
    out = {}
    for first, lo, hi in ENCLOSED_NUMBER_RUNS:
        base = ord(first)
        for i, n in enumerate(range(lo, hi + 1)):
            out[chr(base + i)] = f"({n})"
    return out
