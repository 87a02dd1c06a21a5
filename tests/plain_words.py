"""Plain one-word versions of the full normalisation chain, which the tests
compare the column expressions with.

Porter suffix-stripping stemmer with the common extensions to the 1980 rules.

Extensions: a pool of irregular forms; "ies"/"ied" keep the e in four-letter
words (ties -> tie); final y becomes i only after a consonant that is not the
word's first letter (day, enjoy, by stay); two-letter stems vowel + consonant
count as short; "alli" is reduced before the other step-2 rules run again;
"fulli" -> "ful", and "logi" -> "log" measures the stem with its l.
"""

from __future__ import annotations

from quarry.config import PUNCT_FROM, PUNCT_TO, STOPWORDS, SUBSCRIPT_DIGITS, SUPERSCRIPT_DIGITS

_VOWELS = frozenset("aeiou")


# FIXED VALUES: irregular forms and their stems.
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing",
    "canning": "canning", "cannings": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, i, n = 0, 0, len(stem)
    while i < n and _is_cons(stem, i):
        i += 1
    while i < n:
        while i < n and not _is_cons(stem, i):
            i += 1
        if i >= n:
            break
        m += 1
        while i < n and _is_cons(stem, i):
            i += 1
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) == 2:
        return not _is_cons(w, 0) and _is_cons(w, 1)
    if len(w) < 3:
        return False
    return (_is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2)
            and _is_cons(w, len(w) - 1) and w[-1] not in "wxy")


# Suffix rules per step, tried in this order; the first suffix that matches
# decides (its condition on m may then leave the word unchanged).
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
_STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
_STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _longest(word: str, rules):
    best = None
    for r in rules:
        suf = r[0] if isinstance(r, tuple) else r
        if word.endswith(suf) and (best is None or len(suf) > len(best[0] if isinstance(best, tuple) else best)):
            best = r
    return best


def stem(word: str) -> str:
    w = word
    if w in _IRREGULAR:
        return _IRREGULAR[w]
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("ies"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    # step 1b
    if w.endswith("ied"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    else:
        cut = next((w[:-len(s)] for s in ("ed", "ing") if w.endswith(s) and _has_vowel(w[:-len(s)])), None)
        if cut is not None:
            w = cut
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif _double_cons(w):
                w = w if w[-1] in "lsz" else w[:-1]
            elif _measure(w) == 1 and _cvc(w):
                w += "e"
    # step 1c
    if w.endswith("y") and len(w) > 2 and _is_cons(w, len(w) - 2):
        w = w[:-1] + "i"
    # step 2
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        w = w[:-2]
    if w.endswith("logi"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        r = _longest(w, _STEP2)
        if r and _measure(w[:-len(r[0])]) > 0:
            w = w[:-len(r[0])] + r[1]
    # step 3
    r = _longest(w, _STEP3)
    if r and _measure(w[:-len(r[0])]) > 0:
        w = w[:-len(r[0])] + r[1]
    # step 4
    r = _longest(w, _STEP4)
    if r:
        base = w[:-len(r)]
        if _measure(base) > 1 and (r != "ion" or base.endswith(("s", "t"))):
            w = base
    # step 5a
    if w.endswith("e"):
        base = w[:-1]
        m = _measure(base)
        if m > 1 or (m == 1 and not _cvc(base)):
            w = base
    # step 5b
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w
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


def _below_100(n: int) -> str:
    if n < 20:
        return ONES[n]
    t, u = divmod(n, 10)
    return TENS[t] + ("-" + ONES[u] if u else "")


def _below_1000(n: int) -> str:
    h, r = divmod(n, 100)
    if not h:
        return _below_100(r)
    return ONES[h] + " hundred" + (" and " + _below_100(r) if r else "")


def cardinal(n: int) -> str:
    if n < 0:
        return "minus " + cardinal(-n)
    if n == 0:
        return "zero"
    if len(str(n)) > MAX_DIGITS:
        raise OverflowError("number too large")
    groups = []
    k = 0
    while n:
        n, g = divmod(n, 1000)
        groups.append((k, g))
        k += 1
    text, value = "", 0
    # build from the lowest group upwards; each higher part is joined to what
    # is below it by " and " (below 100) or ", "
    for k, g in groups:
        if not g:
            continue
        part = _below_1000(g) + ("" if k == 0 else " " + scale_name(k))
        if not text:
            text = part
        else:
            text = part + (" and " if value < 100 else ", ") + text
        value += g * 1000 ** k
    return text


def spell_digits(token: str) -> str:
    """A digit string in words; very long strings are spelt in 306-digit pieces."""
    if len(token) <= MAX_DIGITS:
        return cardinal(int(token))
    return " ".join(cardinal(int(token[i:i + MAX_DIGITS]))
                    for i in range(0, len(token), MAX_DIGITS))
# FIXED VALUES: single-word contractions the tokenizer splits in two.
CONTRACTIONS = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}
# Digits of the New Tai Lue script: tokens made of them are dropped.
TAI_LUE_DIGITS = range(0x19D0, 0x19DA)

_STOP = frozenset(STOPWORDS)
_PUNCT = str.maketrans(PUNCT_FROM[:len(PUNCT_TO)], PUNCT_TO, PUNCT_FROM[len(PUNCT_TO):])
_SUP = {ord(c): str(i) for i, c in enumerate(SUPERSCRIPT_DIGITS)}
_SUB = {ord(c): str(i) for i, c in enumerate(SUBSCRIPT_DIGITS)}


def _punct(s: str) -> str:
    return s.translate(_PUNCT)


def _script_runs(s: str, table: dict) -> str:
    out, i, n = [], 0, len(s)
    while i < n:
        if ord(s[i]) in table:
            j = i
            while j < n and ord(s[j]) in table:
                j += 1
            out.append("^" + s[i:j].translate(table) + " ")
            i = j
        else:
            out.append(s[i])
            i += 1
    return "".join(out)


def tokenize(s: str) -> list[str]:
    """Whitespace split, trailing commas split off, contractions split."""
    out = []
    for w in s.split():
        tail = []
        while len(w) > 1 and w.endswith(","):
            tail.append(",")
            w = w[:-1]
        out.extend(CONTRACTIONS.get(w, (w,)))
        out.extend(tail)
    return out


def _convert_numbers(s: str) -> str:
    text = ""
    for w in tokenize(s):
        if w.isdigit():
            if any(ord(c) in TAI_LUE_DIGITS for c in w):
                continue
            try:
                w = spell_digits(w)
            except (ValueError, OverflowError):
                pass
        text = text + " " + w
    return text


def _map_words(s: str, fn) -> str:
    return " ".join(fn(w) for w in tokenize(s))


def normalise_token(token: str, lemmas: dict | None = None) -> list[str]:
    """The token-level tail of the chain, in its fixed order:
    superscripts, subscripts, numbers, lemma, stem, punctuation, numbers,
    stem, punctuation, stop words."""
    lem = (lambda w: lemmas.get(w, w)) if lemmas else (lambda w: w)
    s = _script_runs(token, _SUP)
    s = _script_runs(s, _SUB)
    s = _convert_numbers(s)
    s = _map_words(s, lem)
    s = _map_words(s, stem)
    s = _punct(s)
    s = _convert_numbers(s)
    s = _map_words(s, stem)
    s = _punct(s)
    return [w for w in tokenize(s) if w not in _STOP and len(w) > 1]


