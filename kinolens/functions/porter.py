"""Porter's 1980 suffix stripper as a chain of array transforms.

Each step maps over the token array once. A lambda variable stands for the
word, so the result of one step is used many times by the next without the
expression growing; the whole chain stays in the JVM and in the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm: letter classes and measures.
_CONS = "[^aeiou]"
_VOWEL = "[aeiouy]"
_CONS_RUN = "[^aeiou][^aeiouy]*"
_VOWEL_RUN = "[aeiouy][aeiou]*"
M_GT_0 = f"^({_CONS_RUN})?{_VOWEL_RUN}{_CONS_RUN}"
M_EQ_1 = f"^({_CONS_RUN})?{_VOWEL_RUN}{_CONS_RUN}({_VOWEL_RUN})?$"
M_GT_1 = f"^({_CONS_RUN})?{_VOWEL_RUN}{_CONS_RUN}{_VOWEL_RUN}{_CONS_RUN}"
HAS_VOWEL = f"^({_CONS_RUN})?{_VOWEL}"
SHORT_END = f"^{_CONS_RUN}{_VOWEL}[^aeiouwxy]$"
DOUBLE_END = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"

# Fixed values of the published algorithm: (suffix, replacement) per step.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "sion", "tion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

# Marks a word that lost "ed" or "ing" and may need its ending restored.
_MARK = "\u0001"


def _chop(w: Column, k: int) -> Column:
    return F.left(w, F.length(w) - k)


def _step_1a(w: Column) -> Column:
    return (
        F.when(w.endswith("sses") | w.endswith("ies"), _chop(w, 2))
        .when(w.endswith("ss"), w)
        .when(w.endswith("s"), _chop(w, 1))
        .otherwise(w)
    )


def _step_1b(w: Column) -> Column:
    def strip(k):
        stem = _chop(w, k)
        return F.when(stem.rlike(HAS_VOWEL), F.concat(stem, F.lit(_MARK))).otherwise(w)

    return (
        F.when(w.endswith("eed"), F.when(_chop(w, 3).rlike(M_GT_0), _chop(w, 1)).otherwise(w))
        .when(w.endswith("ed"), strip(2))
        .when(w.endswith("ing"), strip(3))
        .otherwise(w)
    )


def _restore(w: Column) -> Column:
    stem = _chop(w, 1)
    with_e = F.concat(stem, F.lit("e"))
    return F.when(
        w.endswith(_MARK),
        F.when(stem.endswith("at") | stem.endswith("bl") | stem.endswith("iz"), with_e)
        .when(stem.rlike(DOUBLE_END), _chop(w, 2))
        .when(stem.rlike(SHORT_END), with_e)
        .otherwise(stem),
    ).otherwise(w)


def _step_1c(w: Column) -> Column:
    stem = _chop(w, 1)
    return F.when(w.endswith("y") & stem.rlike(HAS_VOWEL), F.concat(stem, F.lit("i"))).otherwise(w)


def _suffix_rules(w: Column, rules, measure: str) -> Column:
    """Longest matching suffix decides; its rule fires if the stem is long enough."""
    out = None
    for suffix, new in sorted(rules, key=lambda r: -len(r[0])):
        # "sion" and "tion" leave their first letter on the stem.
        stem = _chop(w, 3 if suffix in ("sion", "tion") else len(suffix))
        fired = F.when(stem.rlike(measure), F.concat(stem, F.lit(new)) if new else stem).otherwise(w)
        out = F.when(w.endswith(suffix), fired) if out is None else out.when(w.endswith(suffix), fired)
    return out.otherwise(w)


def _step_5a(w: Column) -> Column:
    stem = _chop(w, 1)
    drop = stem.rlike(M_GT_1) | (stem.rlike(M_EQ_1) & ~stem.rlike(SHORT_END))
    return F.when(w.endswith("e") & drop, stem).otherwise(w)


def _step_5b(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(M_GT_1), _chop(w, 1)).otherwise(w)


def stem_tokens(tokens) -> Column:
    """Stem every word of a token array, keeping order and length."""
    words = F.col(tokens) if isinstance(tokens, str) else tokens
    stems = words
    for step in (
        _step_1a,
        _step_1b,
        _restore,
        _step_1c,
        lambda w: _suffix_rules(w, STEP_2, M_GT_0),
        lambda w: _suffix_rules(w, STEP_3, M_GT_0),
        lambda w: _suffix_rules(w, [(s, "") for s in STEP_4], M_GT_1),
        _step_5a,
        _step_5b,
    ):
        stems = F.transform(stems, step)
    return F.zip_with(words, stems, lambda w, s: F.when(F.length(w) > 2, s).otherwise(w))


def porter_stem(c) -> Column:
    """Stem one word."""
    word = F.col(c) if isinstance(c, str) else c
    return F.get(stem_tokens(F.array(word)), F.lit(0))
