"""Normalising and tokenising text.

Every function builds one Column out of JVM expressions, so a text is cleaned,
split and counted inside the row that holds it: none of this needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the cleaner removes, pads and folds into one number token.
CONTRACTION_MARKS = r"['-]"
NON_WORD_RUN = r"([^\p{L}\p{N}_]+)"
NUMBER_TOKEN = r"(?<=\s)(\d+|\w\d+|\d+\w)(?=\s)"
NUMBER_WORD = "000"
NON_ASCII = r"[^\x00-\x7F]"
NON_LETTER = r"[^a-zA-Z]"
SENTENCE_END = r"([.!?])\s+"

_BREAK = "\u0001"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c, ascii_only: bool = False) -> Column:
    """Lower-case text with separated symbols and folded numbers.

    Result is padded with one space on either side, so an empty text gives a
    single space. ``ascii_only`` turns every non-ASCII character into a space
    first.
    """
    text = _col(c)
    if ascii_only:
        text = F.regexp_replace(text, NON_ASCII, " ")
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    joined = F.regexp_replace(padded, CONTRACTION_MARKS, "")
    spaced = F.regexp_replace(joined, NON_WORD_RUN, " $1 ")
    folded = F.regexp_replace(spaced, NUMBER_TOKEN, NUMBER_WORD)
    return F.regexp_replace(folded, r"\s+", " ")


def split_words(c) -> Column:
    """Words between runs of (Unicode) white space; never an empty word."""
    return F.array_remove(F.split(_col(c), r"(?U)\s+"), "")


def clean_tokens(c, ascii_only: bool = False) -> Column:
    """Words of :func:`clean_text`."""
    cleaned = clean_text(c, ascii_only)
    if ascii_only:
        return F.array_remove(F.split(cleaned, " "), "")
    return split_words(cleaned)


def letters_only_tokens(c) -> Column:
    """Lower-case runs of ASCII letters."""
    return F.array_remove(F.split(F.lower(F.regexp_replace(_col(c), NON_LETTER, " ")), " "), "")


def split_sentences(c) -> Column:
    """Sentences, cut after ``.``, ``!`` or ``?`` followed by white space."""
    marked = F.regexp_replace(F.regexp_replace(_col(c), r"^\s+|\s+$", ""), SENTENCE_END, "$1" + _BREAK)
    return F.array_remove(F.split(marked, _BREAK), "")


def space_punctuation(c) -> Column:
    """One space after sentence marks; spaced-out ellipses are closed again."""
    text = _col(c)
    # Fixed values, applied in this order.
    for old, new in [(".", ". "), ("?", "? "), ("!", "! "), (". . . ", "...")]:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def word_count(c) -> Column:
    """Number of words between white space."""
    return F.size(F.array_remove(F.split(_col(c), r"\s+"), ""))


def replace_newlines(c) -> Column:
    return F.replace(_col(c), F.lit("\n"), F.lit(" "))


def drop_words(tokens, words) -> Column:
    """Tokens that are not in a short literal list."""
    stop = list(words)
    return F.filter(_col(tokens), lambda w: ~w.isin(stop))


def count_words(tokens) -> Column:
    """``array<struct<word,n>>`` for one token array, in word order.

    Sorting the array puts equal words side by side; the end position of each
    run then gives its length. All inside the row: counting the words of a
    document costs no shuffle, however long the document is.
    """
    ordered = F.sort_array(_col(tokens))

    def runs(words):
        size = F.size(words)
        ends = F.filter(
            F.transform(words, lambda w, i: F.when((i + 1 == size) | (w != F.get(words, i + 1)), i + 1)),
            lambda e: e.isNotNull(),
        )
        return F.transform(
            F.array(ends),
            lambda es: F.transform(
                es,
                lambda e, j: F.struct(
                    F.get(words, e - 1).alias("word"),
                    (e - F.coalesce(F.get(es, j - 1), F.lit(0))).cast("long").alias("n"),
                ),
            ),
        )

    # The one-element arrays bind `ordered` and `ends` to lambda variables, so
    # neither is evaluated again for every element.
    return F.flatten(F.flatten(F.transform(F.array(ordered), runs)))
