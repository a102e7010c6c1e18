"""From review text to words, sentences and formatted documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolens.functions.arrays import strip_outer
from kinolens.functions.html import html_to_text
from kinolens.functions.porter import stem_tokens
from kinolens.functions.text import (
    clean_text,
    clean_tokens,
    drop_words,
    letters_only_tokens,
    space_punctuation,
    split_sentences,
)
from kinolens.labels import ENGLISH_STOP_WORDS, STOP_PUNCTUATION

Tokeniser = Callable[[Column], Column]

TOKENISERS: dict[str, Tokeniser] = {
    "letters": letters_only_tokens,
    "clean": clean_tokens,
    "clean_ascii": lambda c: clean_tokens(c, ascii_only=True),
}


def stop_words(punctuation: bool = False, cleaned: bool = False) -> list[str]:
    """English stop words, with the punctuation tokens when asked for.

    Cleaning removes apostrophes before words are compared, so entries such as
    ``don't`` never match; ``cleaned`` adds them without their apostrophe.
    """
    words = list(ENGLISH_STOP_WORDS)
    if punctuation:
        words += STOP_PUNCTUATION
    if cleaned:
        words += [w.replace("'", "") for w in ENGLISH_STOP_WORDS if "'" in w]
    return words


def tokenise(c, method: str | Tokeniser = "clean") -> Column:
    """Token array by a named tokeniser, or by any ``Column -> Column``."""
    col = F.col(c) if isinstance(c, str) else c
    return (method if callable(method) else TOKENISERS[method])(col)


def review_to_words(c, method="letters", stem: bool = False, stop: bool = False) -> Column:
    """Words of a raw review: markup out, then stop words, then stems."""
    words = tokenise(html_to_text(c), method)
    if stop:
        words = drop_words(words, stop_words())
    return stem_tokens(words) if stem else words


def remove_stop_words(tokens: DataFrame, words: list[str], word: str = "word") -> DataFrame:
    """Token rows without the words of a short literal list."""
    return tokens.where(~F.col(word).isin(list(words)))


def sentence_tokens(df: DataFrame, key: str, text: str, method="letters") -> DataFrame:
    """One row per sentence with its words; sentences without words stay."""
    sentences = df.select(key, F.posexplode(split_sentences(html_to_text(text))).alias("pos", "sentence"))
    return sentences.select(key, "pos", "sentence", tokenise("sentence", method).alias("words"))


def format_reviews(df: DataFrame, key: str, text: str, method: str = "bagofwords") -> DataFrame:
    """Reviews as joined text, as word array, or as tagged document."""
    if method == "bagofwords":
        value = F.array_join(review_to_words(text, "clean"), " ")
    elif method == "word2vec":
        value = review_to_words(text, "clean")
    elif method == "doc2vec":
        words = review_to_words(text, "clean", stop=True)
        value = F.struct(F.col(key).cast("string").alias("id"), words.alias("words"))
    else:
        raise ValueError("method must be 'bagofwords', 'word2vec' or 'doc2vec'")
    return df.select(key, value.alias("formatted"))


def strip_review(c) -> Column:
    """Markup out, surrounding quotes off, one space after sentence marks."""
    return space_punctuation(strip_outer(html_to_text(c)))


def cleaned_document(c) -> Column:
    """Cleaned text of a raw review."""
    return clean_text(html_to_text(c))
