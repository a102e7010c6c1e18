"""The per-label vocabulary chain, from reviews to feature words.

reviews -> cleaned words -> counts per film -> counts per label -> words common
to all labels -> what is left -> top words per label -> count vectors -> one
model per label -> reports over cut-offs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolens.functions.text import clean_tokens, drop_words
from kinolens.labels import COMMON_TOP, FEATURE_TOP, LABELS_14
from kinolens.operators.aggregates import label_word_counts, tf_vector, vocabulary_list
from kinolens.operators.joins import drop_vocabulary
from kinolens.operators.models import fit_per_label, predict_proba
from kinolens.operators.ranking import top_words
from kinolens.operators.sets import common_words, feature_words
from kinolens.operators.tokens import stop_words
from kinolens.session import materialise
from kinolens.sources.views import movies, reviews


def review_tokens(df: DataFrame, text: str = "review", stops=None):
    """Cleaned ASCII words of a review without stop words and punctuation."""
    return drop_words(clean_tokens(F.col(text), ascii_only=True), stops or stop_words(punctuation=True))


def label_dictionaries(spark: SparkSession, sf_dir: str, stops=None, store: bool = False) -> DataFrame:
    """(label, word, n) over all reviews.

    ``store`` writes the table to the shared folder and reads it back. Flows
    that use the counts more than once ask for it: otherwise the optimizer may
    push a later join below the aggregation and the text is cleaned again.
    """
    docs = reviews(spark, sf_dir)
    counts = label_word_counts(docs, review_tokens(docs, stops=stops), movies(spark, sf_dir))
    return materialise(counts, "dictionaries") if store else counts


def second_dictionaries(counts: DataFrame, common_k: int = COMMON_TOP) -> DataFrame:
    """The stored dictionaries without the words common to all labels."""
    return drop_vocabulary(counts, common_words(counts, LABELS_14, common_k))


def second_pass_words(counts: DataFrame, common_k: int = COMMON_TOP, k: int = FEATURE_TOP) -> DataFrame:
    """(word): the top ``k`` words of every label after the common words are out."""
    return feature_words(second_dictionaries(counts, common_k), k)


def genre_chain(train: DataFrame, test: DataFrame, films: DataFrame, trees=None, depth=None, store_name: str = "chain"):
    """Models of all labels from review text, and their probabilities on ``test``.

    Dictionaries are built from ``train`` and stored once; common words leave
    them, the top words of what is left are the features, documents are counted
    over those and one model is fitted per label. Both sides have review_id,
    title_url, review; ``films`` has title_url, genre_vec, labels. ``trees`` and
    ``depth`` default to the tuned values per label.
    """
    counts = materialise(label_word_counts(train, review_tokens(train), films), f"{store_name}-dictionaries")
    words = vocabulary_list(second_pass_words(counts))

    def counted(side: DataFrame) -> DataFrame:
        rows = side.join(films.select("title_url", "genre_vec"), "title_url")
        rows = rows.select("review_id", F.col("genre_vec").alias("target"), review_tokens(rows).alias("tokens"))
        return tf_vector(rows, "tokens", words).select("review_id", "target", "features")

    fitted = materialise(counted(train), f"{store_name}-features")
    models = fit_per_label(fitted, LABELS_14, trees=trees, depth=depth)
    return models, predict_proba(models, counted(test), "review_id")


def top_words_per_label(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    return top_words(label_dictionaries(spark, sf_dir), k).select("label", "rank", "word", "n")
