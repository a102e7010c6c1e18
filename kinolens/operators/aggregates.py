"""Counts, vocabularies, weights and statistics."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.functions.arrays import names_of
from kinolens.functions.text import count_words, word_count
from kinolens.labels import MAX_FEATURES
from kinolens.operators.joins import small_side
from kinolens.operators.vector_sums import sum_word_vectors
from kinolens.session import materialise


def term_counts(df: DataFrame, key: str, tokens) -> DataFrame:
    """(key, word, n), counted inside each row: no shuffle."""
    return df.select(key, F.inline(count_words(tokens)))


def explode_labels(df: DataFrame, vector: str, labels) -> DataFrame:
    """One row per label that is on; the vector column is dropped."""
    kept = [c for c in df.columns if c != vector]
    return df.select(*kept, F.explode(names_of(vector, labels)).alias("label"))


def label_word_counts(reviews: DataFrame, tokens, movie_labels: DataFrame, key: str = "title_url") -> DataFrame:
    """Occurrences per (label, word); a review counts for every label of its film.

    Words are counted per review and then per film. Only then do film labels
    come in, so text never travels through the join, a film with very many
    reviews is already reduced to its vocabulary, and each count is multiplied
    by the labels as late as possible. ``movie_labels`` has (key, labels array).
    """
    per_film = term_counts(reviews, key, tokens).groupBy(key, "word").agg(F.sum("n").alias("n"))
    labelled = per_film.join(movie_labels.select(key, "labels"), key)
    exploded = labelled.select(F.explode("labels").alias("label"), "word", "n")
    return exploded.groupBy("label", "word").agg(F.sum("n").alias("n"))


def corpus_vocabulary(df: DataFrame, tokens, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent words of the corpus with their counts; ties by word."""
    counts = df.select(F.inline(count_words(tokens))).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(max_features)


def bag_of_words(df: DataFrame, key: str, tokens, vocab: DataFrame) -> DataFrame:
    """(key, word, n) restricted to the words of ``vocab``."""
    counts = term_counts(df, key, tokens)
    return counts.join(small_side(vocab.select("word")), "word").select(key, "word", "n")


def vocabulary_list(vocab: DataFrame, max_features: int = MAX_FEATURES) -> list[str]:
    """A bounded vocabulary in alphabetical order, as vector positions."""
    words = [r.word for r in vocab.select("word").limit(max_features + 1).collect()]
    if len(words) > max_features:
        raise ValueError(f"vocabulary has more than {max_features} words")
    return sorted(words)


def tf_vector(df: DataFrame, tokens: str, words: list[str], out: str = "features") -> DataFrame:
    """Sparse count vector per row over ``words``; one map, no shuffle."""
    model = CountVectorizerModel.from_vocabulary(words, inputCol=tokens, outputCol=out)
    return model.transform(df)


def tf_array(df: DataFrame, tokens: str, words: list[str], out: str = "tf") -> DataFrame:
    """:func:`tf_vector` as a dense array of int."""
    vectors = tf_vector(df, tokens, words, "__tf")
    return vectors.withColumn(out, vector_to_array("__tf").cast("array<int>")).drop("__tf")


def tf_idf(df: DataFrame, key: str, tokens, threshold: int = 0, relative: bool = False) -> DataFrame:
    """TF-IDF weight of each word of each document: ``tf * ln(N / df)``.

    ``threshold`` drops words that occur that often or less in a document;
    ``relative`` divides by the number of words left in it. Both are done in
    the row, before anything is exploded. The counts are stored and read for the
    document frequencies and for the join by word, whose hot words are split by
    adaptive execution. N is a scalar subquery.
    """
    counted = df.select(key, count_words(tokens).alias("__counts"))
    if threshold:
        counted = counted.withColumn("__counts", F.filter("__counts", lambda c: c["n"] > threshold))
    total = F.aggregate(F.col("__counts.n"), F.lit(0).cast("long"), lambda acc, n: acc + n)
    # The outer form keeps the optimizer from testing the size of the array first,
    # which would count the words of every document a second time.
    kept = counted.withColumn("total", total).select(key, "total", F.inline_outer("__counts"))
    kept = materialise(kept.where(F.col("word").isNotNull()), "counts")
    # Stored before the join: adaptive execution splits a hot word only if both
    # sides of the join are plain exchanges, and the text is not counted twice.
    spread = materialise(kept.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "document-frequencies")
    n_docs = df.agg(F.count(F.lit(1)).alias("N")).scalar()
    tf = F.col("n") / F.col("total") if relative else F.col("n").cast("double")
    weight = tf * F.log(n_docs / F.col("df"))
    return kept.join(spread, "word").select(key, "word", "n", "df", weight.alias("weight"))


def _billionths(score: str):
    return F.round(F.col(score) * 1_000_000_000).cast("long")


def mean_sentence_score(df: DataFrame, key: str, score: str = "score") -> DataFrame:
    """(key, score, total, size): the plain average of the sentence scores.

    Scores are added as whole billionths (``total``) and divided once by their
    number (``size``), so the mean does not depend on the order of the rows and
    is not rounded. Null when there are none.
    """
    return _mean(df.groupBy(key).agg(F.sum(_billionths(score)).alias("total"), F.count(score).alias("size")), key)


def weighted_sentence_score(df: DataFrame, key: str, score: str = "score", length: str = "len") -> DataFrame:
    """The same average weighted by sentence length."""
    size = F.sum(F.when(F.col(score).isNotNull(), F.col(length)))
    return _mean(df.groupBy(key).agg(F.sum(_billionths(score) * F.col(length)).alias("total"), size.alias("size")), key)


def _mean(sums: DataFrame, key: str) -> DataFrame:
    mean = F.try_divide(F.col("total"), F.col("size") * 1_000_000_000)
    return sums.select(key, mean.alias("score"), "total", "size")


def sum_vectors(
    docs: DataFrame,
    key: str,
    tokens,
    vectors: DataFrame,
    dim: int,
    combine: str = "sum",
) -> DataFrame:
    """Document vector from word vectors: repeats count, unknown words do not.

    Words are counted in the row; the vectors are added up by
    :func:`kinolens.operators.vector_sums.sum_word_vectors`, one aggregate for all
    dimensions. Documents with no known word get zeros, rows of one key are one
    document. ``combine='mean'`` divides by the known words.
    """
    counted = docs.select(key, F.coalesce(count_words(tokens), F.array().cast("array<struct<word:string,n:bigint>>")).alias("__c"))
    counts = counted.select(key, F.col("__c.word").alias("words"), F.col("__c.n").cast("array<long>").alias("ns"))
    total = sum_word_vectors(counts, key, vectors, dim)
    if combine != "mean":
        return total
    size = F.greatest("known", F.lit(1))
    return total.select(key, F.transform("vec", lambda x: x / size).alias("vec"), "known")


def label_distribution(df: DataFrame, vector: str, labels) -> DataFrame:
    """Rows per label: one conditional sum per label, then turned long."""
    v = F.col(vector)
    cells = [
        F.struct(F.lit(x).alias("label"), F.count_if(F.get(v, F.lit(i)) == 1).alias("n"))
        for i, x in enumerate(labels)
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def genre_combinations(movies: DataFrame, genres: str = "genre") -> DataFrame:
    """Distinct genre mixes, mixes used once, and most genres on one film."""
    mixes = movies.groupBy(genres).agg(
        F.count(F.lit(1)).alias("films"),
        F.max(F.size(F.array_remove(F.split(genres, r" \| "), ""))).alias("width"),
    )
    return mixes.agg(
        F.count(F.lit(1)).alias("mixes"),
        F.count_if(F.col("films") == 1).alias("singletons"),
        F.max("width").cast("int").alias("max_genres"),
    )


def corpus_by_min_words(df: DataFrame, text: str, cuts=(0, 200, 500)) -> DataFrame:
    """Rows with more words than each cut, in one pass."""
    counted = df.select(word_count(text).alias("wc"))
    cells = [
        F.struct(F.lit(c).cast("int").alias("min_words"), F.count_if(F.col("wc") > c).alias("n_reviews")) for c in cuts
    ]
    return counted.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def reviews_per_film(df: DataFrame, key: str = "title_url") -> DataFrame:
    """Number of films and reviews; mean, least and most reviews per film."""
    per_film = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_film.agg(
        F.count(F.lit(1)).alias("films"),
        F.sum("n").alias("reviews"),
        F.avg("n").alias("mean_reviews"),
        F.min("n").alias("min_reviews"),
        F.max("n").alias("max_reviews"),
    )
