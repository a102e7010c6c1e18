"""Lexicon sentiment: a learned polarity per word, scored per text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinolens.functions.arrays import round_half_even
from kinolens.functions.text import count_words, split_words
from kinolens.labels import POLARITY_CUTOFFS
from kinolens.operators.aggregates import mean_sentence_score, weighted_sentence_score
from kinolens.operators.tokens import cleaned_document, sentence_tokens
from kinolens.session import materialise

#: Words of a block of units; one longer unit is a block of its own.
BLOCK_WORDS = 1 << 19

TextScorer = Callable[[Sequence[str]], np.ndarray]


def learn_polarity(df: DataFrame, tokens, sentiment: str = "sentiment", smooth: int = 1) -> DataFrame:
    """(word, polarity): how much more often a word is used in positive texts.

    ``(p - n) / (p + n + smooth)`` over the occurrences in positive and
    negative texts, so rare words stay close to 0.
    """
    words = df.select(F.col(sentiment).alias("s"), F.inline(count_words(tokens)))
    counts = words.groupBy("word").agg(
        F.sum(F.when(F.col("s") == 1, F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("s") == 0, F.col("n")).otherwise(0)).alias("n"),
    )
    ratio = (F.col("p") - F.col("n")) / (F.col("p") + F.col("n") + smooth)
    return counts.select("word", ratio.alias("polarity"))


def _in_blocks(units: DataFrame, words: str) -> DataFrame:
    """``units`` with ``__block``: a number shared by neighbouring rows of a task with about ``BLOCK_WORDS`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(words)), 0).to_numpy(zero_copy_only=False)
            numbers = np.empty(batch.num_rows, np.int64)
            for i, size in enumerate(sizes.tolist()):
                if held and held + size > BLOCK_WORDS:
                    number, held = number + 1, 0
                numbers[i], held = number, held + size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], [*batch.schema.names, "__block"])

    return units.mapInArrow(run, T.StructType([*units.schema.fields, T.StructField("__block", T.LongType())]))


def _score_words(units: DataFrame, keys, words: Column, lexicon: DataFrame) -> DataFrame:
    """Average polarity of the known words of each unit, and their share.

    Units stand in blocks of bounded size, and only the different words of a
    block meet the lexicon in a join; what they find goes back to the block,
    whose units add it up. So the shuffles carry each text once and a block's
    vocabulary, not a row per word and unit. Units without any known word stay;
    units that repeat all keys and their number of words are one.
    """
    known = materialise(lexicon.select("word", "polarity"), "lexicon")
    sized = units.select(*keys, words.cast("array<string>").alias("__words"))
    sized = materialise(_in_blocks(sized, "__words"), "lexicon-units")
    found = sized.select(F.col("__block").alias("block"), F.explode("__words").alias("word")).distinct().join(known, "word")
    fields = [sized.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("total", T.LongType()), T.StructField("sum", T.DoubleType()), T.StructField("known", T.LongType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        column = left.column("__words").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        unit = np.repeat(np.arange(len(sizes)), sizes)
        # A block that finds nothing comes with a table without columns.
        word, value = (right.column(c).combine_chunks() for c in ("word", "polarity")) if right.num_rows else (pa.array([], pa.string()), pa.array([], pa.float64()))
        at = pc.index_in(column.flatten(), value_set=word, skip_nulls=True)
        hit = pc.is_valid(at).to_numpy(zero_copy_only=False)
        polarity = value.to_numpy(zero_copy_only=False)[at.drop_null().to_numpy()]
        number = np.bincount(unit[hit], minlength=len(sizes))
        sums = np.bincount(unit[hit], polarity, len(sizes)).astype(np.float64)
        return pa.table([*[left.column(k) for k in keys], pa.array(sizes), pa.array(sums), pa.array(number.astype(np.int64))], [*keys, "total", "sum", "known"])

    parts = sized.groupBy("__block").cogroup(found.groupBy("block")).applyInArrow(run, schema)
    sums = parts.groupBy(*keys, "total").agg(F.sum("sum").alias("sum"), F.sum("known").alias("known"))
    polarity = F.coalesce(F.try_divide("sum", "known"), F.lit(0.0))
    share = F.coalesce(F.try_divide("known", "total"), F.lit(0.0))
    return sums.select(*keys, polarity.alias("polarity"), share.alias("subjectivity"))


def lexicon_sentiment(df: DataFrame, key: str, tokens, lexicon: DataFrame) -> DataFrame:
    """Polarity in [-1, 1] and subjectivity in [0, 1] of every text.

    Subjectivity is the share of words that the lexicon knows. A text without
    any known word is neutral.
    """
    words = F.col(tokens) if isinstance(tokens, str) else tokens
    return _score_words(df, [key], words, lexicon)


def classify_polarity(df: DataFrame, cutoff: float | None = None) -> DataFrame:
    """0/1 class: from ``cutoff`` upward, or by rounding half to even."""
    p = F.col("polarity")
    rounded = (round_half_even(p) > 0).cast("int")
    return df.withColumn("prediction", rounded if cutoff is None else (p >= cutoff).cast("int"))


def polarity_sweep(df: DataFrame, actual: str, cutoffs=tuple(POLARITY_CUTOFFS)) -> DataFrame:
    """Counts, accuracy, precision and sensitivity at every cut-off, in one pass.

    Ratios without rows are 0.
    """
    p, a = F.col("polarity"), F.col(actual)
    cells = [
        F.struct(
            F.lit(float(c)).alias("cutoff"),
            F.count_if((p >= c) & (a == 1)).alias("tp"),
            F.count_if((p >= c) & (a == 0)).alias("fp"),
            F.count_if((p < c) & (a == 1)).alias("fn"),
            F.count_if((p < c) & (a == 0)).alias("tn"),
        )
        for c in cutoffs
    ]
    counts = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    right, total = F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")

    def ratio(part: Column, whole: Column, name: str) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0)).alias(name)

    return counts.select(
        "*", ratio(right, total, "accuracy"), ratio(F.col("tp"), F.col("tp") + F.col("fp"), "precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn"), "sensitivity"),
    )


def score_sentiment(
    df: DataFrame, key: str, text: str, lexicon: DataFrame | None = None,
    scorer: TextScorer | None = None, by: str = "doc", batch: int = 100,
) -> DataFrame:
    """One score in [0, 1] per document or per sentence.

    A ``scorer`` gets lists of at most ``batch`` texts inside the tasks.
    Without one, the lexicon's polarity is mapped to [0, 1]. Sentence rows
    carry their number and length for the averages.
    """
    if by == "sentence":
        units = sentence_tokens(df, key, text).select(key, "pos", F.col("sentence").alias("text"), "words")
        units = units.withColumn("len", F.length("text").cast("long"))
        keys = [key, "pos"]
    else:
        units = df.select(key, cleaned_document(text).alias("text"))
        units = units.withColumn("words", split_words("text"))
        units = units.withColumn("len", F.length("text").cast("long"))
        keys = [key]
    if scorer is not None:
        return _score_with(units.select(*keys, "text", "len"), keys, scorer, batch)
    if lexicon is None:
        raise ValueError("give a lexicon or a scorer")
    scored = _score_words(units, [*keys, "len"], F.col("words"), lexicon)
    return scored.select(*keys, "len", ((F.col("polarity") + 1) / 2).alias("score"))


def _score_with(units: DataFrame, keys, scorer: TextScorer, batch: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                out = part[[*keys, "len"]].copy()
                out["score"] = np.asarray(scorer(part["text"].tolist()), dtype=float)
                yield out

    fields = [units.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("len", T.LongType()), T.StructField("score", T.DoubleType())])
    return units.mapInPandas(run, schema)


def sentiment_predictions(
    scores: DataFrame, labels: DataFrame, key: str, actual: str, weighted: bool = False
) -> DataFrame:
    """id, percent_prediction, prediction and actual from sentence scores."""
    per_doc = (weighted_sentence_score if weighted else mean_sentence_score)(scores, key)
    percent = F.col("score")
    return per_doc.join(labels.select(key, actual), key).select(
        F.col(key).alias("id"),
        percent.alias("percent_prediction"),
        round_half_even(percent).alias("prediction"),
        F.col(actual).cast("int").alias("actual"),
    )
