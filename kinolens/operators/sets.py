"""Unions of corpora and set operations on per-label vocabularies."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.labels import COMMON_TOP, FEATURE_TOP
from kinolens.operators.joins import drop_vocabulary
from kinolens.operators.ranking import top_words


def union_corpora(*frames: DataFrame) -> DataFrame:
    """All rows of all corpora; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def common_words(counts: DataFrame, labels, k: int = COMMON_TOP) -> DataFrame:
    """Words among the top ``k`` of every label: the domain's own stop words."""
    per_word = top_words(counts, k).groupBy("word").agg(F.count(F.lit(1)).alias("n_labels"))
    return per_word.where(F.col("n_labels") == len(labels)).select("word")


def feature_words(counts: DataFrame, k: int = FEATURE_TOP) -> DataFrame:
    """Words among the top ``k`` of at least one label."""
    return top_words(counts, k).select("word").distinct()


def merge_stop_words(*sets: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.union(b), [s.select("word") for s in sets]).distinct()


def label_overlap(counts: DataFrame, labels, k: int) -> DataFrame:
    """Shared top words for each pair of labels, with Jaccard similarity.

    Each word becomes one row of 0/1 flags over the fixed label list, and the
    pairs are conditional sums over those rows: no self-join, one pass.
    """
    labels = sorted(labels)
    top = top_words(counts, k)
    flags = top.groupBy("word").agg(
        *[F.max((F.col("label") == x).cast("int")).alias(f"f{i}") for i, x in enumerate(labels)]
    )
    cells = [
        F.expr(
            f"named_struct('label_a', '{labels[i]}', 'label_b', '{labels[j]}',"
            f" 'shared', sum(f{i} * f{j}), 'together', sum(greatest(f{i}, f{j})))"
        )
        for i, j in combinations(range(len(labels)), 2)
    ]
    long = flags.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return long.select(
        "label_a",
        "label_b",
        F.coalesce("shared", F.lit(0)).cast("long").alias("shared"),
        F.when(F.col("together") > 0, F.col("shared") / F.col("together")).otherwise(F.lit(0.0)).alias("jaccard"),
    )


def distinctive_words(counts: DataFrame, labels, k: int, common_k: int = COMMON_TOP) -> DataFrame:
    """Top words per label after the words common to all labels are removed."""
    common = common_words(counts, labels, common_k)
    return top_words(drop_vocabulary(counts, common), k)


def distinctive_by_weight(counts: DataFrame, n_labels: int, k: int) -> DataFrame:
    """Top words per label by n * ln(L / labels using the word)."""
    spread = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weighted = counts.join(spread, "word").withColumn(
        "weight", F.col("n") * F.log(F.lit(float(n_labels)) / F.col("df"))
    )
    return top_words(weighted, k, n="weight")
