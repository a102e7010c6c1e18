"""Classification reports and losses at one or many cut-offs.

Scores are long: one row per (id, label) with ``actual`` 0/1 and either a
``prediction`` 0/1 or a probability ``p``. Cut-offs never multiply the rows:
each is a set of conditional sums in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolens.labels import CUTOFFS

TOTAL = "avg / total"


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _cell(pred: Column, actual: Column, **extra) -> Column:
    return F.struct(
        *[v.alias(k) for k, v in extra.items()],
        F.count_if(pred & (actual == 1)).alias("tp"),
        F.count_if(pred & (actual == 0)).alias("fp"),
        F.count_if(~pred & (actual == 1)).alias("fn"),
    )


def with_ratios(counts: DataFrame, keys) -> DataFrame:
    """Precision, recall, F1 and support from tp, fp and fn."""
    p = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    rated = counts.select(*keys, p.alias("precision"), r.alias("recall"), (F.col("tp") + F.col("fn")).alias("support"))
    pr = F.col("precision") + F.col("recall")
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), pr)
    return rated.select(*keys, "precision", "recall", f1.alias("f1"), "support")


def weighted_average(rated: DataFrame, by=()) -> DataFrame:
    """Support-weighted averages of per-label rows."""
    total = F.sum("support")
    means = [
        F.coalesce(F.try_divide(F.sum(F.col(m) * F.col("support")), total), F.lit(0.0)).alias(m)
        for m in ("precision", "recall", "f1")
    ]
    return rated.groupBy(*by).agg(*means, total.alias("support"))


def with_footer(rated: DataFrame, by=()) -> DataFrame:
    """Per-label rows followed by their averages under one more label."""
    footer = weighted_average(rated, by).withColumn("label", F.lit(TOTAL))
    return rated.unionByName(footer.select(*rated.columns))


def classification_report(df: DataFrame, prediction: str = "prediction", actual: str = "actual") -> DataFrame:
    """Per label precision, recall, F1 and support, with the averages."""
    cell = _cell(F.col(prediction) == 1, F.col(actual))
    counts = df.groupBy(F.col("label").cast("string").alias("label")).agg(cell.alias("c")).select("label", "c.*")
    return with_footer(with_ratios(counts, ["label"]))


def threshold_counts(df: DataFrame, cutoffs=tuple(CUTOFFS)) -> DataFrame:
    """(cutoff, label, tp, fp, fn) for all cut-offs from one aggregation."""
    cells = [_cell(F.col("p") >= c, F.col("actual"), cutoff=F.lit(float(c))) for c in cutoffs]
    per_label = df.groupBy(F.col("label").cast("string").alias("label")).agg(F.array(*cells).alias("cells"))
    return per_label.select("label", F.inline("cells"))


def threshold_sweep(df: DataFrame, cutoffs=tuple(CUTOFFS)) -> DataFrame:
    """A classification report per cut-off."""
    return with_footer(with_ratios(threshold_counts(df, cutoffs), ["cutoff", "label"]), ["cutoff"])


def best_threshold(df: DataFrame, cutoffs=tuple(CUTOFFS)) -> DataFrame:
    """The cut-off with the highest weighted F1; the lower one wins a tie."""
    rated = with_ratios(threshold_counts(df, cutoffs), ["cutoff", "label"])
    averages = weighted_average(rated, ["cutoff"])
    return averages.agg(
        F.max_by("cutoff", F.struct("f1", -F.col("cutoff"))).alias("cutoff"), F.max("f1").alias("f1")
    )


def zero_one_loss(df: DataFrame, key: str = "id") -> DataFrame:
    """Share of rows whose label vector differs anywhere."""
    wrong = df.groupBy(key).agg(F.max((F.col("prediction") != F.col("actual")).cast("int")).alias("wrong"))
    return wrong.agg(F.avg("wrong").alias("zero_one_loss"))


def zero_one_sweep(df: DataFrame, cutoffs=tuple(CUTOFFS), key: str = "id") -> DataFrame:
    """Zero-one loss at every cut-off: one shuffle by id for all of them."""
    flags = [
        F.max(((F.col("p") >= c).cast("int") != F.col("actual")).cast("int")).alias(f"w{i}")
        for i, c in enumerate(cutoffs)
    ]
    wrong = df.groupBy(key).agg(*flags)
    cells = [
        F.struct(F.lit(float(c)).alias("cutoff"), F.avg(f"w{i}").alias("zero_one_loss"))
        for i, c in enumerate(cutoffs)
    ]
    return wrong.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def zero_one_loss_vectors(df: DataFrame, prediction: str, actual: str) -> DataFrame:
    """The same loss for rows that hold whole label vectors: no shuffle by id."""
    return df.agg(F.avg((F.col(prediction) != F.col(actual)).cast("int")).alias("zero_one_loss"))


def hamming_loss(df: DataFrame) -> DataFrame:
    """Share of wrong label cells."""
    return df.agg(F.avg((F.col("prediction") != F.col("actual")).cast("int")).alias("hamming_loss"))


def binary_report(df: DataFrame, by=()) -> DataFrame:
    """Accuracy, precision and sensitivity per method."""
    p, a = F.col("prediction"), F.col("actual")
    tp, fp = F.count_if((p == 1) & (a == 1)), F.count_if((p == 1) & (a == 0))
    fn = F.count_if((p == 0) & (a == 1))
    return df.groupBy(*by).agg(
        F.avg((p == a).cast("int")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("sensitivity"),
        F.count(F.lit(1)).alias("n"),
    )


def random_guess_baseline(support: DataFrame, n_rows: Column) -> DataFrame:
    """Weighted F1 of guessing every label at its own prevalence."""
    prevalence = F.col("n") / n_rows
    return support.agg(
        F.try_divide(F.sum(prevalence * F.col("n")), F.sum("n")).alias("expected_f1")
    )
