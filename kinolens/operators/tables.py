"""Keyed tables: scans, insert-if-absent, update-by-key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.operators.ranking import dedupe_first


def scan_missing(df: DataFrame, field: str, cols, key: str, limit: int | None = None) -> DataFrame:
    """Rows whose ``field`` is not filled yet; at most ``limit``, in key order."""
    rows = df.where(F.col(field).isNull()).select(*cols)
    return rows if limit is None else rows.orderBy(key).limit(limit)


def scan_projection(df: DataFrame, cols) -> DataFrame:
    """Full scan of a few columns."""
    return df.select(*cols)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str, order) -> DataFrame:
    """``existing`` plus the first row of every key that it does not hold yet."""
    first = dedupe_first(incoming, key, order)
    new = first.join(existing.select(key), key, "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)


def rejected_duplicates(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Keys that :func:`insert_if_absent` turns away, with how many rows each."""
    arriving = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("arrived"))
    known = existing.select(key).distinct().withColumn("known", F.lit(1))
    taken = F.when(F.col("known").isNull(), 1).otherwise(0)
    return (
        arriving.join(known, key, "left")
        .select(key, (F.col("arrived") - taken).alias("rejected"))
        .where(F.col("rejected") > 0)
    )


def update_by_key(base: DataFrame, updates: DataFrame, key: str, cols) -> DataFrame:
    """Set ``cols`` on the rows with a matching key, all of them in one write.

    ``updates`` holds one row per key. Columns that ``base`` lacks are added;
    where there is no update, or it is null, the old value stays.
    """
    cols = list(cols)
    fresh = updates.select(key, *[F.col(c).alias(f"__new_{c}") for c in cols])
    joined = base.join(fresh, key, "left")
    kept = [F.col(c) for c in base.columns if c not in cols]
    old = {c: F.col(c) if c in base.columns else F.lit(None) for c in cols}
    return joined.select(*kept, *[F.coalesce(F.col(f"__new_{c}"), old[c]).alias(c) for c in cols])


def preview(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row: rows, columns and the text of the first key."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("int").alias("n_cols"),
        F.min_by(text, key).alias("first_text"),
    )


def count_missing(df: DataFrame, field: str) -> DataFrame:
    """How many rows still lack ``field``."""
    return df.agg(F.count_if(F.col(field).isNull()).alias("missing"), F.count(F.lit(1)).alias("total"))


def min_words(df: DataFrame, text: str, n: int = 500, count_col: str = "wd_ct") -> DataFrame:
    """Rows with strictly more than ``n`` words; counts them when needed."""
    from kinolens.functions.text import word_count

    if count_col not in df.columns:
        df = df.withColumn(count_col, word_count(text))
    return df.where(F.col(count_col) > n)


def with_target(df: DataFrame, target: str, features) -> DataFrame:
    """Features and the target, renamed ``target``; everything else is dropped."""
    return df.select(*features, F.col(target).alias("target"))


def drop_labels(df: DataFrame, labels) -> DataFrame:
    """Long scores without the given labels."""
    return df.where(~F.col("label").isin(list(labels)))
