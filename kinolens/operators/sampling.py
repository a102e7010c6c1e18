"""Hold-out split by hash of the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_of(key: str, seed: int | None = None) -> Column:
    """Even bucket 0..99 of a key; the same on every run and partitioning."""
    text = F.col(key).cast("string")
    if seed is not None:
        text = F.concat(F.lit(str(seed)), text)
    return F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("long") % 100


def with_split(df: DataFrame, key: str, test_pct: int = 30, seed: int | None = None) -> DataFrame:
    """Adds ``is_test``: about ``test_pct`` per cent of the keys."""
    return df.withColumn("is_test", (bucket_of(key, seed) < test_pct).cast("int"))


def split(df: DataFrame, key: str, test_pct: int = 30, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test); filters only, so no row moves."""
    test = bucket_of(key, seed) < test_pct
    return df.where(~test), df.where(test)
