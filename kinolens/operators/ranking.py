"""Ranking, top-k, de-duplication and numbering of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinolens.functions.text import word_count
from kinolens.session import materialise


def _cols(x) -> list:
    return list(x) if isinstance(x, (list, tuple)) else [x]


def top_k_by(df: DataFrame, keys, order, k: int, salts: int = 64, rank: str | None = None) -> DataFrame:
    """The ``k`` first rows of every key.

    Spark cuts a ranking before its shuffle up to the k that its setting names.
    Beyond it, a key with a third of all rows would be sorted in one task, so
    every key is first ranked within ``salts`` hash slices and only the k best of each slice go
    on; the result is the same.
    """
    keys, order = _cols(keys), _cols(order)
    name = rank or "__rank"
    spark = df.sparkSession
    if k > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        slice_of = F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(salts))
        local = Window.partitionBy(*keys, "__salt").orderBy(*order)
        df = (
            df.withColumn("__salt", slice_of)
            .withColumn("__local", F.row_number().over(local))
            .where(F.col("__local") <= k)
            .drop("__salt", "__local")
        )
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    ranked = ranked.where(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def dedupe_first(df: DataFrame, key, order) -> DataFrame:
    """First row of every key in ``order``; the rank limit runs before the shuffle."""
    return top_k_by(df, key, order, 1)


def review_mark(text: str) -> Column:
    """Tells reviews at one position apart."""
    return F.xxhash64(F.col(text))


def longest_order(wc: str, pos: str, mark: str) -> Column:
    """Greatest for the review to take: most words, then the earliest position (a null one last), then its mark."""
    return F.struct(F.col(wc).alias("wc"), (-F.col(pos)).alias("first"), F.col(mark).alias("mark"))


def with_text(reviews: DataFrame, chosen: DataFrame, film: str, text: str, pos: str) -> DataFrame:
    """One row of ``reviews`` with ``wc`` per row of ``chosen`` (film, pos, wc, mark); repeats of a row count once."""
    picked = chosen.select(F.col(film).alias("__film"), F.col(pos).alias("__pos"), "wc", F.col("mark").alias("__m"))
    same = (F.col(film) == F.col("__film")) & F.col(pos).eqNullSafe(F.col("__pos")) & (F.col("__mark") == F.col("__m"))
    marked = reviews.withColumn("__mark", review_mark(text)).withColumn("__row", _row_hash(reviews))
    found = marked.join(picked, same)
    # Rows of one film and mark hold the same text; of those that differ elsewhere the greatest row hash is taken.
    best = materialise(found.groupBy("__film").agg(F.max("__row").alias("__best")), "longest-row")
    rows = found.join(best.withColumnRenamed("__film", "__f"), (F.col("__film") == F.col("__f")) & (F.col("__row") == F.col("__best")))
    return rows.dropDuplicates(["__film"]).select(*reviews.columns, "wc")


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind])


def longest_review(df: DataFrame, film: str = "title_url", text: str = "review", pos: str = "pos") -> DataFrame:
    """Per film the review with most words; the earlier one wins a tie.

    One row per film, whatever repeats: of reviews with as many words, the first
    position counts, a null position comes last, and reviews at one position are
    told apart by a hash of their text. Reviews without words and rows without a
    film are never chosen. The choice is made from counts alone, combined per
    partition before the shuffle; then the text of the chosen ones is joined
    back, so no review is sorted or carried along.
    """
    counted = df.select(F.col(film), F.col(pos), word_count(text).alias("wc"), review_mark(text).alias("mark")).where((F.col("wc") > 0) & F.col(film).isNotNull())
    best = counted.groupBy(film).agg(F.max(longest_order("wc", pos, "mark")).alias("b"))
    chosen = best.select(film, (-F.col("b.first")).alias(pos), F.col("b.wc").alias("wc"), F.col("b.mark").alias("mark"))
    return with_text(df, materialise(chosen, "longest"), film, text, pos)


def top_words(counts: DataFrame, k: int, label: str = "label", word: str = "word", n: str = "n") -> DataFrame:
    """Per label the ``k`` most frequent words with their rank; ties by word."""
    return top_k_by(counts, label, [F.desc(n), F.col(word)], k, rank="rank")


def sort_dictionary(counts: DataFrame) -> DataFrame:
    """Label, then most frequent word first."""
    return counts.orderBy("label", F.desc("n"), "word")


def cloud_weights(counts: DataFrame, max_words: int = 75) -> DataFrame:
    """Per label the top words with their size relative to the most frequent."""
    top = top_words(counts, max_words)
    largest = F.max("n").over(Window.partitionBy("label"))
    return top.withColumn("weight", F.col("n") / largest)


def limit_rows(df: DataFrame, key, n: int) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*_cols(key)).limit(n)


def _hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def shuffle_rows(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in a random looking order that is the same on every run."""
    return df.orderBy(_hash_order(key, seed), key)


def number_rows(df: DataFrame, key: str, seed: int = 42, digits: int = 3, out: str = "row_no") -> DataFrame:
    """0-based numbers in the order of :func:`shuffle_rows`, for a unique key.

    A window without partitions would run in one task. Here rows fall into
    ``16 ** digits`` even slices by the head of their hash; a small table of
    slice sizes gives the number each slice starts at, and only the order
    within a slice is left to a window.
    """
    hashed = df.withColumn("__h", _hash_order(key, seed)).withColumn("__slice", F.left("__h", F.lit(digits)))
    sizes = hashed.groupBy("__slice").agg(F.count(F.lit(1)).alias("__size"))
    # At most 16 ** digits rows, so one task and a broadcast are enough here.
    before = F.sum("__size").over(Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__slice", F.coalesce(before, F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy("__slice").orderBy("__h", key))
    return (
        hashed.withColumn("__rn", within)
        .join(F.broadcast(starts), "__slice")
        .withColumn(out, (F.col("__start") + F.col("__rn") - 1).cast("long"))
        .drop("__h", "__slice", "__rn", "__start")
    )


def assign_batches(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """Batch number per row: full batches of ``size``, the remainder last."""
    numbered = number_rows(df, key, seed)
    return numbered.withColumn("batch", F.floor(F.col("row_no") / size).cast("long")).drop("row_no")
