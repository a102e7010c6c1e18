"""Incremental collection as Structured Streaming.

The collectors are restartable: each run takes what has arrived since the last
one (``availableNow``), and a second run over the same input adds nothing.
Tables that a stream fills are folders with one sub-folder per micro-batch; a
batch that is replayed after a failure overwrites its own folder, so rows are
never written twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinolens.functions.text import word_count
from kinolens.operators.joins import not_yet_seen
from kinolens.operators.ranking import dedupe_first, longest_order, review_mark, with_text
from kinolens.operators.vectors import Scorer, score_batches
from kinolens.session import materialise

BATCH = "batch_id"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """Stream of the parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Rows of a stream-filled table, optionally only of batches before one.

    The batch number is the partition column, so the condition prunes folders.
    """
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    try:
        rows = spark.read.schema(full).parquet(path)
    except Exception as problem:  # the first batch finds no table yet
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)
    if before is not None:
        rows = rows.where(F.col(BATCH) < before)
    return rows.drop(BATCH)


def _write_batch(rows: DataFrame, path: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


#: Folders that the keys of a collected table are dealt to; a batch reads those that its own keys fall in.
KEY_BUCKETS = 256
BUCKET = "key_bucket"


def key_bucket(key: str, buckets: int = KEY_BUCKETS):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def known_keys(spark: SparkSession, path: str, kind: T.DataType, key: str, buckets: list[int], before: int) -> DataFrame:
    """(key) of the rows that batches before ``before`` wrote to ``buckets``; other folders are not even listed."""
    from kinolens.session import path_exists

    folders = [f for f in (f"{path}/{BUCKET}={b}" for b in buckets) if path_exists(spark, f)]
    schema = T.StructType([T.StructField(key, kind), T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    if not folders:
        return spark.createDataFrame([], T.StructType(schema.fields[:1]))
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).where(F.col(BATCH) < before).select(key)


#: Keys of every batch beside the buckets, in few files; the leading underscore hides them from readers of the table.
KEYS = "_keys"
#: A batch that touches more than one in so many buckets reads all keys instead of opening a file per bucket and batch.
KEYS_SHARE = 8


def all_keys(spark: SparkSession, path: str, kind: T.DataType, key: str, before: int) -> DataFrame:
    """(key) of all rows that batches before ``before`` wrote; a table without its list of keys gets one first."""
    from kinolens.session import path_exists

    schema = T.StructType([T.StructField(key, kind), T.StructField(BATCH, T.LongType())])
    if not path_exists(spark, f"{path}/{KEYS}/_SUCCESS"):
        written = path_exists(spark, path)
        full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = spark.read.schema(full).parquet(path).select(key, BATCH) if written else spark.createDataFrame([], schema)
        rows.hint("rebalance", F.col(BATCH)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BATCH).parquet(f"{path}/{KEYS}")
    return spark.read.schema(schema).parquet(f"{path}/{KEYS}").where(F.col(BATCH) < before).select(key)


def stream_new_titles(
    pages: DataFrame,
    extract: Callable[[DataFrame], DataFrame],
    seen: DataFrame,
    key: str,
    out: str,
    checkpoint: str,
    order,
    buckets: int = KEY_BUCKETS,
) -> StreamingQuery:
    """Arriving pages add the titles that are neither in ``seen`` nor in ``out``.

    Of the rows of a key that arrive together, the first in ``order`` is taken:
    columns that tell pages and places on them apart.

    The table already written is the memory of the stream, as a collection
    with a unique key would be; no key stays in executor state, which would
    grow for ever without a watermark. It is written by hash buckets of the key,
    and a small batch reads the key column of the buckets its own candidates
    fall in, so what it reads does not grow with all that was collected. A batch
    that touches many buckets would open a file for each of them and each batch
    before; it reads the list of keys, which has a file or a few per batch.
    A batch that is replayed replaces its own folders.
    """
    # A batch may be one file: its pages are dealt out, so that all cores extract from it.
    found = extract(pages.repartition(4 * pages.sparkSession.sparkContext.defaultParallelism))
    kind = found.schema[key].dataType

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = dedupe_first(batch, key, order)
        fresh = materialise(not_yet_seen(first, seen, key).withColumn(BUCKET, key_bucket(key, buckets)), "candidates")
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        listed = all_keys(spark, out, kind, key, batch_id)
        known = listed if len(touched) * KEYS_SHARE > buckets else known_keys(spark, out, kind, key, touched, batch_id)
        rows = not_yet_seen(fresh, known, key)
        # The list goes first: a batch that fails behind it is replayed and overwrites its part.
        part = f"{out}/{KEYS}/{BATCH}={batch_id}"
        rows.select(key).hint("rebalance").write.mode("overwrite").parquet(part)
        if spark.read.schema(T.StructType([T.StructField(key, kind)])).parquet(part).isEmpty():
            return
        # One file per bucket and batch.
        dealt = rows.withColumn(BATCH, F.lit(batch_id).cast("long")).repartition(BUCKET)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(out)

    writer = found.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stream_backfill(
    reviews: DataFrame, key: str, text: str, scorer: Scorer, out: str, checkpoint: str, batch_size: int = 100
) -> StreamingQuery:
    """Vectors and word counts for arriving reviews, both in one write.

    A review that lands again is written again; :func:`newest_by_key` gives one
    row per review, which is joined to the reviews with ``update_by_key``.
    """

    def fill(batch: DataFrame, batch_id: int) -> None:
        # The scorer sees the text once; the word count rides along in the key.
        counted = batch.select(F.struct(F.col(key), word_count(text).alias("word_count")).alias("k"), text)
        vectors = score_batches(counted, "k", text, scorer, batch_size)
        _write_batch(vectors.select("k.*", F.col("vec").alias("doc_vec")), out, batch_id)

    writer = reviews.writeStream.foreachBatch(fill).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def newest_by_key(spark: SparkSession, out: str, schema: T.StructType, key: str) -> DataFrame:
    """One row per key of a stream-filled table: that of the latest batch.

    A key that repeats within one batch gives its greatest row.
    """
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    names = [f.name for f in schema.fields]
    rows = spark.read.schema(full).parquet(out)
    newest = F.max(F.struct(BATCH, *[n for n in names if n != key]))
    return rows.groupBy(key).agg(newest.alias("r")).select(key, *[F.col(f"r.{n}").alias(n) for n in names if n != key])


def running_longest_review(
    reviews: DataFrame, film: str = "title_url", text: str = "review", pos: str = "pos"
) -> DataFrame:
    """(film, pos, wc, mark) of the longest review per film so far, on a stream or on a table.

    State is three numbers per film, the total order of :func:`longest_review`;
    ``mark`` tells reviews at the same position apart. The text stays in the
    reviews and is joined to the result (:func:`latest_longest_review`).
    """
    counted = reviews.select(film, F.col(pos), word_count(text).alias("wc"), review_mark(text).alias("mark")).where(F.col("wc") > 0)
    best = F.max(longest_order("wc", pos, "mark"))
    return counted.groupBy(film).agg(best.alias("r")).select(film, (-F.col("r.first")).alias(pos), F.col("r.wc").alias("wc"), F.col("r.mark").alias("mark"))


def stream_longest_review(reviews: DataFrame, out: str, checkpoint: str, **columns) -> StreamingQuery:
    """Writes the films whose longest review changed, batch by batch.

    Update mode: a film appears in every batch that improves it, and the
    latest batch wins (:func:`latest_longest_review`).
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, out, batch_id)

    best = running_longest_review(reviews, **columns)
    writer = best.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def merge_updates(spark: SparkSession, out: str, schema: T.StructType, film: str, batch: int) -> None:
    """Rewrite the update log up to ``batch`` as one row per film, in the folder of that batch.

    Run between streams; the older folders can be removed afterwards.
    """
    rows = materialise(newest_by_key(spark, out, schema, film), "merged")
    _write_batch(rows, out, batch)


def latest_longest_review(
    spark: SparkSession, out: str, reviews: DataFrame, film: str = "title_url", text: str = "review", pos: str = "pos"
) -> DataFrame:
    """(film, pos, text, wc): the newest of the updates written above, with the text of its review."""
    kind = {f.name: f.dataType for f in reviews.schema.fields}
    numbers = [T.StructField("wc", T.IntegerType()), T.StructField("mark", T.LongType())]
    schema = T.StructType([T.StructField(film, kind[film]), T.StructField(pos, kind[pos]), *numbers])
    newest = materialise(newest_by_key(spark, out, schema, film), "longest")
    rows = with_text(reviews.select(film, pos, text), newest, film, text, pos)
    return rows.select(film, pos, text, "wc")


def stream_score(
    reviews: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Scores arriving reviews with fitted models; a map, so plain append."""
    writer = score(reviews).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).format("parquet").option("path", out).start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait until an ``availableNow`` query has taken everything."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
