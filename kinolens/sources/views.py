"""The engine's inputs as views over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolens.functions.arrays import names_of
from kinolens.labels import LABELS_14


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """review_id, title_url, review, lang."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("source").alias("title_url"), F.col("text").alias("review"), "lang"
    )


def film_target(source: Column) -> Column:
    """0/1 vector over the 14 labels, by a rule on the number of the source."""
    k = F.substring(source, F.lit(4), F.length(source)).cast("int")
    return F.array(*[((k * 7 + 3 * j + (k * j) % 3) % 4 == 0).cast("int") for j in range(len(LABELS_14))])


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """title_url, genre_vec, labels, genre: one row per source."""
    films = table(spark, sf_dir, "documents").select(F.col("source").alias("title_url")).distinct()
    films = films.withColumn("genre_vec", film_target(F.col("title_url")))
    films = films.withColumn("labels", names_of("genre_vec", LABELS_14))
    return films.withColumn("genre", F.array_join(F.array_sort("labels"), " | "))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, sentiment, review of the documents with a quality label."""
    marks = table(spark, sf_dir, "labels").where(F.col("quality").isNotNull())
    marks = marks.select("doc_id", F.col("quality").alias("sentiment"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review"))
    return docs.join(marks, "doc_id").select(F.col("doc_id").alias("id"), "sentiment", "review")


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, review of the documents without any label row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review"))
    marks = table(spark, sf_dir, "labels").select("doc_id")
    return docs.join(marks, "doc_id", "left_anti").withColumnRenamed("doc_id", "id")


def film_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """title_url, pos, review: the turns of a conversation stand for reviews."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("title_url"), F.col("turn").alias("pos"), F.col("text").alias("review")
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, vec and the label as a one-hot target over 0..9."""
    rows = table(spark, sf_dir, "embeddings")
    target = F.array(*[(F.col("label") == i).cast("int") for i in range(10)])
    return rows.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label",
        target.alias("target"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, label, actual, p: hashed probabilities for every review and label.

    p is a 16-bit hash of id and label, halved when the label is absent.
    """
    docs = reviews(spark, sf_dir).select("review_id", film_target(F.col("title_url")).alias("v"))
    cells = F.array(
        *[F.struct(F.lit(x).alias("label"), F.get("v", F.lit(i)).alias("actual")) for i, x in enumerate(LABELS_14)]
    )
    rows = docs.select(F.col("review_id").alias("id"), F.inline(cells))
    digest = F.md5(F.concat(F.col("id").cast("string"), F.col("label")))
    p = F.conv(F.left(digest, F.lit(4)), 16, 10).cast("long") / 65535
    return rows.withColumn("p", F.when(F.col("actual") == 1, p).otherwise(p / 2))
