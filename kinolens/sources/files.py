"""Readers and writers. Every source has a fixed schema; nothing is inferred."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinolens.operators.ranking import top_k_by
from kinolens.sources.csv_records import read_csv_split

LABELLED = "id string, sentiment int, review string"
UNLABELLED = "id string, review string"
MOVIES = "title_url string, title string, year string, outline string, genre string, genre_vec string"
REVIEWS = (
    "title_url string, headline string, author string, rating string, review string, "
    "doc_vec string, word_count string"
)
DICTIONARY = "word string, n long"
PAGES = "page_id long, url string, html string"

# How a persisted word set is written.
SET_LITERAL_WORD = r"'([^']*)'"


def read_reviews_tsv(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Tab separated reviews. Quote marks are data and stay on the values."""
    return spark.read.csv(path, sep="\t", header=True, quote="", schema=LABELLED if labelled else UNLABELLED)


def write_reviews_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True, quote="", escapeQuotes=False)


def read_csv_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with header; quoted values may hold commas, quotes and line ends. One file is read by many tasks."""
    return read_csv_split(spark, path, schema, escape='"')


def write_csv_table(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, escape='"', quoteAll=True)


def read_matrix_csv(spark: SparkSession, path: str, n_cols: int, out: str = "features") -> DataFrame:
    """Numeric CSV without header; each line becomes one array."""
    names = [f"c{i}" for i in range(n_cols)]
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    return spark.read.csv(path, schema=schema).select(F.array(*names).alias(out))


def write_matrix_csv(df: DataFrame, vec: str, n_cols: int, path: str) -> None:
    df.select(*[F.get(F.col(vec), F.lit(i)).alias(f"c{i}") for i in range(n_cols)]).write.csv(path)


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages table."""
    return spark.read.schema(PAGES).parquet(path)


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per HTML file, for pages that were landed as files."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")
    )


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions as CSV with header; values are never quoted."""
    df.write.option("header", True).option("quote", "").csv(path)


def read_predictions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, quote="", schema=schema)


def write_label_dictionaries(counts: DataFrame, path: str) -> None:
    """``word,count`` files per label, most frequent word first.

    Rows are ranged by label and count: a big dictionary becomes several
    sorted files that follow each other instead of one task, and adaptive
    execution picks their number.
    """
    ordered = counts.select("label", "word", "n")
    ranged = ordered.repartitionByRange("label", F.desc("n"), "word")
    ranged.sortWithinPartitions("label", F.desc("n"), "word").write.partitionBy("label").csv(path)


def read_label_dictionary(spark: SparkSession, path: str, label: str | None = None, num_words: int | None = None):
    """Dictionaries written above; an empty count reads as 0.

    ``label`` prunes to its folder, ``num_words`` keeps that many of the most
    frequent words of each label.
    """
    rows = spark.read.schema("word string, n string, label string").csv(path)
    if label is not None:
        rows = rows.where(F.col("label") == label)
    rows = rows.select("label", "word", F.coalesce(F.col("n").try_cast("long"), F.lit(0)).alias("n"))
    return rows if num_words is None else top_k_by(rows, "label", [F.desc("n"), F.col("word")], num_words)


def write_word_set(words: DataFrame, path: str) -> None:
    """Word set as a one-column table."""
    words.select("word").write.parquet(path)


def read_word_set(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string").parquet(path)


def read_word_set_literal(spark: SparkSession, path: str) -> DataFrame:
    """Word set from a text of the form ``set(['a', 'b'])``; empty words drop out."""
    lines = spark.read.text(path)
    words = lines.select(F.explode(F.regexp_extract_all("value", F.lit(SET_LITERAL_WORD), 1)).alias("word"))
    return words.where(F.col("word") != "").distinct()


def save_model(model: MLWritable, path: str) -> str:
    """Store a fitted model; returns the path."""
    model.write().overwrite().save(path)
    return path


def save_models(models: dict, base: str) -> dict[str, str]:
    """Store per-label models as ``<base>/is_<label>``."""
    return {label: save_model(m, f"{base}/is_{label}") for label, m in models.items()}


def save_weights(counts: DataFrame, path: str) -> None:
    """Store a weight table (vocabulary, TF-IDF, lexicon) for later reuse."""
    counts.write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Metric rows as CSV, sorted as they are read."""
    keys = [c for c in ("cutoff", "label") if c in report.columns]
    report.orderBy(*keys).write.option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)
