"""Queries that run a stream to its end and return what it wrote.

The streams read the given tables as arriving files; the SQL states what a
batch job would give.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinolens.labels import UNWANTED_GENRES
from kinolens.operators import boosting as bt
from kinolens.operators import models as md
from kinolens.operators.extract import extract_titles
from kinolens.operators.sampling import split
from kinolens.operators.tables import update_by_key
from kinolens.operators.vectors import hash_scorer
from kinolens.plans import sql as S
from kinolens.plans.catalog import query
from kinolens.plans.q_aggregate import FULL, full_sums
from kinolens.plans.q_extract import listing_pages
from kinolens.plans.q_relate import LONGEST
from kinolens.session import fresh_dir
from kinolens.sources import views as V
from kinolens.streaming import streams as sm


def _arriving(spark, sf_dir, name):
    """The files of a table, which is one file or a folder of them; as a glob, because a stream takes a plain path for a folder."""
    schema = V.table(spark, sf_dir, name).schema
    return sm.file_stream(spark, f"{sf_dir}/{{{name}}}.parquet", schema)


@query(
    "m1_stream_new_titles",
    f"""WITH {S.FILMS},
g AS (SELECT title_url, string_agg(label, ' | ' ORDER BY label) FILTER (label NOT IN ({S.quoted(UNWANTED_GENRES)})) AS genre
      FROM film_labels GROUP BY title_url),
d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS rid, coalesce(genre, '') AS genre FROM documents JOIN g ON g.title_url = source)
SELECT '/title/' || rid || '/' AS title_url, 'Film ' || rid AS title, genre FROM d ANTI JOIN labels USING (doc_id)
UNION ALL SELECT '/title/next' || rid || '/', 'Film ' || rid, genre FROM d""",
)
def m1(spark, sf_dir):
    landed = fresh_dir(spark, "landed")
    pages = listing_pages(spark, sf_dir)
    # The same pages land twice, as when a listing is fetched again.
    pages.write.parquet(f"{landed}/day=1")
    pages.write.parquet(f"{landed}/day=2")
    seen = V.table(spark, sf_dir, "labels").select(F.concat(F.lit("/title/"), "doc_id", F.lit("/")).alias("title_url"))
    stream = sm.file_stream(spark, landed, T.StructType([*pages.schema.fields, T.StructField("day", T.IntegerType())]), files_per_batch=1)
    out = fresh_dir(spark, "titles")
    sm.run_to_end(sm.stream_new_titles(stream, extract_titles, seen, "title_url", out, fresh_dir(spark, "ckpt"), order=["title", "genre"]))
    return spark.read.parquet(out).select("title_url", "title", "genre")


@query(
    "m2_stream_backfill",
    rf"""WITH {full_sums(False)} SELECT doc_id, n_chars, vec AS doc_vec,
CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS INT) AS word_count
FROM t JOIN documents USING (doc_id)""",
)
def m2(spark, sf_dir):
    out = fresh_dir(spark, "backfill")
    docs = _arriving(spark, sf_dir, "documents")
    sm.run_to_end(sm.stream_backfill(docs, "doc_id", "text", hash_scorer(FULL), out, fresh_dir(spark, "ckpt")))
    filled = sm.newest_by_key(spark, out, spark.read.parquet(out).drop(sm.BATCH).schema, "doc_id")
    base = V.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rows = update_by_key(base, filled, "doc_id", ["doc_vec", "word_count"])
    return rows.withColumn("doc_vec", F.array_join(F.col("doc_vec").cast("array<long>"), " "))


@query("m3_stream_longest_review", LONGEST)
def m3(spark, sf_dir):
    turns = _arriving(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("title_url"), F.col("turn").alias("pos"), F.col("text").alias("review")
    )
    out = fresh_dir(spark, "longest")
    sm.run_to_end(sm.stream_longest_review(turns, out, fresh_dir(spark, "ckpt")))
    return sm.latest_longest_review(spark, out, V.film_reviews(spark, sf_dir))


@query("m4_stream_score")
def m4(spark, sf_dir):
    rows = md.to_matrix(V.doc_vectors(spark, sf_dir).select("id", "vec", "target"), "vec", "target")
    train, _ = split(rows, "id")
    model = bt.fit_boosted(train, [str(i) for i in range(10)], trees=700, depth=5)

    def score(stream):
        vec = array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
        return bt.label_probabilities(model, stream.select(F.col("vec_id").alias("id"), vec), "id", target=None)

    out = fresh_dir(spark, "scored")
    stream = _arriving(spark, sf_dir, "embeddings")
    sm.run_to_end(sm.stream_score(stream, score, out, fresh_dir(spark, "ckpt")))
    return spark.read.parquet(out)


@query(
    "m4_stream_probabilities",
    "SELECT vec_id AS id, CAST(i AS VARCHAR) AS label, true AS valid FROM embeddings, range(10) r(i)",
)
def m4_bounds(spark, sf_dir):
    return m4(spark, sf_dir).select("id", "label", F.col("p").between(0.0, 1.0).alias("valid"))
