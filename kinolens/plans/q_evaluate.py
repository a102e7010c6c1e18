"""Queries that evaluate predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinolens.labels import CUTOFFS, LABELS_14
from kinolens.operators import metrics as mt
from kinolens.operators.aggregates import label_distribution
from kinolens.plans import sql as S
from kinolens.plans.catalog import query
from kinolens.sources import views as V

CUTOFF_ROWS = ", ".join(f"({c}::DOUBLE)" for c in CUTOFFS)

COUNTS = """
counts AS (
  SELECT cutoff, label, count(*) FILTER (p >= cutoff AND actual = 1) AS tp,
         count(*) FILTER (p >= cutoff AND actual = 0) AS fp, count(*) FILTER (p < cutoff AND actual = 1) AS fn
  FROM scores, cutoffs GROUP BY cutoff, label
),
pr AS (
  SELECT cutoff, label, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0::DOUBLE END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0::DOUBLE END AS recall, tp + fn AS support FROM counts
),
rated AS (
  SELECT cutoff, label, precision, recall,
         CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1,
         support FROM pr
),
footer AS (
  SELECT cutoff, 'avg / total' AS label, sum(precision * support) / sum(support) AS precision,
         sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1,
         CAST(sum(support) AS BIGINT) AS support FROM rated GROUP BY cutoff
)"""

SWEEP = f"WITH {S.REVIEW_SCORES}, cutoffs(cutoff) AS (VALUES {CUTOFF_ROWS}), {COUNTS}"
ROUNDED = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support"
SWEEP_SQL = f"""{SWEEP}
SELECT cutoff, label, {ROUNDED} FROM rated UNION ALL SELECT cutoff, label, {ROUNDED} FROM footer"""
ONE = f"WITH {S.REVIEW_SCORES}, cutoffs(cutoff) AS (VALUES (0.25::DOUBLE)), {COUNTS}"
PRED = "CASE WHEN p >= 0.25 THEN 1 ELSE 0 END"


def _rounded(df, *keys):
    return df.select(*keys, *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


def _predicted(spark, sf_dir):
    return V.scores(spark, sf_dir).withColumn("prediction", (F.col("p") >= 0.25).cast("int"))


@query(
    "l1_classification_report",
    f"{ONE} SELECT label, {ROUNDED} FROM rated UNION ALL SELECT label, {ROUNDED} FROM footer",
)
def l1(spark, sf_dir):
    return _rounded(mt.classification_report(_predicted(spark, sf_dir)), "label")


@query(
    "l2_zero_one_loss",
    f"""WITH {S.REVIEW_SCORES}, w AS (SELECT id, max(CASE WHEN {PRED} <> actual THEN 1 ELSE 0 END) AS wrong FROM scores GROUP BY id)
SELECT round(avg(wrong), 6) AS zero_one_loss FROM w""",
)
def l2(spark, sf_dir):
    loss = mt.zero_one_loss(_predicted(spark, sf_dir))
    return loss.select(F.round("zero_one_loss", 6).alias("zero_one_loss"))


@query(
    "l2_zero_one_loss_vectors",
    """WITH v AS (SELECT list_transform(embedding, lambda x: x >= 0.1) AS a, list_transform(embedding, lambda x: x > 0.1) AS b,
                 label FROM embeddings)
SELECT round(avg(CASE WHEN list_slice(a, 1, label + 1) <> list_slice(b, 1, label + 1) OR label > 4 THEN 1 ELSE 0 END), 6) AS zero_one_loss FROM v""",
)
def l2_vectors(spark, sf_dir):
    hits = F.transform("vec", lambda x: x >= 0.1)
    strict = F.transform("vec", lambda x: x > 0.1)
    # Rows of the upper five labels get one position flipped, so they are wrong.
    flipped = F.when(F.col("label") > 4, F.transform(strict, lambda x, i: x != (i == 0))).otherwise(strict)
    rows = V.doc_vectors(spark, sf_dir).select(hits.alias("prediction"), flipped.alias("actual"))
    return mt.zero_one_loss_vectors(rows, "prediction", "actual").select(F.round("zero_one_loss", 6).alias("zero_one_loss"))


@query(
    "l2_zero_one_sweep",
    f"""WITH {S.REVIEW_SCORES}, cutoffs(cutoff) AS (VALUES {CUTOFF_ROWS}),
w AS (SELECT cutoff, id, max(CASE WHEN (p >= cutoff) <> (actual = 1) THEN 1 ELSE 0 END) AS wrong FROM scores, cutoffs GROUP BY ALL)
SELECT cutoff, round(avg(wrong), 6) AS zero_one_loss FROM w GROUP BY cutoff""",
)
def l2_sweep(spark, sf_dir):
    rows = mt.zero_one_sweep(V.scores(spark, sf_dir), CUTOFFS)
    return rows.select("cutoff", F.round("zero_one_loss", 6).alias("zero_one_loss"))


@query(
    "l3_hamming_loss",
    f"WITH {S.REVIEW_SCORES} SELECT round(avg(CASE WHEN {PRED} <> actual THEN 1 ELSE 0 END), 6) AS hamming_loss FROM scores",
)
def l3(spark, sf_dir):
    return mt.hamming_loss(_predicted(spark, sf_dir)).select(F.round("hamming_loss", 6).alias("hamming_loss"))


@query("l4_threshold_sweep", SWEEP_SQL)
def l4(spark, sf_dir):
    return _rounded(mt.threshold_sweep(V.scores(spark, sf_dir), CUTOFFS), "cutoff", "label")


@query(
    "l5_binary_report",
    f"""WITH {S.REVIEW_SCORES}, s AS (SELECT label AS method, {PRED} AS prediction, actual FROM scores)
SELECT method, round(avg(CASE WHEN prediction = actual THEN 1 ELSE 0 END), 6) AS accuracy,
       round(count(*) FILTER (prediction = 1 AND actual = 1) / count(*) FILTER (prediction = 1), 6) AS precision,
       round(count(*) FILTER (prediction = 1 AND actual = 1) / count(*) FILTER (actual = 1), 6) AS sensitivity,
       count(*) AS n FROM s GROUP BY method""",
)
def l5(spark, sf_dir):
    rows = mt.binary_report(_predicted(spark, sf_dir).withColumnRenamed("label", "method"), ["method"])
    return rows.select(
        "method", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "sensitivity")], "n"
    )


@query(
    "l7_random_guess_baseline",
    f"""WITH {S.FILMS}, s AS (SELECT label, count(*) AS n FROM documents d JOIN film_labels l ON l.title_url = d.source GROUP BY label)
SELECT round(sum(n / (SELECT count(*) FROM documents) * n) / sum(n), 6) AS expected_f1 FROM s""",
)
def l7(spark, sf_dir):
    docs = V.reviews(spark, sf_dir).select(V.film_target(F.col("title_url")).alias("v"))
    n_rows = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return mt.random_guess_baseline(label_distribution(docs, "v", LABELS_14), n_rows).select(F.round("expected_f1", 6).alias("expected_f1"))


@query(
    "l8_best_threshold",
    f"{SWEEP} SELECT cutoff, round(f1, 6) AS f1 FROM footer ORDER BY footer.f1 DESC, cutoff LIMIT 1",
)
def l8(spark, sf_dir):
    return mt.best_threshold(V.scores(spark, sf_dir), CUTOFFS).select("cutoff", F.round("f1", 6).alias("f1"))
