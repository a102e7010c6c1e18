"""What the plans do with hot keys, and values that rounding inside an operator would change."""

import pytest
import __spark_entry__ as entry
from pyspark.sql import functions as F

from kinolens.operators import aggregates as ag
from kinolens.operators import lexicon as lx
from kinolens.operators import vectors as vc
from kinolens.operators.joins import small_side
from kinolens.plans.genre import review_tokens

SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SKEWED}
    for k, v in SKEWED.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    # the plan that ran, not one planned anew
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


def hot_documents(spark):
    other = F.concat(F.lit("w"), (F.col("id") % 997).cast("string"))
    rows = spark.range(0, 60000, 1, 8).select("id", F.array(F.lit("the"), other).alias("tokens"), (F.col("id") % 2).alias("sentiment"))
    return rows


def test_hot_word_of_tf_idf_is_split(skewed):
    weights = ag.tf_idf(hot_documents(skewed), "id", F.col("tokens"))
    assert "skew=true" in final_plan(weights)


def test_hot_word_of_lexicon_is_split(skewed):
    docs = hot_documents(skewed)
    scores = lx.lexicon_sentiment(docs, "id", "tokens", lx.learn_polarity(docs, F.col("tokens")))
    assert "skew=true" in final_plan(scores)


@pytest.mark.parametrize("name", ["a5_scan_projection", "c1_clean_text", "f1_term_counts"])
def test_tables_are_read_where_they_lie(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan


def test_only_proven_sides_are_broadcast(spark):
    rows = spark.range(100).withColumn("word", F.col("id").cast("string"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(small_side(rows.limit(10)))
    assert not hinted(small_side(rows.select(F.explode(F.array("word", "word")).alias("word"))))
    many = rows.select(F.explode(F.array("word", "word")).alias("word"))
    assert hinted(small_side(many.limit(6000), row_bytes=2400))
    assert not hinted(small_side(many.limit(200_000), row_bytes=2400))


def test_punctuation_is_no_word(spark):
    row = spark.createDataFrame([("A good , very good film . But !!! odd && ( the end ) ?",)], "review string")
    assert row.select(review_tokens(row).alias("t")).first().t == ["good", "good", "film", "!!!", "odd", "&&", "end"]


def test_means_are_not_rounded(spark):
    scores = spark.createDataFrame([(1, 0.5000006, 1), (1, 0.5, 1), (2, 0.5, 3)], "id int, score double, len long")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "id int, actual int")
    got = {r.id: (r.percent_prediction, r.prediction) for r in lx.sentiment_predictions(scores, labels, "id", "actual").collect()}
    assert got == {1: (0.5000003, 1), 2: (0.5, 0)}


def test_similarity_ranks_full_values(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0002]), (2, [1.0, 0.0001]), (3, [1.0, 0.00015])], "id int, vec array<double>")
    assert [r.id for r in vc.nearest_documents(rows, "id", "vec", 0, 3).collect()] == [2, 3, 1]


def test_sweep_has_ratios(spark):
    rows = spark.createDataFrame([(0.5, 1), (0.5, 0), (-0.5, 1), (-0.5, 0), (0.5, 1)], "polarity double, actual int")
    r = lx.polarity_sweep(rows, "actual", [0.1]).first()
    assert (r.accuracy, r.precision, r.sensitivity) == (0.6, 2 / 3, 2 / 3)
