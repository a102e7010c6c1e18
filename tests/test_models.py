"""Models on the small embeddings table, and what they are stored as."""

import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from kinolens.labels import DEPTH_PER_LABEL, TREES_PER_LABEL
from kinolens.operators import metrics as mt
from kinolens.operators import models as md
from kinolens.operators.aggregates import label_distribution
from kinolens.operators.sampling import split
from kinolens.session import fresh_dir
from kinolens.sources import files as fl
from kinolens.sources import views as V

SF = "/root/testdata/sf0.001"
NAMES = ["0", "1", "2"]


@pytest.fixture(scope="module")
def sides(spark):
    rows = V.doc_vectors(spark, SF).select("id", "vec", F.slice("target", 1, 3).alias("target"))
    return split(md.to_matrix(rows, "vec", "target"), "id")


@pytest.fixture(scope="module")
def models(sides):
    return md.fit_multilabel(sides[0], NAMES, trees=5, depth=3)


def test_probabilities_beat_guessing(spark, sides, models):
    scored = md.predict_proba(models, sides[1], "id").cache()
    assert scored.count() == 3 * sides[1].count()
    assert scored.where("p < 0 OR p > 1").count() == 0
    best = mt.best_threshold(scored).collect()[0].f1
    support = label_distribution(sides[1], "target", NAMES)
    guess = mt.random_guess_baseline(support, F.lit(sides[1].count())).collect()[0].expected_f1
    assert best > guess


def test_saved_models_score_the_same(spark, sides, models):
    paths = fl.save_models(models, fresh_dir(spark, "models"))
    stored = md.evaluate_saved_models(paths, sides[1], "id", cutoffs=(0.3,)).collect()
    fresh = mt.threshold_sweep(md.predict_proba(models, sides[1], "id"), (0.3,)).collect()
    assert sorted(map(tuple, stored)) == sorted(map(tuple, fresh))


def test_unlabelled_rows_do_not_train(spark, sides):
    unknown = sides[0].withColumn("target", F.when(F.col("id") >= 0, F.lit(None)).cast("array<int>"))
    models = md.fit_per_label(sides[0].unionByName(unknown), ["0"], trees=[2], depth=[2])
    assert list(models) == ["0"]


def test_parameters_per_label(sides):
    assert len(TREES_PER_LABEL) == len(DEPTH_PER_LABEL) == 14
    with pytest.raises(ValueError):
        md.fit_per_label(sides[0], NAMES)


def test_forest_and_grid(spark, sides):
    train = sides[0].withColumn("target", F.get("target", F.lit(0)))
    test = sides[1].withColumn("target", F.get("target", F.lit(0)))
    forest = md.fit_forest(train, trees=5, depth=3)
    path = fl.save_model(forest, fresh_dir(spark, "forest"))
    loaded = RandomForestClassificationModel.load(path)
    assert sorted(md.predict(forest, test, "id").collect()) == sorted(md.predict(loaded, test, "id").collect())
    grid = md.grid_results(md.grid_search(train, [1, 2], [2], folds=2), spark).collect()
    assert {(r.trees, r.depth) for r in grid} == {(1, 2), (2, 2)} and all(0 <= r.f1 <= 1 for r in grid)
