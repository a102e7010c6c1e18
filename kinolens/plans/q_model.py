"""Queries that fit, score and compare models.

Every fit reads its whole table. Boosted trees have the numbers and depths of
the tuned models; forests and the chain from text are smaller here, and their
functions take any size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from kinolens.functions.text import letters_only_tokens
from kinolens.labels import CUTOFFS, DEPTH_PER_LABEL, POLARITY_CUTOFFS, TREES_PER_LABEL
from kinolens.operators import boosting as bt
from kinolens.operators import lexicon as lx
from kinolens.operators import models as md
from kinolens.operators import vectors as vc
from kinolens.operators.metrics import threshold_sweep
from kinolens.operators.sampling import split
from kinolens.plans import sql as S
from kinolens.plans.catalog import query
from kinolens.plans.genre import genre_chain
from kinolens.session import fresh_dir
from kinolens.sources import files as fl
from kinolens.sources import views as V

TREES, DEPTH = 3, 3
LABELS = [str(i) for i in range(10)]
GRID_TREES, GRID_DEPTHS = [100, 300, 500, 700], [3, 4, 5]


def _vectors(spark, sf_dir):
    """(train, test) of the embeddings with their one-hot target."""
    rows = md.to_matrix(V.doc_vectors(spark, sf_dir).select("id", "vec", "target"), "vec", "target")
    return split(rows, "id")


def _binary(spark, sf_dir):
    """(train, test) of the embeddings for the question: label below five."""
    train, test = _vectors(spark, sf_dir)
    low = (F.array_position("target", F.lit(1)) <= 5).cast("int")
    return train.withColumn("target", low), test.withColumn("target", low)


def _multilabel(train):
    """One ensemble of 900 trees against the rest per label."""
    return bt.fit_boosted(train, LABELS, trees=900, depth=5)


def _labelled(spark, sf_dir):
    return split(V.labelled(spark, sf_dir), "id")


@query("k1_fit_forest")
def k1(spark, sf_dir):
    train, _ = _binary(spark, sf_dir)
    model = md.fit_forest(train, trees=20, depth=5)
    rows = [(i, float(w)) for i, w in enumerate(model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature int, importance double")


@query("k2_predict")
def k2(spark, sf_dir):
    train, test = _binary(spark, sf_dir)
    return md.predict(md.fit_forest(train, trees=20, depth=5), test, "id")


@query("k3_fit_per_label")
def k3(spark, sf_dir):
    train, test = _vectors(spark, sf_dir)
    model = bt.fit_boosted(train, LABELS, trees=TREES_PER_LABEL[:10], depth=DEPTH_PER_LABEL[:10])
    return bt.staged_probabilities(model, test).select("id", F.posexplode(F.transform("p", lambda p: F.get(p, F.lit(0)))).alias("label", "p"))


@query("k4_fit_multilabel")
def k4(spark, sf_dir):
    train, test = _vectors(spark, sf_dir)
    return threshold_sweep(bt.label_probabilities(_multilabel(train), test, "id"))


@query("k5_predict_proba")
def k5(spark, sf_dir):
    train, test = _vectors(spark, sf_dir)
    return bt.label_probabilities(_multilabel(train), test, "id")


@query("k6_grid_search")
def k6(spark, sf_dir):
    train, _ = _binary(spark, sf_dir)
    return bt.staged_grid(train, "id", GRID_TREES, GRID_DEPTHS, folds=3)


def _counts(train, test):
    return md.bow_features(train, test, "review")


def _hashed(combine):
    def featurise(train, test):
        def side(part):
            vectors = vc.doc_vectors(part, "id", letters_only_tokens("review"), 32, combine)
            return md.to_matrix(vectors.join(part.select("id", "sentiment"), "id"), "vec")

        return side(train), side(test)

    return featurise


@query("k7_compare_methods")
def k7(spark, sf_dir):
    train, test = _labelled(spark, sf_dir)
    methods = {"counts": _counts, "hash_sum": _hashed("sum"), "hash_mean": _hashed("mean"), "hash_concat": _hashed("concat")}
    return md.compare_methods(train, test, methods, "id", "sentiment", trees=10, depth=5)


@query("k8_bow_flow")
def k8(spark, sf_dir):
    train, test = _labelled(spark, sf_dir)
    return md.bow_flow(train, test, "id", "review", "sentiment", trees=20, depth=5, stop=True, stem=True, max_features=5000)


@query("l6_evaluate_saved_models")
def l6(spark, sf_dir):
    train, test = _vectors(spark, sf_dir)
    model = bt.Boosted.load(spark, _multilabel(train).save(fresh_dir(spark, "models")))
    return threshold_sweep(bt.label_probabilities(model, test, "id"), (0.25, 0.3, 0.2, 0.1))


# ---- what SQL can state of fitted models: rows, classes, supports and bounds ----

TESTED = "CAST(('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 30"
VECTORS = f"t AS (SELECT vec_id AS id, label FROM embeddings WHERE {TESTED.format('vec_id')})"
MARKED = f"t AS (SELECT doc_id AS id, quality FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL AND {TESTED.format('doc_id')})"


def _valid(*probabilities):
    good = [F.col(p).between(0.0, 1.0) for p in probabilities]
    return reduce(lambda a, b: a & b, good).alias("valid")


@query("k1_forest_shape", "SELECT len(embedding) AS features, CAST(1 AS DOUBLE) AS total FROM embeddings LIMIT 1")
def k1_shape(spark, sf_dir):
    return k1(spark, sf_dir).agg(F.count("feature").alias("features"), F.round(F.sum("importance"), 6).alias("total"))


@query("k2_one_class_per_row", f"WITH {VECTORS} SELECT id, CASE WHEN label < 5 THEN 1 ELSE 0 END AS actual, true AS valid FROM t")
def k2_classes(spark, sf_dir):
    return k2(spark, sf_dir).select("id", "actual", F.col("prediction").isin(0, 1).alias("valid"))


@query("k3_probabilities_per_label", f"WITH {VECTORS} SELECT id, CAST(i AS INT) AS label, true AS valid FROM t, range(10) r(i)")
def k3_bounds(spark, sf_dir):
    return k3(spark, sf_dir).select("id", "label", _valid("p"))


@query(
    "k4_support_per_label",
    f"""WITH {VECTORS}, c(cutoff) AS (VALUES {', '.join(f'({x}::DOUBLE)' for x in CUTOFFS)}),
s AS (SELECT CAST(i AS VARCHAR) AS label, (SELECT count(*) FROM t WHERE t.label = i) AS support FROM range(10) r(i))
SELECT cutoff, label, support, true AS valid FROM s, c UNION ALL SELECT cutoff, 'avg / total', (SELECT count(*) FROM t), true FROM c""",
)
def k4_support(spark, sf_dir):
    return k4(spark, sf_dir).select("cutoff", "label", "support", _valid("precision", "recall", "f1"))


@query("k5_probabilities", f"WITH {VECTORS} SELECT id, CAST(i AS VARCHAR) AS label, CASE WHEN label = i THEN 1 ELSE 0 END AS actual, true AS valid FROM t, range(10) r(i)")
def k5_bounds(spark, sf_dir):
    return k5(spark, sf_dir).select("id", "label", "actual", _valid("p"))


@query("k6_grid_points", f"SELECT CAST(t AS INT) AS trees, CAST(d AS INT) AS depth, true AS valid FROM (SELECT unnest({GRID_TREES}) AS t), (SELECT unnest({GRID_DEPTHS}) AS d)")
def k6_points(spark, sf_dir):
    return k6(spark, sf_dir).select("trees", "depth", _valid("f1"))


@query("k7_rows_per_method", f"WITH {MARKED} SELECT method, (SELECT count(*) FROM t) AS n, true AS valid FROM (VALUES ('counts'), ('hash_sum'), ('hash_mean'), ('hash_concat')) m(method)")
def k7_rows(spark, sf_dir):
    return k7(spark, sf_dir).select("method", "n", _valid("accuracy", "precision", "sensitivity"))


@query("k8_one_class_per_review", f"WITH {MARKED} SELECT id, CAST(quality AS INT) AS actual, true AS valid FROM t")
def k8_classes(spark, sf_dir):
    return k8(spark, sf_dir).select("id", "actual", F.col("prediction").isin(0, 1).alias("valid"))


@query(
    "l6_support_of_saved_models",
    f"""WITH {VECTORS}, c(cutoff) AS (VALUES (0.25::DOUBLE), (0.3::DOUBLE), (0.2::DOUBLE), (0.1::DOUBLE)),
s AS (SELECT CAST(i AS VARCHAR) AS label, (SELECT count(*) FROM t WHERE t.label = i) AS support FROM range(10) r(i))
SELECT cutoff, label, support, true AS valid FROM s, c UNION ALL SELECT cutoff, 'avg / total', (SELECT count(*) FROM t), true FROM c""",
)
def l6_support(spark, sf_dir):
    return l6(spark, sf_dir).select("cutoff", "label", "support", _valid("precision", "recall", "f1"))


@query("a11_loaded_model_agrees", f"WITH {VECTORS} SELECT id, true AS same FROM t")
def a11_same(spark, sf_dir):
    return a11(spark, sf_dir).select("id", (F.col("prediction") == F.col("before")).alias("same"))


@query(
    "k4_genre_chain",
    f"""WITH {S.FILMS}, t AS (SELECT doc_id, source FROM documents WHERE {TESTED.format('doc_id')}),
c(cutoff) AS (VALUES {', '.join(f'({x}::DOUBLE)' for x in CUTOFFS)}),
s AS (SELECT n.label, (SELECT count(*) FROM t JOIN film_labels l ON l.title_url = t.source WHERE l.label = n.label) AS support FROM label_names n)
SELECT cutoff, label, support, true AS valid FROM s, c
UNION ALL SELECT cutoff, 'avg / total', (SELECT CAST(sum(support) AS BIGINT) FROM s), true FROM c""",
)
def k4_chain(spark, sf_dir):
    train, test = split(V.reviews(spark, sf_dir), "review_id")
    _, rows = genre_chain(train, test, V.movies(spark, sf_dir), trees=[TREES] * 14, depth=[DEPTH] * 14)
    return threshold_sweep(rows).select("cutoff", "label", "support", _valid("precision", "recall", "f1"))


@query("a11_save_load_model")
def a11(spark, sf_dir):
    from pyspark.ml.classification import RandomForestClassificationModel

    train, test = _binary(spark, sf_dir)
    model = md.fit_forest(train, trees=5, depth=4)
    loaded = RandomForestClassificationModel.load(fl.save_model(model, fresh_dir(spark, "forest")))
    before = md.predict(model, test, "id").withColumnRenamed("prediction", "before")
    return md.predict(loaded, test, "id").join(before.select("id", "before"), "id")


# ---- lexicon sentiment: exact in SQL ----

WORDS = f"""labelled AS (SELECT d.doc_id, d.text, quality AS sentiment FROM documents d JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
train_words AS (SELECT sentiment, unnest({S.letters_list('text')}) AS word FROM labelled
                WHERE NOT (CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 30)),
lexicon AS (SELECT word, (count(*) FILTER (sentiment = 1) - count(*) FILTER (sentiment = 0)) / (count(*) + 1) AS polarity
            FROM train_words GROUP BY word)"""

DOC_SCORES = f"""{WORDS},
w AS (SELECT doc_id, unnest({S.letters_list('text')}) AS word FROM documents),
k AS (SELECT doc_id, sum(polarity) / count(*) AS polarity, count(*) AS known FROM w JOIN lexicon USING (word) GROUP BY doc_id),
scored AS (SELECT doc_id, text, coalesce(polarity, 0) AS polarity, coalesce(known / size, 0) AS subjectivity
           FROM (SELECT doc_id, text, len({S.letters_list('text')}) AS size FROM documents) LEFT JOIN k USING (doc_id))"""


def _lexicon(spark, sf_dir):
    train, _ = _labelled(spark, sf_dir)
    return lx.learn_polarity(train, letters_only_tokens("review"))


def _polarity(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    return lx.lexicon_sentiment(docs, "doc_id", letters_only_tokens("text"), _lexicon(spark, sf_dir))


@query("k9_learn_polarity", f"WITH {WORDS} SELECT word, round(polarity, 6) AS polarity FROM lexicon")
def k9_learn(spark, sf_dir):
    return _lexicon(spark, sf_dir).select("word", F.round("polarity", 6).alias("polarity"))


@query("k9_lexicon_sentiment", f"WITH {DOC_SCORES} SELECT doc_id, round(polarity, 6) AS polarity, round(subjectivity, 6) AS subjectivity FROM scored")
def k9(spark, sf_dir):
    rows = _polarity(spark, sf_dir)
    return rows.select("doc_id", *[F.round(c, 6).alias(c) for c in ("polarity", "subjectivity")])


@query(
    "k10_classify_polarity",
    f"""WITH {DOC_SCORES} SELECT doc_id, CASE WHEN round_even(polarity, 0) > 0 THEN 1 ELSE 0 END AS rounded,
       CASE WHEN polarity >= 0.1 THEN 1 ELSE 0 END AS cut FROM scored""",
)
def k10(spark, sf_dir):
    rows = lx.classify_polarity(_polarity(spark, sf_dir)).withColumnRenamed("prediction", "rounded")
    return lx.classify_polarity(rows, 0.1).select("doc_id", "rounded", F.col("prediction").alias("cut"))


@query(
    "k10_polarity_sweep",
    f"""WITH {DOC_SCORES}, c(cutoff) AS (VALUES {', '.join(f'({x}::DOUBLE)' for x in POLARITY_CUTOFFS)}),
p AS (SELECT polarity, sentiment FROM scored JOIN (SELECT doc_id, sentiment FROM labelled) USING (doc_id)),
t AS (SELECT cutoff, count(*) FILTER (polarity >= cutoff AND sentiment = 1) AS tp, count(*) FILTER (polarity >= cutoff AND sentiment = 0) AS fp,
       count(*) FILTER (polarity < cutoff AND sentiment = 1) AS fn, count(*) FILTER (polarity < cutoff AND sentiment = 0) AS tn
FROM p, c GROUP BY cutoff)
SELECT *, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS sensitivity FROM t""",
)
def k10_sweep(spark, sf_dir):
    marks = V.table(spark, sf_dir, "labels").where("quality IS NOT NULL").select("doc_id", "quality")
    rows = lx.polarity_sweep(_polarity(spark, sf_dir).join(marks, "doc_id"), "quality")
    return rows.select("cutoff", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "sensitivity")])


SENTENCES = f"""{WORDS},
s AS (SELECT doc_id, {S.SENTENCES} AS l FROM documents),
r AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS sentence FROM s),
w AS (SELECT doc_id, pos, unnest({S.letters_list('sentence')}) AS word FROM r),
k AS (SELECT doc_id, pos, sum(polarity) / count(*) AS polarity FROM w JOIN lexicon USING (word) GROUP BY ALL),
sentence_scores AS (SELECT doc_id, pos, length(sentence) AS len, (coalesce(polarity, 0) + 1) / 2 AS score
           FROM r LEFT JOIN k USING (doc_id, pos))"""


def _sentence_scores(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    return lx.score_sentiment(docs, "doc_id", "text", _lexicon(spark, sf_dir), by="sentence")


@query("k11_score_sentiment", f"WITH {SENTENCES} SELECT doc_id, pos, len, round(score, 6) AS score FROM sentence_scores")
def k11(spark, sf_dir):
    return _sentence_scores(spark, sf_dir).select("doc_id", "pos", "len", F.round("score", 6).alias("score"))


DOCUMENT = rf"""list_aggregate({S.clean_list('text')}, 'string_agg', ' ')"""


@query(
    "k11_score_documents",
    f"""WITH {WORDS},
d AS (SELECT doc_id, list_filter(string_split(coalesce({DOCUMENT}, ''), ' '), lambda w: w <> '') AS l FROM documents),
w AS (SELECT doc_id, unnest(l) AS word FROM d),
k AS (SELECT doc_id, sum(polarity) / count(*) AS polarity FROM w JOIN lexicon USING (word) GROUP BY doc_id)
SELECT doc_id, round((coalesce(polarity, 0) + 1) / 2, 6) AS score FROM d LEFT JOIN k USING (doc_id)""",
)
def k11_documents(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = lx.score_sentiment(docs, "doc_id", "text", _lexicon(spark, sf_dir), by="doc")
    return rows.select("doc_id", F.round("score", 6).alias("score"))


@query(
    "k11_score_with_scorer",
    rf"""WITH s AS (SELECT doc_id, {S.SENTENCES} AS l FROM documents),
r AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS sentence FROM s)
SELECT doc_id, pos, length(sentence) AS len, round(length(replace(sentence, 'e', '')) / (length(sentence) + 1), 6) AS score FROM r""",
)
def k11_scorer(spark, sf_dir):
    def share(texts):
        return [len(t.replace("e", "")) / (len(t) + 1) for t in texts]

    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = lx.score_sentiment(docs, "doc_id", "text", scorer=share, by="sentence")
    return rows.select("doc_id", "pos", "len", F.round("score", 6).alias("score"))


def _predictions_sql(mean: str) -> str:
    return f"""WITH {SENTENCES}, m AS (SELECT doc_id, {mean} AS p FROM sentence_scores GROUP BY doc_id)
SELECT doc_id AS id, round(p, 6) AS percent_prediction, CAST(round_even(p, 0) AS INT) AS prediction, sentiment AS actual
FROM m JOIN labelled USING (doc_id)"""


def _predictions(spark, sf_dir, weighted):
    marks = V.table(spark, sf_dir, "labels").where("quality IS NOT NULL")
    rows = lx.sentiment_predictions(_sentence_scores(spark, sf_dir), marks, "doc_id", "quality", weighted)
    return rows.withColumn("percent_prediction", F.round("percent_prediction", 6))


@query("k12_sentiment_predictions", _predictions_sql(S.mean_of("score")))
def k12(spark, sf_dir):
    return _predictions(spark, sf_dir, False)


@query("k12_weighted_predictions", _predictions_sql(S.mean_of("score", "len")))
def k12_weighted(spark, sf_dir):
    return _predictions(spark, sf_dir, True)
