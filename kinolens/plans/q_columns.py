"""Queries over single columns: labels, targets, cut-offs, string encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinolens.functions import arrays as ar
from kinolens.functions.text import replace_newlines, word_count
from kinolens.labels import LABELS_14, LABELS_18, UNWANTED_GENRES
from kinolens.operators import tables as tb
from kinolens.operators.aggregates import explode_labels
from kinolens.operators.models import to_matrix
from kinolens.plans import sql as S
from kinolens.plans.catalog import query
from kinolens.sources import views as V

WC = r"CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS INT)"

# Genre text per document: the labels of its film, capitalised, plus two more.
GENRE_TEXT = (
    S.FILMS
    + """,
genre_text AS (
  SELECT d.doc_id, 'Film-Noir | ' || string_agg(upper(label[1]) || label[2:], ' | ' ORDER BY pos DESC) || ' | Crime' AS g
  FROM documents d JOIN film_labels l ON l.title_url = d.source GROUP BY d.doc_id
)"""
)


def genre_text(spark, sf_dir):
    """doc_id, g: capitalised, unsorted genre text of every document."""
    docs = V.reviews(spark, sf_dir).select(
        F.col("review_id").alias("doc_id"), V.film_target(F.col("title_url")).alias("v")
    )
    names = F.reverse(F.transform(ar.names_of("v", LABELS_14), lambda g: F.concat(F.upper(F.left(g, F.lit(1))), F.substring(g, 2, 99))))
    joined = F.array_join(names, " | ")
    return docs.select("doc_id", F.concat(F.lit("Film-Noir | "), joined, F.lit(" | Crime")).alias("g"))


@query("d1_min_words", f"SELECT doc_id, {WC} AS wd_ct FROM documents WHERE {WC} > 500")
def d1(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    return tb.min_words(docs, "text", 500).select("doc_id", "wd_ct")


@query(
    "d2_with_target",
    "SELECT d.doc_id AS id, text AS review, quality AS target FROM documents d JOIN labels USING (doc_id) WHERE quality IS NOT NULL",
)
def d2(spark, sf_dir):
    return tb.with_target(V.labelled(spark, sf_dir), "sentiment", ["id", "review"])


@query(
    "d3_normalise_genres",
    f"""WITH {GENRE_TEXT}, p AS (SELECT doc_id, list_sort(string_split(lower(g), ' | ')) AS l FROM genre_text)
SELECT doc_id, array_to_string(list_filter(l, lambda x: x NOT IN ({S.quoted(UNWANTED_GENRES)})), ' | ') AS dropped,
       array_to_string(list_filter(l, lambda x: x IN ({S.quoted(LABELS_14)})), ' | ') AS kept FROM p""",
)
def d3(spark, sf_dir):
    return genre_text(spark, sf_dir).select(
        "doc_id",
        ar.normalise_genres("g", drop=UNWANTED_GENRES).alias("dropped"),
        ar.normalise_genres("g", keep=LABELS_14).alias("kept"),
    )


def _membership(labels) -> str:
    return "||".join(f"CASE WHEN list_contains(l, '{x}') THEN '1' ELSE '0' END" for x in labels)


@query(
    "d4_genre_vector",
    f"""WITH {GENRE_TEXT}, p AS (SELECT doc_id, string_split(lower(g), ' | ') AS l FROM genre_text)
SELECT doc_id, {_membership(LABELS_18)} AS v18, {_membership(LABELS_14)} AS v14 FROM p""",
)
def d4(spark, sf_dir):
    names = ar.split_genres("g")
    return genre_text(spark, sf_dir).select(
        "doc_id",
        F.array_join(ar.genre_vector(names, LABELS_18), "").alias("v18"),
        F.array_join(ar.genre_vector(names, LABELS_14), "").alias("v14"),
    )


@query(
    "d5_select_labels",
    f"""WITH {GENRE_TEXT}, p AS (SELECT doc_id, string_split(lower(g), ' | ') AS l FROM genre_text)
SELECT doc_id, {_membership(LABELS_14)} AS target FROM p""",
)
def d5(spark, sf_dir):
    full = ar.genre_vector(ar.split_genres("g"), LABELS_18)
    return genre_text(spark, sf_dir).select("doc_id", F.array_join(ar.select_labels(full), "").alias("target"))


DROPPED = ["drama", "horror", "war", "western"]


@query(
    "d6_drop_labels",
    f"""WITH {S.REVIEW_SCORES}
SELECT label, count(*) AS n, CAST(sum(actual) AS BIGINT) AS support FROM scores
WHERE label NOT IN ({S.quoted(DROPPED)}) GROUP BY label""",
)
def d6(spark, sf_dir):
    rows = tb.drop_labels(V.scores(spark, sf_dir), DROPPED)
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("actual").alias("support"))


@query(
    "d7_explode_labels",
    f"WITH {S.FILMS} SELECT d.doc_id AS review_id, l.label FROM documents d JOIN film_labels l ON l.title_url = d.source",
)
def d7(spark, sf_dir):
    docs = V.reviews(spark, sf_dir).select("review_id", V.film_target(F.col("title_url")).alias("v"))
    return explode_labels(docs, "v", LABELS_14)


@query(
    "d8_to_matrix",
    """SELECT vec_id AS id, CAST(len(embedding) AS INT) AS width, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total,
       label AS hot FROM embeddings""",
)
def d8(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    rows = to_matrix(V.doc_vectors(spark, sf_dir).select("id", "vec", "target"), "vec", "target")
    cells = vector_to_array("features")
    total = F.aggregate(cells, F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "id", F.size(cells).alias("width"), F.round(total, 6).alias("total"),
        (F.array_position("target", F.lit(1)) - 1).cast("int").alias("hot"),
    )


@query(
    "d9_preview",
    """SELECT count(*) AS n_rows, CAST(3 AS INT) AS n_cols, arg_min(text, doc_id) AS first_text
FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL""",
)
def d9(spark, sf_dir):
    return tb.preview(V.labelled(spark, sf_dir), "id", "review")


@query(
    "d10_round_half_even",
    "SELECT doc_id, CAST(round_even(n_chars / 2, 0) AS INT) AS half, CAST(round_even(-n_chars / 4, 0) AS INT) AS quarter FROM documents",
)
def d10(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        ar.round_half_even(F.col("n_chars") / 2).alias("half"),
        ar.round_half_even(-F.col("n_chars") / 4).alias("quarter"),
    )


@query(
    "d11_threshold",
    f"""WITH {S.REVIEW_SCORES}
SELECT id, label, CASE WHEN p >= 0.25 THEN 1 ELSE 0 END AS hit FROM scores""",
)
def d11(spark, sf_dir):
    return V.scores(spark, sf_dir).select("id", "label", ar.threshold("p", 0.25).alias("hit"))


@query(
    "d11_threshold_vector",
    """SELECT vec_id AS id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x >= 0.1 THEN 1 ELSE 0 END), '') AS hits
FROM embeddings""",
)
def d11_vector(spark, sf_dir):
    rows = V.doc_vectors(spark, sf_dir)
    return rows.select("id", F.array_join(ar.threshold_vector("vec", 0.1), "").alias("hits"))


@query("d12_replace_newlines", "SELECT doc_id, replace(text, chr(10), ' ') AS body FROM documents")
def d12(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", replace_newlines("text").alias("body"))


# ---- string encodings ----


@query(
    "b5_parse_rating",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN CAST(d.doc_id % 10 + 1 AS INT) END AS rating
FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def b5(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id")
    rated = docs.join(V.table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("r")), "doc_id", "left")
    alt = F.when(F.col("r") == 1, F.concat(F.col("doc_id") % 10 + 1, F.lit("/10"))).otherwise("portrait")
    return rated.select("doc_id", ar.parse_rating(alt).alias("rating"))


@query("b8_strip_outer", "SELECT doc_id, text AS review, CAST(doc_id AS VARCHAR) AS id FROM documents")
def b8(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    wrapped = docs.select(
        "doc_id",
        F.concat(F.lit('"'), "text", F.lit('"')).alias("review"),
        F.concat(F.lit('"'), F.col("doc_id").cast("string"), F.lit('"')).alias("id"),
    )
    return wrapped.select("doc_id", ar.strip_outer("review").alias("review"), ar.strip_outer("id").alias("id"))


@query("b9_parse_bracketed_int", f"SELECT doc_id, {WC} AS wd_ct FROM documents")
def b9(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    raw = docs.select("doc_id", F.concat(F.lit("["), word_count("text").cast("string"), F.lit("]")).alias("word_count"))
    return raw.select("doc_id", ar.parse_bracketed_int("word_count").alias("wd_ct"))


@query(
    "b10_parse_nested_vector",
    """SELECT vec_id AS id, CAST(len(embedding) AS INT) AS width, round(CAST(embedding[1] AS DOUBLE), 6) AS first,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
)
def b10(spark, sf_dir):
    raw = V.doc_vectors(spark, sf_dir).select("id", F.to_json(F.array("vec")).alias("doc_vec"))
    rows = raw.select("id", ar.parse_nested_vector("doc_vec").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "id", F.size("v").alias("width"), F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(total, 6).alias("total")
    )


FLAGS = f"""WITH {S.FILMS}
SELECT d.doc_id AS review_id, array_to_string(f.genre_vec, '') AS target
FROM documents d JOIN films f ON f.title_url = d.source"""


@query("b11_parse_bool_vector", FLAGS)
def b11(spark, sf_dir):
    flags = F.transform(V.film_target(F.col("title_url")), lambda x: (x == 1).cast("string"))
    raw = V.reviews(spark, sf_dir).select(
        "review_id", F.concat(F.lit("["), F.array_join(flags, ","), F.lit("]")).alias("genre_vec")
    )
    return raw.select("review_id", F.array_join(ar.parse_bool_vector("genre_vec"), "").alias("target"))


@query("b12_parse_number_vector", FLAGS)
def b12(spark, sf_dir):
    raw = V.reviews(spark, sf_dir).select(
        "review_id",
        F.concat(F.lit("["), F.array_join(V.film_target(F.col("title_url")), " "), F.lit("]")).alias("abr_targ"),
    )
    numbers = ar.parse_number_vector("abr_targ").cast("array<int>")
    return raw.select("review_id", F.array_join(numbers, "").alias("target"))
