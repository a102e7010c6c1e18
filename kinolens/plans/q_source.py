"""Queries over sources and sinks: what is written is read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinolens.functions.text import clean_tokens, word_count
from kinolens.labels import CUTOFFS
from kinolens.operators import tables as tb
from kinolens.operators.aggregates import term_counts
from kinolens.operators.metrics import threshold_sweep
from kinolens.operators.sets import feature_words
from kinolens.plans import sql as S
from kinolens.plans.catalog import query
from kinolens.plans.genre import label_dictionaries
from kinolens.plans.q_evaluate import SWEEP_SQL
from kinolens.session import fresh_dir
from kinolens.sources import files as fl
from kinolens.sources import views as V


def _flat(c):
    return F.translate(c, "\n\t\r", "   ")


def _quoted(c):
    return F.concat(F.lit('"'), c, F.lit('"'))


FLAT = "'\"' || translate(text, chr(10) || chr(9) || chr(13), '   ') || '\"' AS review"


@query(
    "a1_read_reviews_tsv",
    f"""SELECT '"' || d.doc_id || '"' AS id, quality AS sentiment, {FLAT}
FROM documents d JOIN labels USING (doc_id) WHERE quality IS NOT NULL""",
)
def a1(spark, sf_dir):
    rows = V.labelled(spark, sf_dir)
    raw = rows.select(_quoted(F.col("id").cast("string")).alias("id"), "sentiment", _quoted(_flat("review")).alias("review"))
    path = fresh_dir(spark, "labelled-tsv")
    fl.write_reviews_tsv(raw, path)
    return fl.read_reviews_tsv(spark, path)


@query(
    "a1_read_unlabelled_tsv",
    f"""SELECT '"' || d.doc_id || '"' AS id, {FLAT} FROM documents d ANTI JOIN labels USING (doc_id)""",
)
def a1_unlabelled(spark, sf_dir):
    rows = V.unlabelled(spark, sf_dir)
    raw = rows.select(_quoted(F.col("id").cast("string")).alias("id"), _quoted(_flat("review")).alias("review"))
    path = fresh_dir(spark, "unlabelled-tsv")
    fl.write_reviews_tsv(raw, path)
    return fl.read_reviews_tsv(spark, path, labelled=False)


@query("a2_read_csv_table", "SELECT doc_id AS review_id, source AS title_url, text AS review, lang FROM documents")
def a2(spark, sf_dir):
    rows = V.reviews(spark, sf_dir)
    path = fresh_dir(spark, "reviews-csv")
    fl.write_csv_table(rows, path)
    return fl.read_csv_table(spark, path, rows.schema)


@query(
    "a3_read_matrix_csv",
    """SELECT CAST(len(embedding) AS INT) AS width, round(CAST(embedding[1] AS DOUBLE), 6) AS first,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
)
def a3(spark, sf_dir):
    path = fresh_dir(spark, "matrix-csv")
    fl.write_matrix_csv(V.doc_vectors(spark, sf_dir), "vec", 64, path)
    rows = fl.read_matrix_csv(spark, path, 64)
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        F.size("features").alias("width"), F.round(F.get("features", F.lit(0)), 6).alias("first"),
        F.round(total, 6).alias("total"),
    )


@query(
    "a4_scan_missing",
    """SELECT doc_id, text FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL ORDER BY doc_id LIMIT 1000""",
)
def a4(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").join(V.table(spark, sf_dir, "labels"), "doc_id", "left")
    return tb.scan_missing(docs, "quality", ["doc_id", "text"], "doc_id", 1000)


@query("a5_scan_projection", "SELECT source FROM documents")
def a5(spark, sf_dir):
    return tb.scan_projection(V.table(spark, sf_dir, "documents"), ["source"])


@query("a6_read_landed_pages", "SELECT page_id, url, CAST(length(html) AS INT) AS n_chars FROM pages")
def a6(spark, sf_dir):
    rows = fl.read_landed_pages(spark, f"{sf_dir}/pages.parquet")
    return rows.select("page_id", "url", F.length("html").alias("n_chars"))


@query(
    "a7_write_predictions",
    """SELECT CAST(d.doc_id AS VARCHAR) AS id, CAST(length(text) % 2 AS INT) AS prediction, quality AS actual
FROM documents d JOIN labels USING (doc_id) WHERE quality IS NOT NULL""",
)
def a7(spark, sf_dir):
    rows = V.labelled(spark, sf_dir).select(
        "id", (F.length("review") % 2).alias("prediction"), F.col("sentiment").alias("actual")
    )
    path = fresh_dir(spark, "predictions")
    fl.write_predictions(rows, path)
    return fl.read_predictions(spark, path, "id string, prediction int, actual int")


@query("a8_write_label_dictionaries", f"WITH {S.LABEL_WORDS} SELECT label, word, n FROM label_words")
def a8(spark, sf_dir):
    path = fresh_dir(spark, "dictionaries")
    fl.write_label_dictionaries(label_dictionaries(spark, sf_dir), path)
    return fl.read_label_dictionary(spark, path)


@query("a9_read_label_dictionary", f"WITH {S.RANKED} SELECT label, word, n FROM ranked WHERE rank <= 125")
def a9(spark, sf_dir):
    path = fresh_dir(spark, "dictionaries")
    fl.write_label_dictionaries(label_dictionaries(spark, sf_dir), path)
    return fl.read_label_dictionary(spark, path, num_words=125)


@query("a10_word_set", f"WITH {S.RANKED} SELECT DISTINCT word FROM ranked WHERE rank <= 37")
def a10(spark, sf_dir):
    path = fresh_dir(spark, "word-set")
    fl.write_word_set(feature_words(label_dictionaries(spark, sf_dir)), path)
    return fl.read_word_set(spark, path)


@query("a10_word_set_literal", f"WITH {S.ASCII_TOKENS} SELECT DISTINCT word FROM tokens")
def a10_literal(spark, sf_dir):
    # One literal per document, so no line holds more than one document's words.
    docs = V.table(spark, sf_dir, "documents")
    words = F.array_distinct(clean_tokens("text", ascii_only=True))
    inner = F.array_join(F.transform(words, lambda w: F.concat(F.lit("'"), w, F.lit("'"))), ", ")
    path = fresh_dir(spark, "word-set-literal")
    docs.select(F.concat(F.lit("set(["), inner, F.lit("])")).alias("value")).write.text(path)
    return fl.read_word_set_literal(spark, path)


@query(
    "a11_save_weights",
    f"""WITH {S.ASCII_TOKENS}, c AS (SELECT doc_id, word, count(*) AS n FROM tokens GROUP BY ALL)
SELECT doc_id, word, n FROM c""",
)
def a11(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    counts = term_counts(docs, "doc_id", clean_tokens("text", ascii_only=True))
    path = fresh_dir(spark, "weights")
    fl.save_weights(counts, path)
    return fl.load_weights(spark, path, counts.schema)


@query("a12_write_report", SWEEP_SQL)
def a12(spark, sf_dir):
    report = threshold_sweep(V.scores(spark, sf_dir), CUTOFFS)
    path = fresh_dir(spark, "report")
    fl.write_report(report, path)
    back = fl.read_report(spark, path, report.schema)
    return back.select(
        "cutoff", "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def _arrivals(spark, sf_dir):
    """Reviews of films that already have a system turn, and all other rows."""
    rows = V.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("title_url"), F.col("turn").alias("pos"), F.col("text").alias("review"), "role"
    )
    existing = rows.where(F.col("role") == "system").drop("role")
    return existing, rows.where(F.col("role") != "system").drop("role")


ARRIVALS = """
existing AS (SELECT conv_id AS title_url, turn AS pos, text AS review FROM conversations WHERE role = 'system'),
incoming AS (SELECT conv_id AS title_url, turn AS pos, text AS review FROM conversations WHERE role <> 'system')"""


@query(
    "a13_insert_if_absent",
    f"""WITH {ARRIVALS}
SELECT * FROM existing UNION ALL
SELECT title_url, pos, review FROM (
  SELECT *, row_number() OVER (PARTITION BY title_url ORDER BY pos) AS rn FROM incoming
  WHERE title_url NOT IN (SELECT title_url FROM existing)) WHERE rn = 1""",
)
def a13(spark, sf_dir):
    existing, incoming = _arrivals(spark, sf_dir)
    return tb.insert_if_absent(existing, incoming, "title_url", "pos")


@query(
    "a13_rejected_duplicates",
    f"""WITH {ARRIVALS}, c AS (SELECT title_url, count(*) AS n FROM incoming GROUP BY title_url),
r AS (SELECT title_url, n - CASE WHEN title_url IN (SELECT title_url FROM existing) THEN 0 ELSE 1 END AS rejected FROM c)
SELECT title_url, CAST(rejected AS BIGINT) AS rejected FROM r WHERE rejected > 0""",
)
def a13_rejected(spark, sf_dir):
    existing, incoming = _arrivals(spark, sf_dir)
    return tb.rejected_duplicates(existing, incoming, "title_url")


@query(
    "a14_update_by_key",
    r"""SELECT doc_id, coalesce(l.quality, -1) AS quality,
       CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS INT) AS word_count
FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def a14(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    base = docs.select("doc_id", F.lit(-1).alias("quality"))
    marked = tb.update_by_key(base, V.table(spark, sf_dir, "labels"), "doc_id", ["quality"])
    counts = docs.select("doc_id", word_count("text").alias("word_count"))
    return tb.update_by_key(marked, counts, "doc_id", ["word_count"])


