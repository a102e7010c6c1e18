"""Queries that join, rank, combine and split."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinolens.functions.text import clean_tokens, split_sentences, word_count
from kinolens.labels import COMMON_TOP, ENGLISH_STOP_WORDS, LABELS_14, LISTING_OFFSETS, REVIEW_OFFSETS, STOP_PUNCTUATION
from kinolens.operators import joins as jn
from kinolens.operators import ranking as rk
from kinolens.operators import sampling as sp
from kinolens.operators import sets as st
from kinolens.operators.aggregates import corpus_vocabulary, term_counts
from kinolens.operators.tokens import stop_words
from kinolens.plans import sql as S
from kinolens.plans.catalog import query
from kinolens.plans.genre import label_dictionaries, second_pass_words, top_words_per_label
from kinolens.sources import views as V


def _docs(spark, sf_dir):
    return V.table(spark, sf_dir, "documents")


# ---- joins ----


@query(
    "e1_join_reviews_movies",
    f"""WITH {S.FILMS}, g AS (SELECT title_url, string_agg(label, ' | ' ORDER BY label) AS genre FROM film_labels GROUP BY title_url)
SELECT d.doc_id AS review_id, d.source AS title_url, g.genre FROM documents d LEFT JOIN g ON g.title_url = d.source""",
)
def e1(spark, sf_dir):
    joined = jn.join_reviews_movies(V.reviews(spark, sf_dir), V.movies(spark, sf_dir))
    return joined.select("review_id", "title_url", "genre")


@query("e2_not_yet_seen", "SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def e2(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", "source")
    return jn.not_yet_seen(rows, V.table(spark, sf_dir, "labels"), "doc_id")


VOCAB = f"""WITH {S.ASCII_TOKENS},
vocab AS (SELECT word FROM (SELECT word, count(*) AS n FROM tokens GROUP BY word) ORDER BY n DESC, word LIMIT 300),
c AS (SELECT doc_id, word, count(*) AS n FROM tokens GROUP BY ALL)"""


def _counts_and_vocab(spark, sf_dir):
    words = clean_tokens("text", ascii_only=True)
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    return term_counts(docs, "doc_id", words), corpus_vocabulary(docs, words, 300)


@query("e3_keep_vocabulary", f"{VOCAB} SELECT word, doc_id, n FROM c WHERE word IN (SELECT word FROM vocab)")
def e3(spark, sf_dir):
    counts, vocab = _counts_and_vocab(spark, sf_dir)
    return jn.keep_vocabulary(counts, vocab)


@query("e4_drop_vocabulary", f"{VOCAB} SELECT word, doc_id, n FROM c WHERE word NOT IN (SELECT word FROM vocab)")
def e4(spark, sf_dir):
    counts, vocab = _counts_and_vocab(spark, sf_dir)
    return jn.drop_vocabulary(counts, vocab)


@query(
    "e5_lookup_vectors",
    """SELECT doc_id, source, CAST(len(embedding) AS INT) AS width, round(CAST(embedding[1] AS DOUBLE), 6) AS first
FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id""",
)
def e5(spark, sf_dir):
    vectors = V.doc_vectors(spark, sf_dir).select(F.col("id").alias("doc_id"), "vec")
    rows = jn.lookup_vectors(_docs(spark, sf_dir).select("doc_id", "source"), vectors, "doc_id")
    return rows.select(
        "doc_id", "source", F.size("vec").alias("width"), F.round(F.get("vec", F.lit(0)), 6).alias("first")
    )


@query(
    "e5_unmatched_keys",
    "SELECT count(*) AS unmatched FROM documents d WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
)
def e5_unmatched(spark, sf_dir):
    vectors = V.doc_vectors(spark, sf_dir).select(F.col("id").alias("doc_id"), "vec")
    return jn.unmatched_keys(_docs(spark, sf_dir).select("doc_id"), vectors, "doc_id")


@query(
    "e6_crawl_frontier",
    f"""WITH todo AS (SELECT DISTINCT conv_id AS title_url FROM conversations
  WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'system')),
o("offset") AS (VALUES {', '.join(f'({x})' for x in REVIEW_OFFSETS)})
SELECT title_url, "offset", '/title/' || title_url || '/reviews?start=' || "offset" AS url FROM todo, o""",
)
def e6(spark, sf_dir):
    rows = V.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("title_url"), "role")
    url = F.concat(
        F.lit("/title/"), F.col("title_url").cast("string"), F.lit("/reviews?start="), F.col("offset").cast("string")
    )
    seen = rows.where(F.col("role") == "system")
    return jn.crawl_frontier(rows.select("title_url").distinct(), "title_url", REVIEW_OFFSETS, url, seen)


@query(
    "e6_listing_frontier",
    f"""WITH {S.FILMS}, o("offset") AS (VALUES {', '.join(f'({x})' for x in LISTING_OFFSETS)})
SELECT label, "offset", '/search?genres=' || label || '&start=' || "offset" AS url FROM (SELECT DISTINCT label FROM film_labels), o""",
)
def e6_listing(spark, sf_dir):
    labels = V.movies(spark, sf_dir).select(F.explode("labels").alias("label")).distinct()
    url = F.concat(F.lit("/search?genres="), F.col("label"), F.lit("&start="), F.col("offset").cast("string"))
    return jn.crawl_frontier(labels, "label", LISTING_OFFSETS, url)


@query(
    "e7_zip_by_position",
    rf"""WITH s AS (SELECT doc_id, {S.SENTENCES} AS l FROM documents),
r AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS sentence FROM s)
SELECT doc_id, pos, sentence, CAST(len(list_filter(regexp_split_to_array(sentence, '\s+'), lambda w: w <> '')) AS INT) AS wc FROM r""",
)
def e7(spark, sf_dir):
    sentences = split_sentences("text")
    zipped = jn.zip_by_position(
        sentences, F.transform(sentences, lambda s: word_count(s)), names=("sentence", "wc")
    )
    rows = _docs(spark, sf_dir).select("doc_id", F.posexplode(zipped).alias("pos", "z"))
    return rows.select("doc_id", "pos", "z.sentence", "z.wc")


# ---- ranking ----

WC = r"CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS INT)"
LONGEST = f"""WITH r AS (SELECT conv_id AS title_url, turn AS pos, text AS review, {WC} AS wc FROM conversations)
SELECT title_url, pos, review, wc FROM (
  SELECT *, row_number() OVER (PARTITION BY title_url ORDER BY wc DESC, pos) AS rn FROM r WHERE wc > 0) WHERE rn = 1"""


@query("g1_longest_review", LONGEST)
def g1(spark, sf_dir):
    return rk.longest_review(V.film_reviews(spark, sf_dir))


@query("g2_top_words", f"WITH {S.RANKED} SELECT label, CAST(rank AS INT) AS rank, word, n FROM ranked WHERE rank <= 37")
def g2(spark, sf_dir):
    return top_words_per_label(spark, sf_dir, 37)


@query("g2_top_words_deep", f"WITH {S.RANKED} SELECT label, CAST(rank AS INT) AS rank, word, n FROM ranked WHERE rank <= 5000")
def g2_deep(spark, sf_dir):
    return top_words_per_label(spark, sf_dir, 5000)


@query("g3_sort_dictionary", f"WITH {S.LABEL_WORDS} SELECT label, word, n FROM label_words ORDER BY label, n DESC, word")
def g3(spark, sf_dir):
    return rk.sort_dictionary(label_dictionaries(spark, sf_dir))


@query(
    "g4_dedupe_first",
    """SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1""",
)
def g4(spark, sf_dir):
    # The digest is the shuffle key, so long texts are not compared while sorting.
    rows = _docs(spark, sf_dir).select("doc_id", "text", F.sha2("text", 256).alias("digest"))
    return rk.dedupe_first(rows, "digest", "doc_id").drop("digest")


SHUFFLED = "SELECT doc_id, row_number() OVER (ORDER BY md5('42' || doc_id), doc_id) - 1 AS row_no FROM documents"


@query("g5_shuffle_rows", "SELECT doc_id, lang FROM documents ORDER BY md5('42' || doc_id), doc_id")
def g5(spark, sf_dir):
    return rk.shuffle_rows(_docs(spark, sf_dir).select("doc_id", "lang"), "doc_id", 42)


@query("g5_number_rows", SHUFFLED)
def g5_number(spark, sf_dir):
    return rk.number_rows(_docs(spark, sf_dir).select("doc_id"), "doc_id", 42)


@query("g6_assign_batches", f"SELECT doc_id, CAST(row_no // 100 AS BIGINT) AS batch FROM ({SHUFFLED})")
def g6(spark, sf_dir):
    return rk.assign_batches(_docs(spark, sf_dir).select("doc_id"), "doc_id", 100)


@query("g7_limit_rows", "SELECT doc_id, source, lang FROM documents ORDER BY doc_id LIMIT 1000")
def g7(spark, sf_dir):
    return rk.limit_rows(_docs(spark, sf_dir).select("doc_id", "source", "lang"), "doc_id", 1000)


@query(
    "g8_cloud_weights",
    f"""WITH {S.RANKED} SELECT label, CAST(rank AS INT) AS rank, word, n,
       round(n / max(n) OVER (PARTITION BY label), 6) AS weight FROM ranked WHERE rank <= 75""",
)
def g8(spark, sf_dir):
    rows = rk.cloud_weights(label_dictionaries(spark, sf_dir))
    return rows.select("label", "rank", "word", "n", F.round("weight", 6).alias("weight"))


# ---- set operations ----


@query(
    "h1_union_corpora",
    """SELECT CAST(d.doc_id AS VARCHAR) AS id, 'train' AS part, quality AS sentiment, length(text) AS n_chars
FROM documents d JOIN labels USING (doc_id) WHERE quality IS NOT NULL
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'extra', NULL, length(text) FROM documents ANTI JOIN labels USING (doc_id)
UNION ALL SELECT 't' || conv_id || '_' || turn, 'test', NULL, length(text) FROM conversations""",
)
def h1(spark, sf_dir):
    train = V.labelled(spark, sf_dir).withColumn("part", F.lit("train"))
    extra = V.unlabelled(spark, sf_dir).withColumn("part", F.lit("extra"))
    turns = V.table(spark, sf_dir, "conversations")
    test = turns.select(
        F.concat_ws("", F.lit("t"), "conv_id", F.lit("_"), "turn").alias("id"), F.col("text").alias("review"),
        F.lit("test").alias("part"),
    )
    parts = [p.withColumn("id", F.col("id").cast("string")) for p in (train, test, extra)]
    return st.union_corpora(*parts).select("id", "part", "sentiment", F.length("review").cast("long").alias("n_chars"))


@query(
    "h2_common_words",
    f"""WITH {S.RANKED} SELECT word FROM ranked WHERE rank <= 5000 GROUP BY word HAVING count(*) = {len(LABELS_14)}""",
)
def h2(spark, sf_dir):
    return st.common_words(label_dictionaries(spark, sf_dir), LABELS_14)


@query("h3_feature_words", f"WITH {S.SECOND} SELECT DISTINCT word FROM second WHERE rank <= 37")
def h3(spark, sf_dir):
    return second_pass_words(label_dictionaries(spark, sf_dir, store=True))


FIXED = ", ".join("('" + w.replace("'", "''") + "')" for w in ENGLISH_STOP_WORDS + STOP_PUNCTUATION)


@query(
    "h4_merge_stop_words",
    f"""WITH {S.RANKED}, fixed(word) AS (VALUES {FIXED})
SELECT word FROM fixed UNION SELECT word FROM ranked WHERE rank <= {COMMON_TOP} GROUP BY word HAVING count(*) = {len(LABELS_14)}""",
)
def h4(spark, sf_dir):
    fixed = spark.createDataFrame([(w,) for w in stop_words(punctuation=True)], "word string")
    return st.merge_stop_words(fixed, st.common_words(label_dictionaries(spark, sf_dir), LABELS_14))


@query(
    "h5_label_overlap",
    f"""WITH {S.RANKED}, t AS (SELECT label, word FROM ranked WHERE rank <= 200),
pairs AS (SELECT a.label AS label_a, b.label AS label_b FROM label_names a JOIN label_names b ON a.label < b.label),
s AS (SELECT label_a, label_b, (SELECT count(*) FROM t x JOIN t y USING (word) WHERE x.label = label_a AND y.label = label_b) AS shared,
      (SELECT count(*) FROM t WHERE label IN (label_a, label_b)) AS both_sizes FROM pairs)
SELECT label_a, label_b, shared, round(CASE WHEN both_sizes - shared > 0 THEN shared / (both_sizes - shared) ELSE 0 END, 6) AS jaccard FROM s""",
)
def h5(spark, sf_dir):
    rows = st.label_overlap(label_dictionaries(spark, sf_dir), LABELS_14, 200)
    return rows.select("label_a", "label_b", "shared", F.round("jaccard", 6).alias("jaccard"))


@query(
    "h6_distinctive_words",
    f"""WITH {S.RANKED}, common AS (SELECT word FROM ranked WHERE rank <= {COMMON_TOP} GROUP BY word HAVING count(*) = {len(LABELS_14)}),
r AS (SELECT label, word, n, row_number() OVER (PARTITION BY label ORDER BY n DESC, word) AS rk
      FROM label_words WHERE word NOT IN (SELECT word FROM common))
SELECT label, CAST(rk AS INT) AS rank, word, n FROM r WHERE rk <= 37""",
)
def h6(spark, sf_dir):
    rows = st.distinctive_words(label_dictionaries(spark, sf_dir, store=True), LABELS_14, 37)
    return rows.select("label", "rank", "word", "n")


@query(
    "h6_distinctive_by_weight",
    f"""WITH {S.LABEL_WORDS}, f AS (SELECT word, count(*) AS df FROM label_words GROUP BY word),
w AS (SELECT label, word, n, n * ln({len(LABELS_14)} / df) AS weight FROM label_words JOIN f USING (word)),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY weight DESC, word) AS rk FROM w)
SELECT label, CAST(rk AS INT) AS rank, word, n, round(weight, 6) AS weight FROM r WHERE rk <= 37""",
)
def h6_weight(spark, sf_dir):
    rows = st.distinctive_by_weight(label_dictionaries(spark, sf_dir, store=True), len(LABELS_14), 37)
    return rows.select("label", "rank", "word", "n", F.round("weight", 6).alias("weight"))


# ---- hold-out ----


@query(
    "i1_split",
    """SELECT doc_id, CASE WHEN CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 30 THEN 1 ELSE 0 END AS is_test
FROM documents""",
)
def i1(spark, sf_dir):
    return sp.with_split(_docs(spark, sf_dir).select("doc_id"), "doc_id")


@query(
    "i1_split_seeded",
    """SELECT doc_id FROM documents WHERE CAST(('0x' || substr(md5('42' || doc_id), 1, 8)) AS BIGINT) % 100 < 30""",
)
def i1_seeded(spark, sf_dir):
    return sp.split(_docs(spark, sf_dir).select("doc_id"), "doc_id", 30, 42)[1]
