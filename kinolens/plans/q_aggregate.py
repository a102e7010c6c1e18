"""Queries that count and weigh."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinolens.functions.text import clean_tokens, letters_only_tokens
from kinolens.labels import LABELS_14
from kinolens.operators import aggregates as ag
from kinolens.operators import tables as tb
from kinolens.operators.sampling import split
from kinolens.operators.tokens import sentence_tokens
from kinolens.operators.vectors import word_signs
from kinolens.plans import sql as S
from kinolens.plans.catalog import query
from kinolens.plans.genre import label_dictionaries, second_pass_words
from kinolens.sources import views as V

TERM_COUNTS = f"{S.ASCII_TOKENS}, c AS (SELECT doc_id, word, count(*) AS n FROM tokens GROUP BY ALL)"
LETTERS = S.words_of("tokens", "documents", "doc_id, source", S.letters_list("text"))
LETTER_COUNTS = f"{LETTERS}, c AS (SELECT doc_id, word, count(*) AS n FROM tokens GROUP BY ALL)"
IS_TEST = "CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 30"


def _docs(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", "source", "text")


def _counts(spark, sf_dir):
    return ag.term_counts(_docs(spark, sf_dir), "doc_id", clean_tokens("text", ascii_only=True))


@query("f1_term_counts", f"WITH {TERM_COUNTS} SELECT doc_id, word, n FROM c")
def f1(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(
    "f2_tf_vector",
    f"""WITH {S.SECOND}, fw AS (SELECT DISTINCT word FROM second WHERE rank <= 37),
c AS (SELECT doc_id, word, count(*) AS n FROM tokens WHERE word IN (SELECT word FROM fw) GROUP BY ALL),
cells AS (SELECT d.doc_id, w.word, coalesce(c.n, 0) AS n FROM documents d CROSS JOIN fw w LEFT JOIN c ON c.doc_id = d.doc_id AND c.word = w.word)
SELECT doc_id, string_agg(CAST(n AS VARCHAR), ' ' ORDER BY word) AS tf FROM cells GROUP BY doc_id""",
)
def f2(spark, sf_dir):
    words = ag.vocabulary_list(second_pass_words(label_dictionaries(spark, sf_dir, store=True)))
    docs = _docs(spark, sf_dir).select("doc_id", clean_tokens("text", ascii_only=True).alias("tokens"))
    return ag.tf_array(docs, "tokens", words).select("doc_id", F.array_join("tf", " ").alias("tf"))


@query("f3_label_word_counts", f"WITH {S.LABEL_WORDS} SELECT label, word, n FROM label_words")
def f3(spark, sf_dir):
    return label_dictionaries(spark, sf_dir)


@query(
    "f4_corpus_vocabulary",
    f"WITH {LETTERS} SELECT word, count(*) AS n FROM tokens GROUP BY word ORDER BY n DESC, word LIMIT 6000",
)
def f4(spark, sf_dir):
    return ag.corpus_vocabulary(_docs(spark, sf_dir), letters_only_tokens("text"))


@query(
    "f5_bag_of_words",
    f"""WITH {LETTER_COUNTS},
vocab AS (SELECT word FROM (SELECT word, count(*) AS n FROM tokens WHERE NOT ({IS_TEST}) GROUP BY word) ORDER BY n DESC, word LIMIT 6000)
SELECT doc_id, word, n, CASE WHEN {IS_TEST} THEN 1 ELSE 0 END AS is_test FROM c WHERE word IN (SELECT word FROM vocab)""",
)
def f5(spark, sf_dir):
    train, test = split(_docs(spark, sf_dir), "doc_id")
    words = letters_only_tokens("text")
    vocab = ag.corpus_vocabulary(train, words)
    both = [
        ag.bag_of_words(part, "doc_id", words, vocab).withColumn("is_test", F.lit(flag))
        for part, flag in ((train, 0), (test, 1))
    ]
    return both[0].unionByName(both[1])


@query(
    "f6_tf_idf",
    f"""WITH {TERM_COUNTS}, f AS (SELECT word, count(*) AS df FROM c GROUP BY word)
SELECT doc_id, word, n, df, round(n * ln((SELECT count(*) FROM documents) / df), 6) AS weight FROM c JOIN f USING (word)""",
)
def f6(spark, sf_dir):
    rows = ag.tf_idf(_docs(spark, sf_dir), "doc_id", clean_tokens("text", ascii_only=True))
    return rows.select("doc_id", "word", "n", "df", F.round("weight", 6).alias("weight"))


@query(
    "f6_tf_idf_threshold",
    f"""WITH {TERM_COUNTS}, k AS (SELECT * FROM c WHERE n > 1), t AS (SELECT doc_id, sum(n) AS total FROM k GROUP BY doc_id),
f AS (SELECT word, count(*) AS df FROM k GROUP BY word)
SELECT doc_id, word, n, df, round(n / total * ln((SELECT count(*) FROM documents) / df), 6) AS weight
FROM k JOIN t USING (doc_id) JOIN f USING (word)""",
)
def f6_threshold(spark, sf_dir):
    words = clean_tokens("text", ascii_only=True)
    rows = ag.tf_idf(_docs(spark, sf_dir), "doc_id", words, threshold=1, relative=True)
    return rows.select("doc_id", "word", "n", "df", F.round("weight", 6).alias("weight"))


SENTENCE_SCORES = f"""WITH s AS (SELECT doc_id, {S.SENTENCES} AS l FROM documents),
r AS (SELECT doc_id, unnest(l) AS sentence FROM s),
v AS (SELECT doc_id, length(sentence) AS len, (length(sentence) - length(replace(sentence, 'e', ''))) % 7 / 9 AS score FROM r)"""


def _sentence_scores(spark, sf_dir):
    rows = sentence_tokens(_docs(spark, sf_dir), "doc_id", "text")
    n_e = F.length("sentence") - F.length(F.replace("sentence", F.lit("e")))
    return rows.select("doc_id", (n_e % 7 / 9).alias("score"), F.length("sentence").cast("long").alias("len"))


@query("f7_mean_sentence_score", f"{SENTENCE_SCORES} SELECT doc_id, round({S.mean_of('score')}, 6) AS score FROM v GROUP BY doc_id")
def f7(spark, sf_dir):
    rows = ag.mean_sentence_score(_sentence_scores(spark, sf_dir), "doc_id")
    return rows.select("doc_id", F.round("score", 6).alias("score"))


@query(
    "f8_weighted_sentence_score",
    f"{SENTENCE_SCORES} SELECT doc_id, round({S.mean_of('score', 'len')}, 6) AS score FROM v GROUP BY doc_id",
)
def f8(spark, sf_dir):
    rows = ag.weighted_sentence_score(_sentence_scores(spark, sf_dir), "doc_id")
    return rows.select("doc_id", F.round("score", 6).alias("score"))


FULL = 300
DIGEST = " || ".join(f"md5(word || '#{b}')" for b in range(10))


def full_sums(known_only: bool) -> str:
    """CTEs s: sums of hashed signs by document and dimension, of all words or of the 6,000 most frequent ones; t: the same as one text."""
    kept = "WHERE word IN (SELECT word FROM vocab)" if known_only else ""
    return f"""{LETTER_COUNTS},
vocab AS (SELECT word FROM (SELECT word, count(*) AS n FROM tokens GROUP BY word) ORDER BY n DESC, word LIMIT 6000),
d AS (SELECT doc_id, n, {DIGEST} AS digest FROM c {kept}),
s AS (SELECT doc_id, i AS dim, sum(n * (1 - 2 * (CAST(('0x' || substr(digest, i + 1, 1)) AS INT) % 2))) AS v, sum(n) AS known FROM d, range({FULL}) r(i) GROUP BY ALL),
t AS (SELECT b.doc_id, string_agg(CAST(CAST(coalesce(v, 0) AS BIGINT) AS VARCHAR), ' ' ORDER BY i) AS vec, CAST(max(coalesce(known, 0)) AS BIGINT) AS known
      FROM documents b CROSS JOIN range({FULL}) r(i) LEFT JOIN s ON s.doc_id = b.doc_id AND s.dim = i GROUP BY b.doc_id)"""


def _known_words(spark, sf_dir):
    """Word vectors for the 6,000 most frequent words: hashed signs."""
    vocab = ag.corpus_vocabulary(_docs(spark, sf_dir), letters_only_tokens("text"))
    return vocab.select("word", word_signs("word", FULL).alias("vec"))


@query("f9_sum_vectors", f"WITH {full_sums(True)} SELECT doc_id, vec, known FROM t")
def f9(spark, sf_dir):
    rows = ag.sum_vectors(_docs(spark, sf_dir), "doc_id", letters_only_tokens("text"), _known_words(spark, sf_dir), FULL)
    return rows.select("doc_id", F.array_join(F.col("vec").cast("array<long>"), " ").alias("vec"), "known")


@query(
    "f10_label_distribution",
    f"WITH {S.FILMS} SELECT label, count(*) AS n FROM documents d JOIN film_labels l ON l.title_url = d.source GROUP BY label",
)
def f10(spark, sf_dir):
    docs = V.reviews(spark, sf_dir).select(V.film_target(F.col("title_url")).alias("v"))
    return ag.label_distribution(docs, "v", LABELS_14).where("n > 0")


@query(
    "f11_genre_combinations",
    f"""WITH {S.FILMS}, g AS (SELECT title_url, string_agg(label, ' | ' ORDER BY label) AS genre, count(*) AS width FROM film_labels GROUP BY title_url),
m AS (SELECT genre, count(*) AS films, max(width) AS width FROM g GROUP BY genre)
SELECT count(*) AS mixes, count(*) FILTER (films = 1) AS singletons, CAST(max(width) AS INT) AS max_genres FROM m""",
)
def f11(spark, sf_dir):
    return ag.genre_combinations(V.movies(spark, sf_dir))


@query(
    "f12_corpus_by_min_words",
    r"""WITH w AS (SELECT len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS wc FROM documents),
c(min_words) AS (VALUES (0), (200), (500))
SELECT min_words, count(*) FILTER (wc > min_words) AS n_reviews FROM w, c GROUP BY min_words""",
)
def f12(spark, sf_dir):
    return ag.corpus_by_min_words(_docs(spark, sf_dir), "text")


@query(
    "f13_reviews_per_film",
    """WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
SELECT count(*) AS films, CAST(sum(n) AS BIGINT) AS reviews, round(avg(n), 6) AS mean_reviews, min(n) AS min_reviews, max(n) AS max_reviews FROM c""",
)
def f13(spark, sf_dir):
    rows = ag.reviews_per_film(V.reviews(spark, sf_dir))
    return rows.withColumn("mean_reviews", F.round("mean_reviews", 6))


@query(
    "f14_count_missing",
    "SELECT count(*) FILTER (quality IS NULL) AS missing, count(*) AS total FROM documents LEFT JOIN labels USING (doc_id)",
)
def f14(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").join(V.table(spark, sf_dir, "labels"), "doc_id", "left")
    return tb.count_missing(docs, "quality")
