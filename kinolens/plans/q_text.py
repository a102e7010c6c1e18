"""Queries over text: cleaning, words, sentences, stems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolens.functions import text as tx
from kinolens.functions.porter import porter_stem
from kinolens.labels import ENGLISH_STOP_WORDS, STOP_PUNCTUATION
from kinolens.operators import tokens as tk
from kinolens.plans import sql as S
from kinolens.plans.catalog import query
from kinolens.sources.views import reviews, table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _words_per_doc(words: str, stops: bool = False, html: bool = True) -> str:
    """SQL: doc_id and its words joined by a space."""
    source = S.stripped("text") if html else "text"
    listed = words.replace("text", f"({source})") if html else words
    if stops:
        listed = f"list_filter({listed}, lambda x: x NOT IN {S.STOP_WORDS})"
    return f"SELECT doc_id, array_to_string({listed}, ' ') AS words FROM documents"


def _stemmed(words: str, stops: bool) -> str:
    base = _words_per_doc(words, stops)
    return f"""
WITH base AS ({base}),
lists AS (SELECT doc_id, string_split(words, ' ') AS l FROM base),
placed AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS pos FROM lists),
{S.stem_ctes('placed')}
SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS words FROM placed JOIN stems USING (word) GROUP BY doc_id"""


@query("c1_clean_text", f"SELECT doc_id, ' ' || array_to_string({S.clean_list('text', space=chr(92) + 's+')}, ' ') || ' ' AS cleaned FROM documents")
def c1(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tx.clean_text("text").alias("cleaned"))


@query("c2_clean_text_ascii", f"SELECT doc_id, ' ' || array_to_string({S.clean_list('text', True)}, ' ') || ' ' AS cleaned FROM documents")
def c2(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tx.clean_text("text", ascii_only=True).alias("cleaned"))


@query("c2_ascii_word_counts", f"WITH {S.ASCII_TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word")
def c2_counts(spark, sf_dir):
    words = _docs(spark, sf_dir).select(F.explode(tx.clean_tokens("text", ascii_only=True)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("c3_letters_only_tokens", f"SELECT doc_id, array_to_string({S.letters_list('text')}, ' ') AS words FROM documents")
def c3(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.array_join(tx.letters_only_tokens("text"), " ").alias("words"))


def _c4(spark, sf_dir, **kwargs):
    return _docs(spark, sf_dir).select(
        "doc_id", F.array_join(tk.review_to_words("text", **kwargs), " ").alias("words")
    )


@query("c4_words_letters", _words_per_doc(S.letters_list("text")))
def c4_letters(spark, sf_dir):
    return _c4(spark, sf_dir, method="letters")


@query("c4_words_clean", _words_per_doc(S.clean_list("text")))
def c4_clean(spark, sf_dir):
    return _c4(spark, sf_dir, method="clean")


@query("c4_words_stop", _words_per_doc(S.letters_list("text"), stops=True))
def c4_stop(spark, sf_dir):
    return _c4(spark, sf_dir, method="letters", stop=True)


@query("c4_words_stem", _stemmed(S.letters_list("text"), stops=False))
def c4_stem(spark, sf_dir):
    return _c4(spark, sf_dir, method="letters", stem=True)


@query("c4_words_stop_stem", _stemmed(S.clean_list("text"), stops=True))
def c4_stop_stem(spark, sf_dir):
    return _c4(spark, sf_dir, method="clean", stop=True, stem=True)


@query(
    "c5_remove_stop_words",
    f"""WITH {S.ASCII_TOKENS}
SELECT doc_id, word, count(*) AS n FROM tokens
WHERE word NOT IN ({S.quoted(ENGLISH_STOP_WORDS + STOP_PUNCTUATION)}) GROUP BY ALL""",
)
def c5(spark, sf_dir):
    from kinolens.operators.aggregates import term_counts

    counts = term_counts(_docs(spark, sf_dir), "doc_id", tx.clean_tokens("text", ascii_only=True))
    return tk.remove_stop_words(counts, tk.stop_words(punctuation=True))


@query(
    "c6_porter_stem",
    f"""WITH {S.words_of('w', 'documents', 'doc_id', S.letters_list('text'))}, {S.stem_ctes('w')}
SELECT word, stem FROM stems""",
)
def c6(spark, sf_dir):
    words = _docs(spark, sf_dir).select(F.explode(tx.letters_only_tokens("text")).alias("word")).distinct()
    return words.select("word", porter_stem("word").alias("stem"))


@query(
    "c7_split_sentences",
    f"""WITH s AS (SELECT doc_id, {S.SENTENCES} AS l FROM documents)
SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS sentence FROM s""",
)
def c7(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(tx.split_sentences("text")).alias("pos", "sentence"))


@query(
    "c8_sentence_tokens",
    f"""WITH s AS (SELECT doc_id, {S.SENTENCES} AS l FROM documents),
r AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS sentence FROM s)
SELECT doc_id, pos, array_to_string({S.letters_list('sentence')}, ' ') AS words,
       CAST(len({S.letters_list('sentence')}) AS INT) AS n_words FROM r""",
)
def c8(spark, sf_dir):
    rows = tk.sentence_tokens(_docs(spark, sf_dir), "doc_id", "text")
    return rows.select("doc_id", "pos", F.array_join("words", " ").alias("words"), F.size("words").alias("n_words"))


@query("c9_format_bagofwords", _words_per_doc(S.clean_list("text")).replace("AS words", "AS formatted"))
def c9_bow(spark, sf_dir):
    return tk.format_reviews(_docs(spark, sf_dir), "doc_id", "text", "bagofwords")


@query(
    "c9_format_word2vec",
    f"""WITH l AS (SELECT doc_id, {S.clean_list('text')} AS l FROM documents)
SELECT doc_id, CAST(len(l) AS INT) AS n_words, l[1] AS first_word, l[-1] AS last_word FROM l""",
)
def c9_w2v(spark, sf_dir):
    rows = tk.format_reviews(_docs(spark, sf_dir), "doc_id", "text", "word2vec")
    return rows.select(
        "doc_id", F.size("formatted").alias("n_words"), F.get("formatted", F.lit(0)).alias("first_word"),
        F.try_element_at("formatted", F.lit(-1)).alias("last_word"),
    )


@query(
    "c9_format_doc2vec",
    _words_per_doc(S.clean_list("text"), stops=True).replace("SELECT doc_id,", "SELECT CAST(doc_id AS VARCHAR) AS id,"),
)
def c9_d2v(spark, sf_dir):
    rows = tk.format_reviews(_docs(spark, sf_dir), "doc_id", "text", "doc2vec")
    return rows.select("formatted.id", F.array_join("formatted.words", " ").alias("words"))


SPACED = "replace(replace(replace(replace({}, '.', '. '), '?', '? '), '!', '! '), '. . . ', '...')"


@query("c10_space_punctuation", f"SELECT doc_id, {SPACED.format('text')} AS spaced FROM documents")
def c10(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tx.space_punctuation("text").alias("spaced"))


@query("c11_strip_review", f"SELECT doc_id, {SPACED.format('text')} AS stripped FROM documents")
def c11(spark, sf_dir):
    # Reviews arrive between quote marks and with line-break tags around them.
    raw = F.concat(F.lit('<br />"'), F.replace("text", F.lit("<"), F.lit("&lt;")), F.lit('"<br/>'))
    raw = F.replace(raw, F.lit("&&"), F.lit("&amp;&amp;"))
    return _docs(spark, sf_dir).select("doc_id", tk.strip_review(raw).alias("stripped"))


@query(
    "c12_word_count",
    r"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS INT) AS wc FROM documents",
)
def c12(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tx.word_count("text").alias("wc"))


# ---- arguments that are functions ----


@query(
    "n3_own_tokeniser",
    "SELECT doc_id, array_to_string(list_filter(string_split(lower(text), ' '), lambda w: w <> ''), '|') AS words FROM documents",
)
def n3(spark, sf_dir):
    def spaced_words(c):
        return F.array_remove(F.split(F.lower(c), " "), "")

    return _docs(spark, sf_dir).select("doc_id", F.array_join(tk.tokenise("text", spaced_words), "|").alias("words"))


@query(
    "n1_scalar_function",
    "SELECT doc_id AS review_id, CAST(length(text) - length(replace(text, 'e', '')) AS INT) AS n_e FROM documents",
)
def n1(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    return rows.select("review_id", (F.length("review") - F.length(F.replace("review", F.lit("e")))).alias("n_e"))
