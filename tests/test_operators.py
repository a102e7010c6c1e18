"""Operators against brute force on small frames, also with hot keys."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinolens.functions.text import clean_tokens, letters_only_tokens
from kinolens.session import materialise
from kinolens.operators import aggregates as ag
from kinolens.operators import extract as ex
from kinolens.operators import joins as jn
from kinolens.operators import lexicon as lx
from kinolens.operators import ranking as rk
from kinolens.operators import sampling as sp
from kinolens.operators import sets as st
from kinolens.operators import tables as tb
from kinolens.operators import vectors as vc

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def counts(spark):
    """(label, word, n) where one label holds far more words than the rest."""
    rng = random.Random(7)
    rows = [("hot", f"w{i}", rng.randint(1, 50)) for i in range(4000)]
    rows += [(x, f"w{i}", rng.randint(1, 50)) for x in ("a", "b") for i in range(300)]
    return spark.createDataFrame(rows, "label string, word string, n long")


@pytest.mark.parametrize("k", [5, 1500])
def test_top_words_with_a_hot_label(counts, k):
    by_label = defaultdict(list)
    for r in counts.collect():
        by_label[r.label].append((-r.n, r.word))
    expected = {(x, w, i + 1) for x, ws in by_label.items() for i, (_, w) in enumerate(sorted(ws)[:k])}
    got = {(r.label, r.word, r["rank"]) for r in rk.top_words(counts, k).collect()}
    assert got == expected


def test_common_is_within_feature_words(counts):
    common = {r.word for r in st.common_words(counts, ["hot", "a", "b"], 200).collect()}
    union = {r.word for r in st.feature_words(counts, 200).collect()}
    assert common <= union and len(union) > 200


def test_label_overlap_by_brute_force(counts):
    top = defaultdict(set)
    for r in rk.top_words(counts, 100).collect():
        top[r.label].add(r.word)
    for r in st.label_overlap(counts, ["hot", "a", "b"], 100).collect():
        a, b = top[r.label_a], top[r.label_b]
        assert (r.shared, round(r.jaccard, 9)) == (len(a & b), round(len(a & b) / len(a | b), 9))


def test_longest_review_ties_and_empty(spark):
    rows = [("f", 0, "a b c"), ("f", 1, "d e f"), ("f", 2, ""), ("g", 0, "  "), ("h", 3, "x")]
    df = spark.createDataFrame(rows, "title_url string, pos int, review string")
    got = {(r.title_url, r.pos, r.wc) for r in rk.longest_review(df).collect()}
    assert got == {("f", 0, 3), ("h", 3, 1)}


def test_numbers_follow_the_shuffled_order(spark):
    df = spark.range(700).withColumnRenamed("id", "k").repartition(5)
    order = [r.k for r in rk.shuffle_rows(df, "k", 42).collect()]
    numbered = {r.k: r.row_no for r in rk.number_rows(df, "k", 42).collect()}
    assert [numbered[k] for k in order] == list(range(700))
    sizes = Counter(r.batch for r in rk.assign_batches(df, "k", 100, 42).collect())
    assert sizes == {i: 100 for i in range(7)}


def test_split_is_a_partition_of_any_partitioning(spark):
    df = spark.range(1000)
    train, test = sp.split(df, "id")
    assert test.count() == 277 and train.count() == 723
    again = {r.id for r in sp.split(df.repartition(13), "id")[1].collect()}
    assert again == {r.id for r in test.collect()}


def test_min_words_is_strict(spark):
    df = spark.createDataFrame([(n, " ".join(["w"] * n)) for n in (499, 500, 501)], "id int, t string")
    assert [r.id for r in tb.min_words(df, "t", 500).collect()] == [501]


def test_insert_update_and_rejects(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "k string, v int")
    assert {tuple(r) for r in tb.insert_if_absent(old, new, "k", "v").collect()} == {("a", 1), ("b", 2)}
    assert {tuple(r) for r in tb.rejected_duplicates(old, new, "k").collect()} == {("a", 1), ("b", 1)}
    updates = spark.createDataFrame([("a", None, 5)], "k string, v int, z int")
    got = tb.update_by_key(old, updates, "k", ["v", "z"]).collect()
    assert [tuple(r) for r in got] == [("a", 1, 5)]


def test_left_join_keeps_unmatched(spark):
    reviews = spark.createDataFrame([("u", "x"), ("v", "y")], "title_url string, review string")
    movies = spark.createDataFrame([("u", "war")], "title_url string, genre string")
    got = {(r.title_url, r.genre) for r in jn.join_reviews_movies(reviews, movies).collect()}
    assert got == {("u", "war"), ("v", None)}


def test_label_counts_are_counts_times_labels(spark):
    reviews = spark.createDataFrame([("u", ["a", "a", "b"]), ("u", ["a"]), ("v", ["b"])], "title_url string, w array<string>")
    movies = spark.createDataFrame([("u", ["x", "y"]), ("v", ["y"])], "title_url string, labels array<string>")
    got = {(r.label, r.word): r.n for r in ag.label_word_counts(reviews, "w", movies).collect()}
    assert got == {("x", "a"): 3, ("x", "b"): 1, ("y", "a"): 3, ("y", "b"): 2}


def test_term_counts_without_shuffle(docs):
    plan = ag.term_counts(docs, "doc_id", clean_tokens("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan


def test_tf_vector_and_vectors_without_shuffle(docs):
    words = docs.withColumn("w", letters_only_tokens("text"))
    for df in (ag.tf_array(words, "w", ["of", "the"]), vc.doc_vectors(docs, "doc_id", letters_only_tokens("text"), 8)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_rank_limit_runs_before_the_shuffle(counts):
    plan = rk.top_words(counts, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_document_vectors_by_brute_force(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "c"]), (2, [])], "k int, w array<string>")
    table = vc.SignTable(40)
    want = 2 * table.row("a").astype(int) + table.row("b") + table.row("c")
    got = {r.k: r.vec for r in vc.doc_vectors(df, "k", "w", 40).collect()}
    assert got[1] == want.tolist() and got[2] == [0.0] * 40
    mean = {r.k: r.vec for r in vc.doc_vectors(df, "k", "w", 40, "mean").collect()}
    assert mean[1] == (want / 4).tolist() and mean[2] == [0.0] * 40
    concat = {r.k: r.vec for r in vc.doc_vectors(df, "k", "w", 40, "concat").collect()}
    half = vc.SignTable(20)
    assert concat[1] == (half.row("a") + half.row("b")).tolist() + (half.row("a") + half.row("c")).tolist()
    signs = spark.createDataFrame([("a",)], "w string").select(vc.word_signs("w", 40).alias("s")).collect()[0].s
    assert signs == table.row("a").tolist()


def test_sign_table_forgets_but_stays_right():
    small, large = vc.SignTable(8, max_words=2), vc.SignTable(8)
    words = ["a", "b", "c", "a"]
    assert [small.row(w).tolist() for w in words] == [large.row(w).tolist() for w in words]
    assert len(small.memo) <= 2


def test_sign_table_adds_exactly_and_small():
    table = vc.SignTable(300, max_words=5000)
    words = [f"w{i}" for i in range(9000)]
    counts = [1 + i % 3 for i in range(9000)]
    counts[0] = (1 << 40) + 1
    want = sum(n * table.row(w).astype(np.int64) for w, n in zip(words, counts, strict=True))
    assert table.totals([words, []], [counts, []]).tolist() == [want.tolist(), [0.0] * 300]
    # One table of bytes, not an array object per word.
    assert table.table.nbytes <= 2 * 5000 * 300 and len(table.memo) <= 5000


def test_sum_vectors_keeps_unknown_documents(spark):
    df = spark.createDataFrame([(1, ["a", "a", "z"]), (2, ["z"]), (3, [])], "k int, w array<string>")
    table = spark.createDataFrame([("a", [1.0, 2.0])], "word string, vec array<double>")
    got = {r.k: (r.vec, r.known) for r in ag.sum_vectors(df, "k", "w", table, 2).collect()}
    assert got == {1: ([2.0, 4.0], 2), 2: ([0.0, 0.0], 0), 3: ([0.0, 0.0], 0)}


def test_word2vec_documents_are_sums_of_unit_vectors(spark, docs):
    words = docs.select("doc_id", letters_only_tokens("text").alias("w"))
    table = materialise(vc.word_vectors(vc.train_word2vec(words, "w", dim=4, min_count=5)), "vectors")
    unit = {r.word: r.vec for r in table.collect()}
    assert all(sum(x * x for x in v) == pytest.approx(1) for v in unit.values())
    texts = {r.doc_id: r.w for r in words.collect()}
    for r in vc.doc_vectors_w2v(words, "doc_id", "w", table, 4).collect():
        known = [unit[w] for w in texts[r.doc_id] if w in unit]
        assert r.known == len(known)
        assert r.vec == pytest.approx([sum(v[i] for v in known) for i in range(4)], abs=1e-6)


def test_vocabulary_too_large_for_the_trainer(spark, docs, monkeypatch):
    monkeypatch.setattr(vc, "MAX_WORD_CELLS", 10)
    with pytest.raises(ValueError, match="min_count"):
        vc.train_word2vec(docs.select(letters_only_tokens("text").alias("w")), "w", dim=4, min_count=1)


def test_extract_reviews_pairs_headers_with_bodies(spark):
    html = """<div id="tn15content"><div><h2>One</h2><a href="/u/1/">x</a><img alt="8/10"></div><p>First
    body</p><div>\n\nWas the above review useful to you?\r\n</div><div><h2>Two</h2><a href="/u/2/">y</a></div>
    <p><b>*** This review may contain spoilers ***</b></p><p>Second &amp; last</p><p>Add another review</p></div>"""
    df = spark.createDataFrame([("t", html)], "title_url string, html string")
    got = [(r.headline, r.author, r.rating, r.review) for r in ex.extract_reviews(df).orderBy("pos").collect()]
    assert got == [("One", "/u/1/", 8, "First     body"), ("Two", "/u/2/", None, "Second & last")]


def test_bad_pages_give_no_rows_or_nulls(spark):
    df = spark.createDataFrame([("t", "<html>404"), ("n", None)], "title_url string, html string")
    assert ex.extract_titles(df).count() == 0
    assert ex.extract_reviews(df).count() == 0
    assert {r.genre for r in ex.extract_genres(df).collect()} == {None}


def test_lexicon_scores(spark):
    train = spark.createDataFrame([(1, ["good", "good"]), (0, ["bad", "good"])], "sentiment int, w array<string>")
    lexicon = {r.word: r.polarity for r in lx.learn_polarity(train, "w").collect()}
    assert lexicon == {"good": 0.25, "bad": -0.5}
    table = spark.createDataFrame(list(lexicon.items()), "word string, polarity double")
    texts = spark.createDataFrame([(1, ["good", "bad", "new", "new"]), (2, [])], "k int, w array<string>")
    got = {r.k: (r.polarity, r.subjectivity) for r in lx.lexicon_sentiment(texts, "k", "w", table).collect()}
    assert got == {1: (-0.125, 0.5), 2: (0.0, 0.0)}


def test_score_sentiment_with_a_scorer(spark):
    df = spark.createDataFrame([(1, "Good one. Bad!")], "k int, t string")
    scored = lx.score_sentiment(df, "k", "t", scorer=lambda ts: [float(len(t)) for t in ts], by="sentence", batch=1)
    assert {(r.pos, r.len, r.score) for r in scored.collect()} == {(0, 9, 9.0), (1, 4, 4.0)}


def test_tf_idf_threshold(spark):
    docs = spark.createDataFrame([(1, ["a", "a", "a", "b"]), (2, ["b", "b"])], "k int, w array<string>")
    got = {(r.k, r.word): round(r.weight, 6) for r in ag.tf_idf(docs, "k", "w", threshold=1, relative=True).collect()}
    assert got == {(1, "a"): 0.693147, (2, "b"): 0.693147}
    raw = {(r.k, r.word): round(r.weight, 6) for r in ag.tf_idf(docs, "k", "w").collect()}
    assert raw == {(1, "a"): 2.079442, (1, "b"): 0.0, (2, "b"): 0.0}


def test_crawl_frontier_skips_done_keys(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "t string")
    url = F.concat(F.col("t"), F.lit("?"), F.col("offset"))
    got = {r.url for r in jn.crawl_frontier(keys, "t", [0, 10], url, keys.where("t = 'a'")).collect()}
    assert got == {"b?0", "b?10"}


def test_sentence_means(spark):
    rows = [(1, 0.25, 1), (1, 0.75, 3), (2, None, 4)]
    df = spark.createDataFrame(rows, "k int, score double, len long")
    assert {(r.k, r.score) for r in ag.mean_sentence_score(df, "k").collect()} == {(1, 0.5), (2, None)}
    assert {(r.k, r.score) for r in ag.weighted_sentence_score(df, "k").collect()} == {(1, 0.625), (2, None)}


def test_longest_review_gives_one_row_per_film(spark):
    """Repeated positions, null positions, repeated rows, ties, null films."""
    rows = [("f", 1, "a b c d"), ("f", 1, "x"), ("g", 2, "p q"), ("g", 2, "r s"), ("g", 3, "t u"), ("h", None, "one two"), ("h", None, "one"), ("i", None, "a b"), ("i", 7, "c d"),
            ("j", 1, "same"), ("j", 1, "same"), ("k", 1, ""), (None, 1, "a b c"), ("l", None, None)]
    df = spark.createDataFrame(rows, "title_url string, pos long, review string").repartition(3)
    got = {r.title_url: (r.pos, r.review, r.wc) for r in rk.longest_review(df).collect()}
    assert rk.longest_review(df).count() == len(got) == 5
    assert {k: got[k] for k in "fhij"} == {"f": (1, "a b c d", 4), "h": (None, "one two", 2), "i": (7, "c d", 2), "j": (1, "same", 1)}
    assert got["g"] in ((2, "p q", 2), (2, "r s", 2))
    assert {r.title_url: r.review for r in rk.longest_review(df.repartition(5)).collect()} == {k: v[1] for k, v in got.items()}


def test_hot_film_is_split_in_the_text_join(spark):
    """A third of all reviews on one film, some without a film: no task holds more than twice the median."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("-1", "false", "8"), strict=True):
        spark.conf.set(k, v)
    try:
        film = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("f"), (F.col("id") % 500).cast("string")))
        reviews = spark.range(60000).select("id", film.alias("title_url"), F.lit("text").alias("review"))
        movies = reviews.where("title_url is not null and title_url <> 'f7'").select("title_url", F.upper("title_url").alias("title")).distinct()
        joined = jn.join_reviews_movies(reviews, movies, slice_rows=200)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
        plain = reviews.join(movies, "title_url", "left")
        assert joined.count() == 60000 and joined.exceptAll(plain.select(*joined.columns)).isEmpty()
        assert joined.columns == ["title_url", "id", "review", "title"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lexicon_meets_the_words_of_blocks(spark, monkeypatch):
    """Blocks of any size give the scores of plain loops; a frequent word meets the lexicon once per block, not once per text."""
    texts = ["a b a x", "", None, "x x", "b " * 40, "a", "a a b c"] * 20
    rows = [(i, None if t is None else t.split()) for i, t in enumerate(texts)] + [(None, ["a", None])]
    df = spark.createDataFrame(rows, "id long, words array<string>").repartition(3)
    lexicon = spark.createDataFrame([("a", 0.5), ("b", -1.0), ("never", 1.0)], "word string, polarity double")
    value = {"a": 0.5, "b": -1.0}

    def plain(words):
        known = [value[w] for w in words or [] if w in value]
        return (round(sum(known) / len(known), 9), round(len(known) / len(words), 9)) if known else (0.0, 0.0)

    want = {(i, *plain(w)) for i, w in rows}
    for size in (1, 7, 1 << 19):
        monkeypatch.setattr(lx, "BLOCK_WORDS", size)
        got = [(r.id, round(r.polarity, 9), round(r.subjectivity, 9)) for r in lx.lexicon_sentiment(df, "id", "words", lexicon).collect()]
        assert set(got) == want and len(got) == len(want)
    sized = lx._in_blocks(df, "words")
    assert sized.select("__block").distinct().count() <= 3 and sized.count() == len(rows)
