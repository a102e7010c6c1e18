"""Vector sums by key against plain loops, with shipped vectors and with joined ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinolens.operators import aggregates as ag
from kinolens.operators import vector_sums as vs

DIM = 5


def some(n=300, seed=2):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    vectors = {w: [float(r.randint(-9, 9)) for _ in range(DIM)] for w in words[:30]}
    rows = [(r.choice(["a", "b", "hot", "hot", None, f"k{i}"]), [r.choice(words) for _ in range(r.randint(0, 9))]) for i in range(n)]
    return rows, vectors


def plain(rows, vectors):
    out = {}
    for k, words in rows:
        vec, known = out.get(k, (np.zeros(DIM), 0))
        have = [vectors[w] for w in words or () if w in vectors]
        out[k] = (vec + np.sum(have, axis=0) if have else vec, known + len(have))
    return {k: (v.tolist(), n) for k, (v, n) in out.items()}


@pytest.mark.parametrize("shipped", [64 << 20, 0])
def test_sums_are_those_of_plain_loops(spark, monkeypatch, shipped):
    """Repeated keys over several partitions, null keys, empty and null lists, unknown words; small batches."""
    monkeypatch.setattr(vs.sum_word_vectors, "__defaults__", (shipped,))
    rows, vectors = some()
    rows += [("empty", []), ("null", None), ("unknown", ["x"])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        docs = spark.createDataFrame(rows, "k string, w array<string>").repartition(4)
        table = spark.createDataFrame(list(vectors.items()), "word string, vec array<double>")
        got = {r.k: (r.vec, r.known) for r in ag.sum_vectors(docs, "k", F.col("w"), table, DIM).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain(rows, vectors)


def test_mean_divides_by_known_words(spark):
    rows, vectors = some(50)
    docs = spark.createDataFrame(rows, "k string, w array<string>")
    table = spark.createDataFrame(list(vectors.items()), "word string, vec array<double>")
    want = {k: [x / max(n, 1) for x in v] for k, (v, n) in plain(rows, vectors).items()}
    got = {r.k: r.vec for r in ag.sum_vectors(docs, "k", F.col("w"), table, DIM, "mean").collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "k string, w array<string>")
    table = spark.createDataFrame([("a", [1.0] * DIM)], "word string, vec array<double>")
    assert ag.sum_vectors(docs, "k", F.col("w"), table, DIM).collect() == []
    assert ag.sum_vectors(spark.createDataFrame([("x", ["a"])], docs.schema), "k", F.col("w"), table.limit(0), DIM).collect()[0].vec == [0.0] * DIM


def test_word_vectors_are_made_once(spark):
    """The table of vectors may cost a pass over all texts: it is not counted and then fetched."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    table = spark.createDataFrame([("a", [1.0] * DIM), (None, [9.0] * DIM)], "word string, vec array<double>").coalesce(1).mapInArrow(seen, "word string, vec array<double>")
    docs = spark.createDataFrame([("k", ["a", "a"])], "k string, w array<string>")
    got = ag.sum_vectors(docs, "k", F.col("w"), table, DIM).collect()
    assert [(r.vec, r.known) for r in got] == [([2.0] * DIM, 2)] and made.value == 2
