"""Word and document vectors, similarity and neighbours."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinolens.functions.arrays import cosine_similarity
from kinolens.functions.text import count_words

HEX = "0123456789abcdef"
PARITY = "0101010101010101"

#: Documents whose words are Python objects at a time.
DOC_ROWS = 500

Scorer = Callable[[Sequence[str]], np.ndarray]


# ---- hashed document vectors ----


def word_signs(word, dim: int) -> Column:
    """``dim`` values of +1 or -1 for a word, from the digits of its md5."""
    w = F.col(word) if isinstance(word, str) else word
    digests = [F.md5(F.concat(w, F.lit(f"#{block}"))) for block in range((dim + 31) // 32)]
    bits = F.left(F.translate(F.concat(*digests), HEX, PARITY), F.lit(dim))
    return F.transform(F.split(bits, ""), lambda b: F.when(b == "1", -1).otherwise(1))


class SignTable:
    """Signs of words as rows of one numpy table, computed once per word and task.

    The table is emptied when it is full, so a task with a very large
    vocabulary keeps its memory; the signs themselves are always recomputable.
    """

    def __init__(self, dim: int, max_words: int = 50_000):
        self.dim, self.max_words, self.memo = dim, max_words, {}
        self.blocks = [f"#{b}".encode() for b in range((dim + 31) // 32)]
        self.table = np.zeros((0, dim), np.int8)

    def _learn(self, words: list[str]) -> None:
        raw = b"".join(hashlib.md5(stem + b).digest() for stem in (w.encode() for w in words) for b in self.blocks)
        digits = np.frombuffer(raw, np.uint8).reshape(len(words), -1)
        digits = np.stack([digits >> 4, digits], axis=2).reshape(len(words), -1)[:, : self.dim]
        first = len(self.memo)
        while first + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(1024, len(self.table)), self.dim), np.int8)])
        self.table[first : first + len(words)] = 1 - 2 * (digits & 1).astype(np.int8)
        self.memo.update(zip(words, range(first, first + len(words)), strict=True))

    def places(self, words: list[str]) -> np.ndarray:
        """The rows of ``table`` that hold the signs of different words, good until the next call; at most ``max_words`` words."""
        found = list(map(self.memo.get, words))
        missing = [w for w, p in zip(words, found, strict=True) if p is None]
        if missing:
            if len(self.memo) + len(missing) > self.max_words:
                self.memo.clear()
                missing = words
            self._learn(missing)
            found = list(map(self.memo.__getitem__, words))
        return np.array(found, np.int64)

    def row(self, word: str) -> np.ndarray:
        place = self.places([word])[0]
        return self.table[place]

    def total(self, words, counts) -> np.ndarray:
        """Sum of the signs of ``words``, each taken ``count`` times."""
        return self.totals([words], [counts])[0]

    def totals(self, words, counts) -> np.ndarray:
        """The same for several documents: [document, dim]; whole numbers as doubles."""
        out = np.zeros((len(words), self.dim))
        for k, (w, n) in enumerate(zip(words, counts, strict=True)):
            for at in range(0, len(w), 4096):
                some = np.asarray(n[at : at + 4096], np.int64)
                # Floats multiply by BLAS; they hold whole numbers up to 2^24 exactly, doubles up to 2^53.
                kind = np.float32 if some.sum() < 1 << 24 else np.float64
                places = self.places(list(w[at : at + 4096]))
                out[k] += some.astype(kind) @ self.table[places].astype(kind)
        return out


def doc_vectors(df: DataFrame, key: str, tokens, dim: int = 300, combine: str = "sum", segments: int = 2) -> DataFrame:
    """(key, vec): signed random projection of the word counts of a document.

    ``sum`` adds the signs of all words, ``mean`` divides by their number, and
    ``concat`` cuts the document into ``segments`` equal stretches that fill
    ``dim / segments`` dimensions each.

    A map: words are counted in the row, and only the sums over ``dim`` columns
    are done by numpy on Arrow batches, many times faster than as aggregates.
    """
    words = F.col(tokens) if isinstance(tokens, str) else tokens
    if combine not in ("sum", "mean", "concat"):
        raise ValueError("combine must be 'sum', 'mean' or 'concat'")
    n_parts = segments if combine == "concat" else 1
    if dim % n_parts:
        raise ValueError("dim must be a multiple of segments")
    held = df.select(F.col(key), words.alias("__words"))
    size = F.size("__words")
    columns = []
    for s in range(n_parts):
        start = F.floor(size * s / n_parts).cast("int")
        stop = F.floor(size * (s + 1) / n_parts).cast("int")
        part = F.col("__words") if n_parts == 1 else F.slice("__words", start + 1, stop - start)
        held = held.withColumn(f"__c{s}", count_words(part))
        columns += [F.col(f"__c{s}.word").alias(f"w{s}"), F.col(f"__c{s}.n").alias(f"n{s}")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = SignTable(dim // n_parts)
        for part in _row_runs(batches, DOC_ROWS):
            words, counts = ([part.column(f"{c}{s}").to_pylist() for s in range(n_parts)] for c in "wn")
            vectors = np.hstack([table.totals(w, n) for w, n in zip(words, counts, strict=True)])
            if combine == "mean":
                vectors /= np.maximum([sum(n) for n in counts[0]], 1)[:, None]
            yield _vector_batch(part.column(key), key, vectors)

    schema = T.StructType([df.schema[key], T.StructField("vec", T.ArrayType(T.DoubleType()))])
    return held.select(key, *columns).mapInArrow(run, schema)


def _row_runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows; none of the given ones is copied."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _vector_batch(keys: pa.Array, key: str, vectors: np.ndarray) -> pa.RecordBatch:
    rows, dim = vectors.shape
    cells = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * dim), pa.array(vectors.ravel()))
    return pa.RecordBatch.from_arrays([keys, cells], [key, "vec"])


# ---- pluggable batch scorers ----


def hash_scorer(dim: int = 300) -> Scorer:
    """Offline stand-in for a feature service: the hashed vector of a text."""

    table: list[SignTable] = []

    def score(texts: Sequence[str]) -> np.ndarray:
        if not table:
            table.append(SignTable(dim))
        out = np.zeros((len(texts), dim))
        for row, text in enumerate(texts):
            counts = Counter(re.findall("[a-z]+", (text or "").lower()))
            out[row] = table[0].total(list(counts), list(counts.values()))
        return out

    return score


def score_batches(df: DataFrame, key: str, text: str, scorer: Scorer, batch: int = 100) -> DataFrame:
    """(key, vec): ``scorer`` gets lists of at most ``batch`` texts.

    Each task streams its own partition through Arrow, so batches never wait
    for a global order and never gather on the driver.
    """
    key_field = df.schema[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _row_runs(batches, batch):
            vectors = np.asarray(scorer(part.column(text).to_pylist()), dtype=float)
            yield _vector_batch(part.column(key), key, vectors)

    schema = T.StructType([T.StructField(key, key_field.dataType), T.StructField("vec", T.ArrayType(T.DoubleType()))])
    return df.select(key, text).mapInArrow(run, schema)


# ---- trained word vectors ----


#: Most numbers (words x dimensions) that the trainer keeps on the driver and in every task.
MAX_WORD_CELLS = 200_000_000


def train_word2vec(
    sentences: DataFrame, words: str, dim: int = 300, min_count: int = 40, window: int = 10, seed: int = 42,
    partitions: int | None = None, iterations: int = 1,
) -> Word2VecModel:
    """Word vectors from one row per sentence.

    Training runs in as many ``partitions`` as the cluster has cores unless a
    number is given; more ``iterations`` make up for more partitions. Spark's
    trainer keeps the whole vocabulary on the driver, so its size is counted
    first and a vocabulary that is too large is refused; raise ``min_count``.
    """
    counts = sentences.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    size = counts.where(F.col("n") >= min_count).count()
    if size * dim > MAX_WORD_CELLS:
        raise ValueError(f"{size} words of {dim} dimensions are more than {MAX_WORD_CELLS} numbers; raise min_count")
    trainer = Word2Vec(
        vectorSize=dim, minCount=min_count, windowSize=window, seed=seed,
        numPartitions=partitions or sentences.sparkSession.sparkContext.defaultParallelism,
        maxIter=iterations, inputCol=words, outputCol="vector",
    )
    return trainer.fit(sentences)


def word_vectors(model: Word2VecModel | DataFrame, unit: bool = True) -> DataFrame:
    """(word, vec) of a trained model or of a table of vectors, scaled to length one by default."""
    from kinolens.functions.arrays import l2_normalise

    if isinstance(model, DataFrame):
        table = model.select("word", "vec")
    else:
        table = model.getVectors().select("word", vector_to_array("vector").alias("vec"))
    return table.withColumn("vec", l2_normalise("vec")) if unit else table


def doc_vectors_w2v(df: DataFrame, key: str, words: str, vectors: DataFrame, dim: int = 300, combine: str = "sum") -> DataFrame:
    """(key, vec, known): sum or mean of the unit vectors of a document's known words.

    ``vectors`` is a stored :func:`word_vectors` table, so a model is trained
    once and joined by word like any other table.
    """
    from kinolens.operators.aggregates import sum_vectors

    return sum_vectors(df, key, F.col(words), vectors, dim, combine)


# ---- similarity ----


def similarity_to(df: DataFrame, key: str, vec: str, query_key, out: str = "similarity") -> DataFrame:
    """Cosine of every row with the row under ``query_key``.

    The one query vector is a scalar subquery: one value in every task.
    """
    query = df.where(F.col(key) == query_key).select(vec).limit(1).scalar()
    with_query = df.select(key, vec, query.alias("__q"))
    return with_query.select(key, cosine_similarity(vec, "__q").alias(out))


def nearest_documents(df: DataFrame, key: str, vec: str, query_key, k: int) -> DataFrame:
    """The ``k`` rows most like the one under ``query_key``; ties by key.

    Every row is compared, so the answer is exact; the top-k is cut per
    partition before anything is exchanged.
    """
    scored = similarity_to(df, key, vec, query_key).where(F.col(key) != query_key)
    return scored.orderBy(F.desc("similarity"), key).limit(k)


def matrix_rows(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(key, dim, value): one row per cell."""
    return df.select(key, F.posexplode(vec).alias("dim", "value"))
