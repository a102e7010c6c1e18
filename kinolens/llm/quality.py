"""Quality classifier: ridge regression on random Fourier features, isotonic calibration.

Statistics of each whole text (shares of character classes, repeated words and
word pairs, word shapes) are standardised and mapped to random cosines whose
inner products approximate a Gaussian kernel. Each partition adds up its part
of the normal equations; only those sums leave it. The ridge solution gives raw
scores, and a monotone step function learnt on other labelled rows (pool
adjacent violators over score bins) turns them into probabilities.

Labels are learnt from rows whose ``crc32(id as text) mod 4`` is 0 or 1, the
calibration uses remainder 3, and remainder 2 is held out. Ids, labels, language
and source are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import NOT_SPACE, ROWS_OUT, blocks, byte_set, pair, stored, word_hashes, word_spans

STATISTICS = (
    "bytes", "upper", "digits", "punctuation", "symbols", "high", "newlines", "distinct words", "distinct pairs",
    "words as before", "words ending in a symbol", "one-byte words", "word length", "long words", "capital words", "words",
)
FEATURES = 256
RIDGE = 1e-3
BINS = 2000
THRESHOLD = 0.7

_UPPER = byte_set(lambda b: 0x41 <= b <= 0x5A)
_DIGIT = byte_set(lambda b: 0x30 <= b <= 0x39)
_PUNCTUATION = byte_set(lambda b: 0x21 <= b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7E)
_SYMBOL = byte_set(lambda b: bytes([b]) in b"!#$%&*+/<=>@[]\\^_`{|}~")
_HIGH = byte_set(lambda b: b >= 0x80)
_NEWLINE = byte_set(lambda b: b == 0x0A)


def text_statistics(column) -> np.ndarray:
    """One row of numbers per text of an Arrow column; empty and null texts give zeros."""
    out = np.zeros((len(column), len(STATISTICS)))
    for first, data, offsets in blocks(column):
        n = len(offsets) - 1
        size = np.maximum(np.diff(offsets), 1)

        def share(inside):
            total = np.concatenate([[0], np.cumsum(inside[data])])
            return (total[offsets[1:]] - total[offsets[:-1]]) / size

        doc, starts, ends = word_spans(data, offsets, NOT_SPACE)
        words = np.bincount(doc, minlength=n)
        per_word = np.maximum(words, 1)

        def part(chosen):
            return np.bincount(doc[chosen], minlength=n) / per_word

        def distinct(doc, values):
            keys = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (values >> np.uint64(20)))
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            return np.bincount((keys[new] >> np.uint64(44)).astype(np.int64), minlength=n) / per_word

        hashes = word_hashes(data, starts, ends)
        same = doc[1:] == doc[:-1]
        again = np.zeros(len(doc), bool)
        again[1:] = same & (hashes[1:] == hashes[:-1])
        lengths = ends - starts
        total = np.bincount(doc, weights=lengths, minlength=n) / per_word
        out[first : first + n] = np.column_stack([
            np.log1p(np.diff(offsets)), share(_UPPER), share(_DIGIT), share(_PUNCTUATION), share(_SYMBOL), share(_HIGH), share(_NEWLINE),
            distinct(doc, hashes), distinct(doc[1:][same], pair(hashes[:-1], hashes[1:])[same]), part(again),
            part(_SYMBOL[data[ends - 1]]), part(lengths == 1), np.log1p(total), part(lengths > 12), part(_UPPER[data[starts]]),
            np.log1p(words),
        ])
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    probability: np.ndarray
    #: Whether there were labels to learn from.
    learnt: bool = False

    def features(self, statistics: np.ndarray) -> np.ndarray:
        x = np.clip((statistics - self.mean) / self.scale, -6, 6)
        waves = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / self.directions.shape[1])
        return np.column_stack([waves, np.ones(len(x))])

    def raw_scores(self, statistics: np.ndarray) -> np.ndarray:
        return self.features(statistics) @ self.weights

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        return np.round(np.clip(np.interp(self.raw_scores(statistics), self.raw, self.probability), 0, 1), 9)


def remainder(key: str) -> Column:
    """crc32 of the id's text modulo 4; null for a null id."""
    return F.crc32(F.col(key).cast("string")) % 4


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, stats): one row per document, one map."""

    def run(batches):
        for batch in batches:
            flat = pa.array(text_statistics(batch.column(1)).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(STATISTICS)), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [batch.schema.names[0], "stats"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, f"`{key}` {kind}, stats array<double>")


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), len(STATISTICS))


def fit_quality(statistics: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", seed: int = 7) -> QualityModel:
    """Fit on all labelled rows outside the held-out quarter.

    What reaches the driver is of fixed size: sums of the statistics, a square
    matrix of FEATURES + 1, and BINS pairs of counts. Rows without label do not
    count; a repeated id counts once per pair of rows. Without any usable label
    every score is 0.5.
    """
    marks = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("__key"), F.col(label).cast("double").alias("y"))
    rows = statistics.join(marks, F.col(key) == F.col("__key")).select("stats", "y", remainder(key).alias("fold"))
    rows = stored(rows.where(F.col("fold") != 2), "quality-rows")
    fit, held = rows.where(F.col("fold") < 2), rows.where(F.col("fold") == 3)
    d = len(STATISTICS)
    random = np.random.default_rng(seed)
    model = QualityModel(
        np.zeros(d), np.ones(d), random.normal(size=(d, FEATURES)) / np.sqrt(d), random.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5),
    )
    moments = fit.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.count("x"), F.sum("x"), F.sum(F.col("x") * F.col("x"))).collect()
    if not moments:
        return model
    for i, n, total, squares in moments:
        model.mean[i] = total / n
        spread = squares / n - model.mean[i] ** 2
        model.scale[i] = np.sqrt(spread) if spread > 1e-12 else 1.0

    def sums(batches):
        total = np.zeros((FEATURES + 2, FEATURES + 1))
        for batch in batches:
            x = model.features(_matrix(batch.column("stats")))
            total[:-1] += x.T @ x
            total[-1] += np.asarray(batch.column("y")) @ x
        lists = pa.ListArray.from_arrays(pa.array(np.arange(FEATURES + 3, dtype=np.int32) * (FEATURES + 1)), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 2, dtype=np.int32)), lists], ["i", "line"])

    def added(group):
        lines = group.column("line").combine_chunks()
        total = np.asarray(lines.flatten()).reshape(len(lines), FEATURES + 1).sum(0)
        return pa.table({"i": group.column("i")[:1], "line": pa.array([total.tolist()], pa.list_(pa.float64()))})

    lines = fit.mapInArrow(sums, "i int, line array<double>").groupBy("i").applyInArrow(added, "i int, line array<double>").collect()
    normal = np.array([r.line for r in sorted(lines, key=lambda r: r.i)])
    size = max(1.0, normal[-2, -1])
    model.learnt = True
    model.weights = np.linalg.solve(normal[:-1] / size + RIDGE * np.eye(FEATURES + 1), normal[-1] / size)

    def binned(batches):
        for batch in batches:
            raw = np.clip(model.raw_scores(_matrix(batch.column("stats"))), -0.5, 1.5)
            yield pa.RecordBatch.from_arrays([pa.array(np.round((raw + 0.5) / 2 * BINS).astype(np.int32)), batch.column("y")], ["bin", "y"])

    counts = held.mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.count("y").alias("n"), F.sum("y").alias("s")).collect()
    if counts:
        model.raw, model.probability = isotonic(sorted((r.bin / BINS * 2 - 0.5, r.n, r.s) for r in counts))
    else:
        model.raw, model.probability = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def isotonic(points: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (x, count, sum); the weighted centre and mean of each pool."""
    pools: list[list[float]] = []
    for x, n, s in points:
        pools.append([x * n, n, s])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, held_out, score, predicted) of every row of ``docs``.

    ``held_out`` rows took no part in learning; a null id is not held out. Empty
    and null texts are scored like any other, from statistics that are zero.
    Repeated rows are scored alike, other columns are not read.
    """
    statistics = stored(document_statistics(docs, key, text), "quality-stats")
    model = fit_quality(statistics, labels, key, label)

    def run(batches):
        for batch in batches:
            score = model.scores(_matrix(batch.column("stats")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], [batch.schema.names[0], "score", "predicted"]
            )

    kind = docs.schema[key].dataType.simpleString()
    scored = statistics.mapInArrow(run, f"`{key}` {kind}, score double, predicted int")
    return scored.select(key, F.coalesce(remainder(key) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is THRESHOLD or more.

    Without any usable label nothing is known of quality, and all rows stay.
    """
    model = fit_quality(document_statistics(docs, key, text), labels, key, label)
    if not model.learnt:
        return docs

    def run(batches):
        for batch in batches:
            keep = pa.array(model.scores(text_statistics(batch.column(batch.schema.names.index(text)))) >= THRESHOLD)
            for at in range(0, batch.num_rows, ROWS_OUT):
                yield batch.slice(at, ROWS_OUT).filter(keep.slice(at, ROWS_OUT))

    return docs.mapInArrow(run, docs.schema)
