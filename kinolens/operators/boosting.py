"""Boosted trees for many 0/1 targets at once.

Spark's booster fits one target, and every level of every tree of every label is
a pass of its own. Here all targets share one table of binned features, and one
pass per level counts the histograms of all of them: of each target, open node,
feature and bin the rows, gradients and curvatures. Spark adds them up and picks
each node's best split; the driver gets one split per open node. Scores are kept
in the table, which is written to the shared folder every few trees, so lineage
stays short and a lost executor costs few trees.

A target may be null in a row: the row then doesn't train it. That is how the
folds of a search are targets too, and its points come from the prefixes of one
long ensemble.

Gradients are whole numbers (2^-24 units), so sums don't depend on the order of
the rows and the same data gives the same trees on any cluster. A table whose
bins are proven to fit ``BLOCK_BYTES`` is shipped to the tasks once and every
task grows the trees of some targets from it, by the same functions and with the
same result; beyond that size the passes run over the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinolens.session import materialise

BINS = 32
UNIT = 1 << 24
#: Curvature added to every leaf, and the least that a split must gain.
RIDGE, LEAST_GAIN = 1.0, 1e-6
#: Largest table of bins that is shipped to the tasks.
BLOCK_BYTES = 64 << 20
#: Trees between two writes of the scores.
STORE_EVERY = 25
TREES = "target int, tree int, node int, feature int, bin int, value double"


@dataclass
class Boosted:
    """A fitted set of ensembles: trees as rows, and the bin edges of the features.

    A row with ``feature`` -1 is a leaf with its ``value``; others send a row
    whose bin is at most ``bin`` to node 2 n + 1, the rest to 2 n + 2. Tree -1
    is the score that every row starts from.
    """

    trees: DataFrame
    edges: np.ndarray
    names: list[str]
    step: float

    def save(self, path: str) -> str:
        """Trees, edges and names as tables under ``path``."""
        spark = self.trees.sparkSession
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        rows = [(i, [float(x) for x in e]) for i, e in enumerate(self.edges)]
        spark.createDataFrame(rows, "feature int, edges array<double>").write.mode("overwrite").parquet(f"{path}/edges")
        spark.createDataFrame([(self.names, self.step)], "names array<string>, step double").write.mode("overwrite").parquet(f"{path}/names")
        return path

    @classmethod
    def load(cls, spark, path: str) -> Boosted:
        edges = np.array([r.edges for r in spark.read.parquet(f"{path}/edges").orderBy("feature").collect()])
        head = spark.read.parquet(f"{path}/names").first()
        return cls(spark.read.schema(TREES).parquet(f"{path}/trees"), edges, list(head.names), head.step)


# ---- bins ----


def as_array(df: DataFrame, features: str) -> DataFrame:
    """The feature column as an array of doubles, whatever it was."""
    column = vector_to_array(features) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features).cast("array<double>")
    return df.withColumn(features, column)


def bin_edges(df: DataFrame, features: str, bins: int = BINS) -> np.ndarray:
    """``bins - 1`` ascending edges per feature: quantiles of its values other than zero, and zero.

    Zeros are left out of the sketch, so counts over a large vocabulary cost
    what their documents hold. Nulls and values that are not numbers count as zero.
    """
    cells = as_array(df.select(features), features)
    size = cells.agg(F.max(F.size(features))).first()[0] or 0
    some = cells.select(F.posexplode(features).alias("feature", "x")).where("x <> 0 and not isnan(x)")
    asked = [i / (bins - 1) for i in range(1, bins - 1)]
    found = some.groupBy("feature").agg(F.percentile_approx("x", asked, 10_000).alias("q")).collect()
    edges = np.full((size, bins - 1), np.inf)
    for r in found:
        cuts = np.unique([0.0, *r.q])
        edges[r.feature, : len(cuts)] = cuts
    edges[np.isinf(edges[:, 0]), 0] = 0.0
    return edges


def binned(matrix: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The bin of every cell: how many of its feature's edges are below its value."""
    clean = np.nan_to_num(matrix, nan=0.0, posinf=np.inf, neginf=-np.inf)
    out = np.zeros(clean.shape, np.uint8)
    for f in range(clean.shape[1]):
        out[:, f] = np.searchsorted(edges[f], clean[:, f], "left")
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A batch's arrays as rows of equal width; null rows are zeros."""
    rows = [np.zeros(width) if v is None else np.array([0.0 if x is None else x for x in v], float) for v in column.to_pylist()] if column.null_count else None
    if rows is not None:
        return np.array(rows).reshape(len(column), width)
    return np.nan_to_num(column.flatten().to_numpy(zero_copy_only=False).astype(float), nan=0.0).reshape(len(column), width)


def training_table(df: DataFrame, features: str, target: str, edges: np.ndarray) -> DataFrame:
    """(bins, y): bins as bytes, and per target a byte 0, 1 or 2 for a row that doesn't train it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binned(_matrix(batch.column("x"), len(edges)), edges)
            y = [bytes(2 if v is None else int(v != 0) for v in row) for row in batch.column("y").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), pa.array(y, pa.binary())], ["bins", "y"])

    rows = as_array(df.where(F.col(target).isNotNull()).select(F.col(features).alias("x"), F.col(target).cast("array<double>").alias("y")), "x")
    return rows.mapInArrow(run, "bins binary, y binary")


# ---- one level of trees, on any rows ----


def gradients(y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the logistic loss as whole numbers."""
    p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return np.rint((y - p) * UNIT).astype(np.int64), np.rint(np.maximum(p * (1 - p), 1e-6) * UNIT).astype(np.int64)


def histograms(bins: np.ndarray, place: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, n_bins: int = BINS) -> np.ndarray:
    """[node, feature, bin, (rows, g, h)] of rows at ``place`` 0 .. nodes - 1; exact."""
    rows, width = bins.shape
    cells = nodes * width * n_bins
    out = np.zeros((cells, 3), np.int64)
    size = max(1, (1 << 22) // max(1, width))
    base = np.arange(width) * n_bins
    for at in range(0, rows, size):
        key = (place[at : at + size, None] * (width * n_bins) + base + bins[at : at + size]).ravel()
        out[:, 0] += np.bincount(key, minlength=cells)
        for k, value in ((1, g), (2, h)):
            # Whole numbers below 2^53 are exact in doubles: 2^24 units times at most 2^22 rows.
            out[:, k] += np.bincount(key, np.repeat(value[at : at + size], width), cells).astype(np.int64)
    return out.reshape(nodes, width, n_bins, 3)


def best_splits(hist: np.ndarray) -> list[tuple[int, int, float, float]]:
    """Per node (feature, bin, gain, leaf value of the node); feature -1 where no split gains."""
    out = []
    for node in hist:
        n, g, h = node[0].sum(axis=0).tolist()
        left = np.cumsum(node, axis=1)[:, :-1]
        gain = split_gain(left[..., 1] / UNIT, left[..., 2] / UNIT, g / UNIT, h / UNIT)
        gain[(left[..., 0] == 0) | (left[..., 0] == n)] = -np.inf
        at = int(np.argmax(gain)) if gain.size else 0
        best = float(gain.ravel()[at]) if gain.size else -math.inf
        feature, cut = divmod(at, left.shape[1]) if best > LEAST_GAIN else (-1, -1)
        out.append((feature, cut, best, (g / UNIT) / (h / UNIT + RIDGE)))
    return out


def split_gain(gl, hl, g, h):
    """What a split takes off the loss, by its left sums and the node's sums."""
    return gl * gl / (hl + RIDGE) + (g - gl) * (g - gl) / (h - hl + RIDGE) - g * g / (h + RIDGE)


def descend(bins: np.ndarray, tree: dict[int, tuple[int, int, float]]) -> np.ndarray:
    """The node of ``tree`` that each row ends in: a leaf, or one that is not split yet."""
    node = np.zeros(len(bins), np.int64)
    if not tree:
        return node
    top = max(tree) + 1
    feature, cut = np.full(top, -1), np.zeros(top, np.int64)
    for n, (f, b, _) in tree.items():
        feature[n], cut[n] = f, b
    rows = np.arange(len(bins))
    while True:
        here = np.where(node < top, feature[np.minimum(node, top - 1)], -1)
        moving = here >= 0
        if not moving.any():
            return node
        go = rows[moving]
        node[go] = 2 * node[go] + 1 + (bins[go, here[moving]] > cut[node[go]])


def leaf_values(bins: np.ndarray, tree: dict[int, tuple[int, int, float]]) -> np.ndarray:
    end = descend(bins, tree)
    values = np.zeros(max(tree) + 1)
    for n, (_, _, v) in tree.items():
        values[n] = v
    return values[end]


def prior(n: int, ones: int) -> float:
    """The score that a share of ones stands for."""
    share = min(max(ones / n, 1e-6), 1 - 1e-6) if n else 0.5
    return math.log(share / (1 - share))


def grown(found: list[tuple[int, int, float, float]], nodes: Sequence[int], tree: dict, last: bool) -> list[int]:
    """Put a level's splits into ``tree``; returns the nodes of the next level."""
    after = []
    for node, (feature, cut, _, value) in zip(nodes, found, strict=True):
        if feature < 0 or last:
            tree[node] = (-1, -1, value)
        else:
            tree[node] = (feature, cut, 0.0)
            after += [2 * node + 1, 2 * node + 2]
    return after


# ---- small tables: all trees of a target in one task ----


def joint_columns(bins: np.ndarray, n_bins: int = BINS) -> np.ndarray:
    """[pair, row] joint bin of two neighbouring features; the last of an odd number stands beside zeros."""
    if bins.shape[1] % 2:
        bins = np.hstack([bins, np.zeros((len(bins), 1), bins.dtype)])
    return np.ascontiguousarray((bins[:, 0::2].astype(np.uint16) * n_bins + bins[:, 1::2]).T)


def sums_of_rows(pairs: np.ndarray, width: int, rows: np.ndarray, place: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, n_bins: int = BINS) -> np.ndarray:
    """[node, feature, bin, (g, h)] of ``rows``, which are at ``place`` 0 .. nodes - 1; exact.

    Two features are counted at a time, which halves the work, as long as their
    joint bins are not more than the rows. ``g`` and ``h`` are whole numbers as
    doubles, and 2^29 rows of them stay exact; so many don't fit a block.
    """
    g, h = g[rows], h[rows]
    joint = nodes * n_bins * n_bins <= len(rows)
    out = np.empty((nodes, 2 * len(pairs), n_bins, 2), np.int64)
    offset = place * (n_bins * n_bins if joint else n_bins)
    for p, column in enumerate(pairs):
        key = column[rows] if len(rows) < len(column) else column
        if joint:
            cell = key + offset
            for j, v in enumerate((g, h)):
                sums = np.bincount(cell, v, nodes * n_bins * n_bins).reshape(nodes, n_bins, n_bins)
                out[:, 2 * p, :, j], out[:, 2 * p + 1, :, j] = sums.sum(axis=2), sums.sum(axis=1)
        else:
            for f, half in ((2 * p, key // n_bins), (2 * p + 1, key % n_bins)):
                cell = half + offset
                for j, v in enumerate((g, h)):
                    out[:, f, :, j] = np.bincount(cell, v, nodes * n_bins).reshape(nodes, n_bins)
    return out[:, :width]


def fit_target(bins: np.ndarray, y: np.ndarray, trees: int, depth: int, step: float) -> Iterator[tuple[int, dict]]:
    """(tree, nodes) of one target over rows that train it.

    Of two children the one with fewer rows is counted, the other is what is
    left of their parent. The last level needs sums of its nodes only. Sums are
    whole numbers, so the trees are those of :func:`histograms` over all rows.
    """
    rows, width = bins.shape
    pairs = joint_columns(bins)
    score = np.full(rows, prior(rows, int(y.sum())))
    for t in range(trees):
        g, h = (x.astype(np.float64) for x in gradients(y, score))
        tree, nodes, leaf = {}, [0], np.zeros(rows)
        # rows in open nodes, and the place of their node
        here, place = np.arange(rows), np.zeros(rows, np.int64)
        hist = None
        for level in range(depth + 1):
            if level == depth:
                sums = [np.bincount(place, x[here], len(nodes)).astype(np.int64).tolist() for x in (g, h)]
                found = [(-1, -1, -math.inf, (a / UNIT) / (b / UNIT + RIDGE)) for a, b in zip(*sums, strict=True)]
            else:
                if level == 0:
                    hist = sums_of_rows(pairs, width, here, place, 1, g, h)
                else:
                    size = np.bincount(place, minlength=len(nodes)).reshape(-1, 2)
                    lesser = 2 * np.arange(len(size)) + (size[:, 1] < size[:, 0])
                    counted = np.zeros(len(nodes), bool)
                    counted[lesser] = True
                    own = counted[place]
                    part = sums_of_rows(pairs, width, here[own], place[own] // 2, len(size), g, h)
                    whole, hist = hist, np.empty((len(nodes), *part.shape[1:]), np.int64)
                    hist[lesser], hist[lesser ^ 1] = part, whole - part
                # A row's curvature is above zero, so it tells empty sides as a count of rows would.
                found = best_splits(np.stack([hist[..., 1], hist[..., 0], hist[..., 1]], axis=-1))
            nodes = grown(found, nodes, tree, level == depth)
            feature, cut, _, value = (np.array(x) for x in zip(*found, strict=True))
            split = (feature >= 0) & (level < depth)
            moving = split[place]
            leaf[here[~moving]] = value[place[~moving]]
            if not nodes:
                break
            here, place = here[moving], place[moving]
            right = bins[here, feature[place]] > cut[place]
            place = 2 * (np.cumsum(split) - 1)[place] + right
            hist = hist[split]
        yield t, tree
        score = score + step * leaf


def _tree_rows(target: int, tree: int, nodes: dict) -> list[tuple]:
    return [(target, tree, n, f, b, float(v)) for n, (f, b, v) in sorted(nodes.items())]


def fit_shipped(table: DataFrame, width: int, trees: list[int], depth: list[int], step: float) -> DataFrame:
    """Every task fits some targets on the whole table, whose size has been checked."""
    held = table.toArrow()
    rows = held.num_rows
    bins = np.frombuffer(b"".join(held.column("bins").to_pylist()), np.uint8).reshape(rows, width)
    y = np.frombuffer(b"".join(held.column("y").to_pylist()), np.uint8).reshape(rows, len(trees))
    spark = table.sparkSession
    shipped = spark.sparkContext.broadcast((bins, y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, y = shipped.value
        for batch in batches:
            for k in batch.column("id").to_pylist():
                own = y[:, k] < 2
                out = _tree_rows(k, -1, {0: (-1, -1, prior(int(own.sum()), int(y[own, k].sum())))})
                for t, nodes in fit_target(bins[own], y[own, k].astype(float), trees[k], depth[k], step):
                    out += _tree_rows(k, t, nodes)
                yield _tree_batch(out)

    targets = spark.range(0, len(trees), 1, len(trees))
    return materialise(targets.mapInArrow(run, TREES), "boosted-trees")


def _tree_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["target", "tree", "node", "feature", "bin", "value"])


# ---- tables of any size: a pass per level over all targets ----


def _scored(table: DataFrame, starts: list[float]) -> DataFrame:
    """The table with its first scores, as packed doubles."""
    first = np.array(starts).tobytes()
    return table.withColumn("score", F.lit(bytearray(first)))


def _advance(bins: np.ndarray, score: np.ndarray, done: list[list[dict]], step: float) -> None:
    for k, trees in enumerate(done):
        for tree in trees:
            score[:, k] = score[:, k] + step * leaf_values(bins, tree)


def _blocks(batch: pa.RecordBatch, width: int, targets: int):
    n = batch.num_rows
    read = lambda c, kind, w: np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).reshape(n, w)
    return read("bins", np.uint8, width), read("y", np.uint8, targets), read("score", np.float64, targets).copy()


def level_splits(table: DataFrame, width: int, done: list[list[dict]], growing: list[dict], nodes: list[list[int]], step: float) -> dict[tuple[int, int], tuple]:
    """The best split of every open node of every target: (feature, bin, gain, value).

    ``done`` holds the trees since the scores were stored, ``growing`` the trees
    of this pass. A task adds up its rows; the sums meet by target, node and
    feature, where a window runs over the bins, and only best splits leave Spark.
    """
    targets = len(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, y, score = _blocks(batch, width, targets)
            _advance(bins, score, done, step)
            for k in range(targets):
                own = y[:, k] < 2
                if not nodes[k] or not own.any():
                    continue
                mine = bins[own]
                end = descend(mine, growing[k])
                place = np.full(max(int(end.max()), max(nodes[k])) + 1, -1)
                place[nodes[k]] = np.arange(len(nodes[k]))
                place = place[end]
                here = place >= 0
                g, h = gradients(y[own, k].astype(float), score[own, k])
                part = histograms(mine[here], place[here], len(nodes[k]), g[here], h[here])
                held[k] = held[k] + part if k in held else part
        for k, hist in held.items():
            node, feature, cut = np.nonzero(hist[..., 0])
            cells = hist[node, feature, cut]
            columns = [np.full(len(node), k), np.array(nodes[k])[node], feature, cut, cells[:, 0], cells[:, 1], cells[:, 2]]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["target", "node", "feature", "bin", "n", "g", "h"])

    cells = table.mapInArrow(run, "target long, node long, feature long, bin long, n long, g long, h long")
    sums = cells.groupBy("target", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ngh"])
    whole = Window.partitionBy("target", "node", "feature")
    upto = whole.orderBy("bin")
    left = sums.select("target", "node", "feature", "bin", *[F.sum(c).over(upto).alias(f"l{c}") for c in "ngh"], *[F.sum(c).over(whole).alias(c) for c in "ngh"])
    real = lambda c: F.col(c) / F.lit(float(UNIT))
    g, h = real("g"), real("h")
    gain = F.when((F.col("ln") < F.col("n")), split_gain(real("lg"), real("lh"), g, h))
    rated = left.select("target", "node", "feature", "bin", gain.alias("gain"), (g / (h + RIDGE)).alias("value"))
    # The greatest gain; of equal ones the smallest feature, then the smallest bin.
    best = F.max(F.struct(F.coalesce("gain", F.lit(float("-inf"))).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "value")).alias("s")
    found = {}
    for r in rated.groupBy("target", "node").agg(best).collect():
        s = r.s
        found[r.target, r.node] = (-s.f, -s.b, s.gain, s.value) if s.gain > LEAST_GAIN else (-1, -1, s.gain, s.value)
    return found


def fit_passes(table: DataFrame, width: int, trees: list[int], depth: list[int], step: float, store_every: int = STORE_EVERY) -> DataFrame:
    """All targets grow their next tree together, a level per pass."""
    spark, targets = table.sparkSession, len(trees)
    marks = [F.get(F.split(F.hex("y"), "(?<=\\G..)"), F.lit(k)) for k in range(targets)]
    counted = table.agg(*[F.count_if(m.isin("00", "01")).alias(f"n{k}") for k, m in enumerate(marks)], *[F.count_if(m == "01").alias(f"o{k}") for k, m in enumerate(marks)]).first()
    starts = [prior(counted[f"n{k}"], counted[f"o{k}"]) for k in range(targets)]
    scored = materialise(_scored(table, starts), "boosted-scores")
    out = [row for k in range(targets) for row in _tree_rows(k, -1, {0: (-1, -1, starts[k])})]
    done: list[list[dict]] = [[] for _ in range(targets)]
    for t in range(max(trees, default=0)):
        growing, nodes = [{} for _ in range(targets)], [[0] if t < trees[k] else [] for k in range(targets)]
        for level in range(max(depth) + 1):
            if not any(nodes):
                break
            found = level_splits(scored, width, done, growing, nodes, step)
            for k in range(targets):
                # A node without rows can only be the root of a target that nothing trains.
                splits = [found.get((k, n), (-1, -1, -math.inf, 0.0)) for n in nodes[k]]
                nodes[k] = grown(splits, nodes[k], growing[k], level == depth[k])
        for k in range(targets):
            if t < trees[k]:
                done[k].append(growing[k])
                out += _tree_rows(k, t, growing[k])
        if (t + 1) % store_every == 0:
            scored = materialise(_rescored(scored, width, done, step), "boosted-scores")
            done = [[] for _ in range(targets)]
    return materialise(spark.createDataFrame(out, TREES), "boosted-trees")


def _rescored(table: DataFrame, width: int, done: list[list[dict]], step: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins, _, score = _blocks(batch, width, len(done))
                _advance(bins, score, done, step)
                packed = pa.array([r.tobytes() for r in score], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("y"), packed], ["bins", "y", "score"])

    return table.mapInArrow(run, "bins binary, y binary, score binary")


# ---- the operator ----


def fit_boosted(
    df: DataFrame, names: Sequence[str], features: str = "features", target: str = "target", trees: Sequence[int] | int = 700, depth: Sequence[int] | int = 5,
    step: float = 0.1, block_bytes: int = BLOCK_BYTES,
) -> Boosted:
    """Boosted trees for every position of a 0/1/null vector, all at once.

    ``trees`` and ``depth`` are one number or one per name. Rows with a null
    target vector train nothing; null or missing feature values count as zero.
    A target without rows scores 0.5 everywhere.
    """
    names = list(names)
    trees = [trees] * len(names) if isinstance(trees, int) else list(trees)
    depth = [depth] * len(names) if isinstance(depth, int) else list(depth)
    if not len(names) == len(trees) == len(depth):
        raise ValueError("give one number of trees and one depth per name")
    known = df.where(F.col(target).isNotNull())
    edges = bin_edges(known, features)
    table = materialise(training_table(df, features, target, edges), "boosted-table")
    small = table.count() * (len(edges) + len(names)) <= block_bytes
    rows = (fit_shipped if small else fit_passes)(table, len(edges), trees, depth, step)
    return Boosted(rows, edges, names, step)


class _Compiled:
    """All trees of a model as arrays, for rows of bins."""

    def __init__(self, rows: list[tuple], targets: int, step: float):
        self.step = step
        self.starts = np.zeros(targets)
        nodes: list[dict[int, dict]] = [{} for _ in range(targets)]
        for k, t, node, f, b, v in rows:
            if t < 0:
                self.starts[k] = v
            else:
                nodes[k].setdefault(t, {})[node] = (f, b, v)
        self.trees = [{t: self._arrays(tree) for t, tree in own.items()} for own in nodes]

    @staticmethod
    def _arrays(tree: dict[int, tuple[int, int, float]]) -> tuple:
        """Levels, feature, cut, children and value by place; a leaf's children are itself."""
        place = {n: i for i, n in enumerate(sorted(tree))}
        feature, cut, value = (np.array(x) for x in zip(*(tree[n] for n in place), strict=True))
        after = [[i, i] if f < 0 else [place[2 * n + 1], place[2 * n + 2]] for (n, i), f in zip(place.items(), feature.tolist(), strict=True)]
        levels = max(n + 1 for n in tree).bit_length() - 1
        return levels, np.maximum(feature, 0), cut, np.array(after).ravel(), value

    def staged(self, bins: np.ndarray, k: int, stops: Sequence[int]) -> Iterator[np.ndarray]:
        """Probabilities of target ``k`` after the first ``stop`` trees, for ascending stops."""
        score, t = np.full(len(bins), self.starts[k]), 0
        cells, width = bins.ravel(), bins.shape[1]
        first = np.arange(len(bins)) * width
        for stop in stops:
            while t < stop and t in self.trees[k]:
                levels, feature, cut, after, value = self.trees[k][t]
                node = np.zeros(len(bins), np.int64)
                for _ in range(levels):
                    node = after.take(2 * node + (cells.take(first + feature.take(node)) > cut.take(node)))
                score = score + self.step * value.take(node)
                t += 1
            yield 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def staged_probabilities(model: Boosted, df: DataFrame, features: str = "features", stops: Sequence[int] | None = None) -> DataFrame:
    """``df`` with ``p``: per target an array of its probabilities after each number of trees in ``stops``.

    Without stops all trees count. One map; the trees are shipped once (their
    number and depth bound their size).
    """
    stops = sorted(stops) if stops else [1 << 30]
    rows = [tuple(r) for r in model.trees.collect()]
    shipped = df.sparkSession.sparkContext.broadcast(rows)
    edges, targets, step = model.edges, len(model.names), model.step
    compiled: list[_Compiled] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = compiled[0] if compiled else _Compiled(shipped.value, targets, step)
        for batch in batches:
            bins = binned(_matrix(batch.column("__x"), len(edges)), edges)
            cells = np.stack([np.stack(list(own.staged(bins, k, stops)), axis=1) for k in range(targets)], axis=1).reshape(-1)
            inner = pa.ListArray.from_arrays(np.arange(0, len(cells) + 1, len(stops), dtype=np.int32), pa.array(cells))
            outer = pa.ListArray.from_arrays(np.arange(0, len(inner) + 1, targets, dtype=np.int32), inner)
            kept = [c for c in batch.schema.names if c != "__x"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], outer], [*kept, "p"])

    from pyspark.sql import types as T

    rest = [c for c in df.columns if c != features]
    held = as_array(df.select(*rest, F.col(features).alias("__x")), "__x")
    schema = T.StructType([*[df.schema[c] for c in rest], T.StructField("p", T.ArrayType(T.ArrayType(T.DoubleType())))])
    return held.mapInArrow(run, schema)


def label_probabilities(model: Boosted, df: DataFrame, key: str, features: str = "features", target: str | None = "target") -> DataFrame:
    """Long probabilities: (id, label, p) and ``actual`` when there is a target."""
    columns = [F.col(key).alias("id"), features, *([F.col(target).alias("__t")] if target else [])]
    scored = staged_probabilities(model, df.select(*columns), features)
    cells = [
        F.struct(F.lit(name).alias("label"), F.get(F.get("p", F.lit(k)), F.lit(0)).alias("p"), *([F.get("__t", F.lit(k)).cast("int").alias("actual")] if target else []))
        for k, name in enumerate(model.names)
    ]
    return scored.select("id", F.inline(F.array(*cells)))


def staged_grid(
    df: DataFrame, key: str, trees: Sequence[int], depths: Sequence[int], features: str = "features", target: str = "target", folds: int = 3, step: float = 0.1,
) -> DataFrame:
    """(trees, depth, f1): the mean over ``folds`` of the weighted F1 of every grid point.

    Each fold and depth is one target of one fit: its longest ensemble, with the
    held-out rows null. The numbers of trees are prefixes of it. Folds follow a
    hash of the key, so they are the same on every run.
    """
    from kinolens.operators.sampling import bucket_of

    longest, depths = max(trees), list(depths)
    fold = (bucket_of(key) % folds).cast("int")
    marked = df.select(features, F.col(target).cast("int").alias("__y"), fold.alias("__fold"))
    each = F.array(*[F.when(F.col("__fold") != f, F.col("__y")) for f in range(folds) for _ in depths])
    names = [f"{f}/{d}" for f in range(folds) for d in depths]
    model = fit_boosted(marked.select(features, each.alias("__targets")), names, features, "__targets", longest, depths * folds, step)
    stops = sorted(set(trees))
    scored = staged_probabilities(model, marked, features, stops).where("__y is not null")
    points = [
        F.struct(F.lit(n).cast("int").alias("trees"), F.lit(d).cast("int").alias("depth"), F.lit(f).alias("fold"), (F.get(F.get("p", F.lit(f * len(depths) + j)), F.lit(i)) > 0.5).cast("int").alias("guess"))
        for f in range(folds) for j, d in enumerate(depths) for i, n in enumerate(stops)
    ]
    held = F.filter(F.array(*points), lambda x: x["fold"] == F.col("__fold"))
    cells = scored.select("__y", F.inline(held)).groupBy("trees", "depth", "fold").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if((F.col("guess") == c) & (F.col("__y") == c)).alias(f"tp{c}") for c in (0, 1)],
        *[F.count_if(F.col("guess") == c).alias(f"said{c}") for c in (0, 1)],
        *[F.count_if(F.col("__y") == c).alias(f"true{c}") for c in (0, 1)],
    )
    f1 = sum(F.coalesce(F.try_divide(2 * F.col(f"tp{c}"), F.col(f"said{c}") + F.col(f"true{c}")), F.lit(0.0)) * F.col(f"true{c}") for c in (0, 1)) / F.col("n")
    return cells.select("trees", "depth", f1.alias("f1")).groupBy("trees", "depth").agg(F.avg("f1").alias("f1"))
