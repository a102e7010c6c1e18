"""Boosted trees of many targets: both ways of growing, plain trees, search by prefixes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinolens.operators import boosting as bt
from kinolens.operators import models as md
from kinolens.operators.sampling import bucket_of
from kinolens.session import fresh_dir


def some_rows(n=120, seed=4):
    """Features with ties, zeros, nulls and repeats; targets with nulls, one that is always null, one always 1."""
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = [float(r.integers(0, 4)), float(r.normal()), 0.0, float(r.integers(0, 2)) * 5, None if i % 17 == 0 else float(r.normal())]
        y = [int(x[1] + (x[0] > 1) > 0.5), None if i % 5 == 0 else int((x[0] > 1) != (x[3] > 0)), None, 1]
        rows.append((i, x, y))
    return [*rows, rows[0], rows[1], (n, [1.0] * 5, None)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(some_rows(), "id long, features array<double>, target array<int>").repartition(3)


NAMES = ["sum", "either", "unknown", "always"]


def trees_of(model):
    return sorted(map(tuple, model.trees.collect()))


@pytest.fixture(scope="module")
def both(table):
    fit = lambda size: bt.fit_boosted(table, NAMES, trees=[4, 3, 2, 2], depth=[3, 2, 2, 1], block_bytes=size)
    return fit(1 << 20), fit(0)


def test_passes_and_shipped_table_grow_the_same_trees(both):
    shipped, passes = map(trees_of, both)
    assert [r[:5] for r in shipped] == [r[:5] for r in passes]
    assert np.allclose([r[5] for r in shipped], [r[5] for r in passes], rtol=0, atol=0)


def test_scores_stored_on_the_way_change_nothing(table, both, monkeypatch):
    monkeypatch.setattr(bt.fit_passes, "__defaults__", (2,))
    assert trees_of(bt.fit_boosted(table, NAMES, trees=[4, 3, 2, 2], depth=[3, 2, 2, 1], block_bytes=0)) == trees_of(both[1])


def plain_fit(x, y, edges, trees, depth, step=0.1):
    """Probabilities after each tree, by loops over rows, features and cuts."""
    share = sum(y) / len(y)
    start = math.log(share / (1 - share))
    score, out = [start] * len(y), []
    bins = [[sum(e < (v or 0.0) for e in edges[f]) for f, v in enumerate(row)] for row in x]
    for _ in range(trees):
        g = [round((t - 1 / (1 + math.exp(-s))) * bt.UNIT) for t, s in zip(y, score, strict=True)]
        h = [round((p := 1 / (1 + math.exp(-s))) * (1 - p) * bt.UNIT) for s in score]

        def grow(rows, level):
            total = [sum(v[i] for i in rows) / bt.UNIT for v in (g, h)]
            best = None
            for f in range(len(edges)):
                for cut in range(bt.BINS - 1):
                    left = [i for i in rows if bins[i][f] <= cut]
                    if not left or len(left) == len(rows):
                        continue
                    gl, hl = (sum(v[i] for i in left) / bt.UNIT for v in (g, h))
                    gain = gl**2 / (hl + 1) + (total[0] - gl) ** 2 / (total[1] - hl + 1) - total[0] ** 2 / (total[1] + 1)
                    if best is None or gain > best[0]:
                        best = (gain, f, cut)
            if level == depth or best is None or best[0] <= bt.LEAST_GAIN:
                for i in rows:
                    score[i] += step * total[0] / (total[1] + 1)
                return
            grow([i for i in rows if bins[i][best[1]] <= best[2]], level + 1)
            grow([i for i in rows if bins[i][best[1]] > best[2]], level + 1)

        grow(list(range(len(y))), 0)
        out.append([1 / (1 + math.exp(-s)) for s in score])
    return out


def test_trees_are_those_of_plain_loops(spark, table, both):
    rows = [(x, t[1]) for _, x, t in some_rows() if t is not None and t[1] is not None]
    x, y = [r[0] for r in rows], [r[1] for r in rows]
    want = plain_fit(x, y, both[0].edges, 3, 2)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "id long, features array<double>")
    got = {r.id: r.p[1] for r in bt.staged_probabilities(both[0], frame, stops=[1, 2, 3]).collect()}
    assert np.allclose([[got[i][t] for i in range(len(x))] for t in range(3)], want, atol=1e-9)


def test_targets_without_rows_or_without_zeros(both, table):
    p = {(r.id, r.label): r.p for r in bt.label_probabilities(both[0], table.dropDuplicates(["id"]), "id").collect()}
    assert all(v == 0.5 for (_, label), v in p.items() if label == "unknown")
    assert all(v > 0.99 for (_, label), v in p.items() if label == "always")


def test_saved_model_scores_the_same(spark, both, table):
    path = both[0].save(fresh_dir(spark, "boosted"))
    score = lambda m: sorted(map(tuple, bt.label_probabilities(m, table, "id").collect()), key=str)
    assert score(bt.Boosted.load(spark, path)) == score(both[0])


def test_grid_points_are_those_of_separate_fits(spark):
    """Every point of the staged search has the F1 of fits that grow just so many trees on the other folds."""
    rows = [(i, x, t[0]) for i, x, t in some_rows(90, 6) if t is not None]
    frame = spark.createDataFrame(rows, "id long, features array<double>, target int").dropDuplicates(["id"])
    got = {(r.trees, r.depth): r.f1 for r in bt.staged_grid(frame, "id", [2, 5], [1, 3], folds=3).collect()}
    assert set(got) == {(2, 1), (2, 3), (5, 1), (5, 3)}
    fold = frame.withColumn("fold", bucket_of("id") % 3)
    edges = bt.bin_edges(frame.select("features"), "features")
    for (trees, depth), f1 in got.items():
        each = []
        for f in range(3):
            train, test = (fold.where(c) for c in (f"fold <> {f}", f"fold = {f}"))
            a = [(r.features, r.target) for r in train.collect()]
            held = [(r.features, r.target) for r in test.collect()]
            bins = lambda rows: bt.binned(np.array([[v or 0.0 for v in x] for x, _ in rows]), edges)
            y = np.array([t for _, t in a], float)
            score = np.full(len(held), bt.prior(len(y), int(y.sum())))
            for _, tree in bt.fit_target(bins(a), y, trees, depth, 0.1):
                score = score + 0.1 * bt.leaf_values(bins(held), tree)
            guess, true = (score > 0).astype(int), np.array([t for _, t in held])
            parts = [2 * ((guess == c) & (true == c)).sum() / max(1, (guess == c).sum() + (true == c).sum()) * (true == c).sum() for c in (0, 1)]
            each.append(sum(parts) / len(true))
        assert abs(np.mean(each) - f1) < 1e-9


def test_sparse_vectors_and_dense_arrays_give_the_same(spark, table):
    ml = md.to_matrix(table.withColumn("features", F.transform("features", lambda v: F.coalesce(v, F.lit(0.0)))), "features", "target")
    assert trees_of(bt.fit_boosted(ml, NAMES, trees=2, depth=2)) == trees_of(bt.fit_boosted(table, NAMES, trees=2, depth=2))


def test_passes_stay_in_spark(table):
    """A level is one pass: histograms from a map, sums by a partial aggregate, no row on the driver, no cross join."""
    edges = bt.bin_edges(table.where("target is not null"), "features")
    rows = bt._scored(bt.training_table(table, "features", "target", edges), [0.0] * 4)
    assert len(bt.level_splits(rows, len(edges), [[] for _ in range(4)], [{} for _ in range(4)], [[0]] * 4, 0.1)) == 3


def test_parameters_per_name(table):
    with pytest.raises(ValueError, match="one number"):
        bt.fit_boosted(table, NAMES, trees=[1])


def counted_afresh(bins, y, trees, depth, step):
    """Trees from the histograms of all rows at every level."""
    score = np.full(len(y), bt.prior(len(y), int(y.sum())))
    for t in range(trees):
        g, h = bt.gradients(y, score)
        tree, nodes = {}, [0]
        for level in range(depth + 1):
            end = bt.descend(bins, tree)
            place = np.array([nodes.index(e) if e in nodes else -1 for e in end.tolist()], np.int64)
            here = place >= 0
            nodes = bt.grown(bt.best_splits(bt.histograms(bins[here], place[here], len(nodes), g[here], h[here])), nodes, tree, level == depth)
            if not nodes:
                break
        yield t, tree
        score = score + step * bt.leaf_values(bins, tree)


@pytest.mark.parametrize("rows, width, depth", [(2500, 9, 3), (300, 4, 6), (1, 1, 2), (0, 3, 2)])
def test_lesser_children_are_counted_and_trees_stay(rows, width, depth, monkeypatch):
    """A level below the first counts at most half of the rows, the last none; the trees are those of full counts."""
    r = np.random.default_rng(rows)
    bins = r.integers(0, bt.BINS, (rows, width)).astype(np.uint8)
    y = (bins.sum(axis=1) + r.integers(0, 40, rows) > 16 * width + 20).astype(float)
    counted, sums = [], bt.sums_of_rows
    monkeypatch.setattr(bt, "sums_of_rows", lambda *a: counted.append(len(a[2])) or sums(*a))
    got = list(bt.fit_target(bins, y, 4, depth, 0.1))
    assert got == list(counted_afresh(bins, y, 4, depth, 0.1))
    assert sum(counted) <= 4 * rows * (1 + (depth - 1) / 2)
    model = bt._Compiled([x for t, nodes in got for x in bt._tree_rows(0, t, nodes)], 1, 0.1)
    score = np.zeros(rows)
    for _, tree in got:
        score = score + 0.1 * bt.leaf_values(bins, tree)
    assert np.array_equal(next(model.staged(bins, 0, [4])), 1 / (1 + np.exp(-score)))
