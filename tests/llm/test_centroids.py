"""Centroid clustering against plain loops."""

import hashlib
import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinolens.llm import centroids
from kinolens.llm.queries import QUERIES
from tests.llm.test_operators import SF


def plain(rows, k=16, rounds=3, dim=64):
    """(id, cluster, distance, cluster_inertia, inertia, sha) of the kept rows."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * float(x)) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(near(v)[1], []).append(v)
        for c, vs in held.items():
            points[c] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = {}
    for _, d, c in found:
        inertia[c] = inertia.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return [(i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, d, c in found]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_query(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet")
    rows = list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist(), strict=True))
    assert ordered(QUERIES["op13_centroids"](spark, SF).collect()) == ordered(plain(rows))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 4), st.integers(0, 2**32 - 1), st.sampled_from([2, 5, 1000, 2**27]))
def test_tree_finds_the_smallest_nearest(k, dim, seed, width):
    """Few different values make many ties and equal centroids; great ones make great distances."""
    r = np.random.default_rng(seed)
    points, vectors = r.integers(-width, width, (k, dim)), r.integers(-width, width, (50, dim))
    number, best = centroids.VantageTree.build(points).nearest(vectors)
    distance = ((vectors[:, None] - points[None]) ** 2).sum(axis=2)
    assert best.tolist() == distance.min(axis=1).tolist() and number.tolist() == distance.argmin(axis=1).tolist()


def test_search_leaves_most_centroids_out():
    r = np.random.default_rng(1)
    points = r.integers(-10**6, 10**6, (2000, 2))
    vectors, seen = points[:200] + 1, 0
    offer = centroids.VantageTree._offer

    def counted(c, distance, who, *rest):
        nonlocal seen
        seen += len(who)
        offer(c, distance, who, *rest)

    tree = centroids.VantageTree.build(points)
    tree._offer = counted
    tree.nearest(vectors)
    assert seen < 200 * 2000 / 10


def test_awkward_rows(spark):
    """Nulls, other lengths, values that are not finite, repeated rows and ids, a column of a clashing name."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (1, [0.5, -0.5]), (1, [3.0, 4.0]), (None, [0.01, -0.01]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 0.0]), (7, [inf, 0.0]), (8, [-0.001, 2.0]), (9, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame([(*r, 9, "v") for r in rows], "vec_id long, embedding array<double>, cluster int, vec string")
    for k in (1, 3, 16):
        assert ordered(centroids.cluster_report(table, k=k, dim=2).collect()) == ordered(plain(rows, k=k, dim=2))
    assert centroids.cluster_report(table.limit(0)).collect() == []


def test_exact_floor_of_negative_sums(spark):
    rows = [(i, [-1 / 64 if i % 3 else 0.0] * 2) for i in range(10)]
    got = centroids.cluster_report(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=1, dim=2)
    assert ordered(got.collect()) == ordered(plain(rows, k=1, dim=2))


def test_too_great_a_component_is_an_error(spark):
    table = spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster_report(table, dim=2).collect()
