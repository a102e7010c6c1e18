"""Fingerprints and likeness over all anchors."""

import random

import numpy as np
import pyarrow as pa

from kinolens.llm import fingerprints


def words(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_all_anchors_count():
    r = random.Random(1)
    texts = [words(r, 400) for _ in range(12)]
    for t in texts:
        parts = t.split()
        parts[200] = "changed"
        a, b = fingerprints.anchor_sets(pa.array([t, " ".join(parts)]))
        assert len(a) > 200
        assert fingerprints.written(a) != fingerprints.written(b)
        assert 0.95 < fingerprints.likeness(a, b) < 1
    passage = words(r, 60)
    a, b = fingerprints.anchor_sets(pa.array([f"{texts[0]} {passage} {texts[1]}", f"{texts[2]} {passage} {texts[3]}"]))
    assert 0.04 < fingerprints.likeness(a, b) < 0.12


def test_order_of_anchors_counts():
    r = random.Random(2)
    x, y = words(r, 200), words(r, 200)
    a, b = fingerprints.anchor_sets(pa.array([f"{x} {y}", f"{y} {x}"]))
    assert 0.4 < fingerprints.likeness(a, b) < 0.6
    assert fingerprints.likeness(np.array([1, 2, 3, 4], np.uint32), np.array([9, 1, 3, 2, 4], np.uint32)) == 2 * 3 / 9
