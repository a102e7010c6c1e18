"""Document fingerprints from closed syncmers.

A window of ``K`` bytes is a closed syncmer when the least of its inner strings
of ``S`` bytes (by hash) lies at one of its edges. That depends on the window
alone, so the same passage gives the same anchors wherever it stands. All anchors
of a text count. Two texts are compared by matching their anchors in the order in
which they stand. The fingerprint is made of all anchors too: they are cut into
stretches behind anchors whose hash ends in ``CUT_BITS`` zero bits, and each
stretch is written as one digest.

The next document of each one is found by range-partitioning on the id and
reading every partition in order; the first and the last document of each
partition are matched in a second, small step.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinolens.llm.common import BYTE_VALUES, blocks, given_id, keyed, mix, pair, stored
from kinolens.llm.repeats import rolling, window_minimum

K = 20
S = 8
#: A stretch of a fingerprint has 2 ** CUT_BITS anchors in the mean.
CUT_BITS = 5


def anchor_sets(texts: pa.Array) -> list[np.ndarray]:
    """All anchors of each text as 32-bit numbers in text order, repeated ones too.

    A text without a syncmer, as when it is shorter than ``K`` bytes, has one
    anchor: a hash of the whole of it.
    """
    out: list[np.ndarray] = [None] * len(texts)
    for first, data, offsets in blocks(texts):
        n = len(offsets) - 1
        if len(data) >= K:
            units = BYTE_VALUES[data]
            inner = mix(rolling(units, S))
            least = window_minimum(inner, K - S + 1)
            size = len(data) - K + 1
            chosen = (inner[:size] == least) | (inner[K - S :] == least)
            for end in offsets[1:-1]:
                chosen[max(0, end - K + 1) : end] = False
            place = np.flatnonzero(chosen)
            doc = np.searchsorted(offsets, place, "right") - 1
            values = (mix(rolling(units, K)[place]) >> np.uint64(32)).astype(np.uint32)
            cuts = np.searchsorted(doc, np.arange(n + 1))
        else:
            cuts, values = np.zeros(n + 1, np.int64), np.zeros(0, np.uint32)
        for i in range(n):
            found = values[cuts[i] : cuts[i + 1]]
            if not len(found):
                whole = hashlib.blake2b(data[offsets[i] : offsets[i + 1]].tobytes(), digest_size=4).digest()
                found = np.frombuffer(whole, np.uint32)
            out[first + i] = found
    return out


def packed(anchors: np.ndarray) -> bytes:
    """A fingerprint as bytes, eight for each stretch of anchors."""
    cuts = np.flatnonzero((anchors & np.uint32((1 << CUT_BITS) - 1)) == 0) + 1
    starts = np.concatenate([[0], cuts[cuts < len(anchors)]])
    within = np.arange(len(anchors)) - np.repeat(starts, np.diff(np.append(starts, len(anchors))))
    return mix(np.add.reduceat(pair(anchors.astype(np.uint64), within.astype(np.uint64)), starts)).astype(">u8").tobytes()


def written(anchors: np.ndarray) -> str:
    """A fingerprint as hex digits, sixteen for each stretch of anchors."""
    return packed(anchors).hex()


def _same_head(a: np.ndarray, b: np.ndarray) -> int:
    """How many anchors two texts have in common from the first one on."""
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n


def _counted(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors with their number among equal ones, ascending, and their places."""
    order = np.argsort(a, kind="stable")
    v = a[order].astype(np.uint64)
    firsts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))[: len(v)]
    number = np.arange(len(v)) - np.repeat(firsts, np.diff(np.append(firsts, len(v))))
    return (v << np.uint64(32)) | number.astype(np.uint64), order


def matched(a: np.ndarray, b: np.ndarray) -> int:
    """How many anchors match in order.

    Those at the head and at the tail match one by one. Between them, the n-th
    of equal anchors matches the n-th, and the longest run of matches that
    stand in the same order in both texts counts.
    """
    head = _same_head(a, b)
    a, b = a[head:], b[head:]
    tail = _same_head(a[::-1], b[::-1])
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    (x, at), (y, to) = _counted(a), _counted(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    places = to[j][np.argsort(at[i])]
    if np.all(places[1:] > places[:-1]):
        return head + len(places) + tail
    ends: list[int] = []
    for p in places.tolist():
        k = bisect_left(ends, p)
        ends[k : k + 1] = [p]
    return head + len(ends) + tail


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of anchors that match in order, 0 to 1: twice the matches over all anchors of both."""
    return 2 * matched(a, b) / (len(a) + len(b))


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by as many characters from the head of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


#: Hashes and fingerprints stay bytes until the end: half the size of hex digits where they are stored.
RESULT = "doc bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
EDGES = "pid int, head boolean, text string"


def _rows(docs: list[int], texts: list[str], sets: list[np.ndarray], after: list[str], after_sets: list[np.ndarray]):
    changed = [edited(t, a) for t, a in zip(texts, after, strict=True)]
    changed_sets = anchor_sets(pa.array(changed, pa.large_string()))
    n = len(docs)
    return [
        pa.array(docs, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).digest() for t in changed], pa.binary()),
        pa.array([packed(s) for s in sets], pa.binary()), pa.array([packed(s) for s in changed_sets], pa.binary()),
        pa.array([likeness(sets[i], changed_sets[i]) for i in range(n)], pa.float64()), pa.array([likeness(sets[i], after_sets[i]) for i in range(n)], pa.float64()),
    ]


_NAMES = ["doc", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _neighbours(batches):
    """Results of all but the last document of a sorted partition, then its first and last one."""
    pid, head, held = TaskContext.get().partitionId(), None, None
    blank = lambda n, kind: pa.nulls(n, kind)
    for batch in batches:
        if not batch.num_rows:
            continue
        docs, texts, sets = batch.column("doc").to_pylist(), batch.column("text").to_pylist(), anchor_sets(batch.column("text"))
        head = head or (docs[0], texts[0])
        if held:
            docs, texts, sets = [held[0], *docs], [held[1], *texts], [held[2], *sets]
        held = (docs[-1], texts[-1], sets[-1])
        n = len(docs) - 1
        columns = _rows(docs[:-1], texts[:-1], sets[:-1], texts[1:], sets[1:])
        yield pa.RecordBatch.from_arrays([*columns, blank(n, pa.int32()), blank(n, pa.bool_()), blank(n, pa.string())], [*_NAMES, "pid", "head", "text"])
    if held:
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
        rest = [pa.array([pid, pid], pa.int32()), pa.array([True, False]), pa.array([head[1], held[1]], pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array([head[0], held[0]], pa.int64()), *[blank(2, k) for k in kinds], *rest], [*_NAMES, "pid", "head", "text"])


def _matched(batches):
    for batch in batches:
        texts, after = batch.column("text"), batch.column("after")
        columns = _rows(batch.column("doc").to_pylist(), texts.to_pylist(), anchor_sets(texts), after.to_pylist(), anchor_sets(after))
        yield pa.RecordBatch.from_arrays(columns, _NAMES)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is that with the next greater id; documents with equal
    ids follow each other by a hash of their text, null ids come first, and the
    first document follows the last. A single document follows itself. Null
    texts are empty. Other columns are not read.
    """
    rows = keyed(docs, key, text).repartitionByRange("doc", "mark").sortWithinPartitions("doc", "mark").select("doc", "text")
    table = stored(rows.mapInArrow(_neighbours, f"{RESULT}, {EDGES}"), "fingerprints")
    inner = table.where("pid is null").drop("pid", "head", "text")
    heads = table.where("head").select("pid", F.col("text").alias("after"))
    lasts = table.where("not head").select("pid", "doc", "text")
    # One row per partition: the number of the next one that has documents.
    order = Window.orderBy("pid")
    follow = heads.select("pid").select("pid", F.lead("pid").over(order).alias("then"), F.first("pid").over(order).alias("start"))
    follow = follow.select("pid", F.coalesce("then", "start").alias("then"))
    ends = lasts.join(follow, "pid").join(heads.withColumnRenamed("pid", "then"), "then").select("doc", "text", "after")
    every = inner.union(ends.mapInArrow(_matched, RESULT))
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    return every.select(given_id().alias(key), "n_chars", *hexed, "near_edited", "near_next")
