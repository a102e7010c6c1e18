"""Passages of a given length that occur more than once, over texts as sequences of units.

Two operators share this: units are words in one and bytes in the other. A
window is a run of ``lengths[-1]`` units. Content hashes are built level by
level: those of ``lengths[0]`` units (grams) from the units, those of each
further level from two hashes of the level below. Candidates shrink by level:

1. Each window has an *anchor*, the gram with the least hash in it (leftmost of
   equals). It depends on the window's content alone, so equal windows have
   equal anchors at equal places, and neighbouring windows mostly share one: a
   *run* of windows with the same anchor is one row. Runs whose anchor occurs
   nowhere else are done.
2. Equal runs are recognised as a whole by a hash of their context. One of each
   kind stands for it from here on.
3. Only windows of runs that share an anchor but differ in context are compared
   one by one, under their anchor.

All windows of a run cover the anchor, so what repeated windows of a run cover
is one stretch, given by the first and last repeated window.

Counts and least documents are partial aggregates, joins have plain exchanges
on both sides so that hot keys can be split. Anchors with more than ``GROUP``
contexts are compared in several groups, by the hash of the window, so that a
group stays about as large; beyond ``HOT`` contexts one window alone could fill
a group, and windows become rows that are counted before they are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import mix, stored

#: Contexts of one anchor that are compared in one group.
GROUP = 4000
#: Anchors with more contexts than this are compared as exploded rows.
HOT = 1_000_000
#: Windows compared at a time for the other anchors.
CHUNK = 200_000

_STEP = np.uint64(0xD1342543DE82EF95)
_JOIN = np.uint64(0xAEF17502108EF2D9)
_TOP = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def rolling(units: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every ``length`` neighbouring units."""
    out, have = units, 1
    for bit in bin(length)[3:]:
        out = out[:-have] * _STEP ** np.uint64(have) + out[have:]
        have *= 2
        if bit == "1":
            out = out[:-1] * _STEP + units[have:][: len(out) - 1]
            have += 1
    return out


def level_hashes(units: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first and of the last level; both empty if there are too few units."""
    if len(units) < lengths[-1]:
        return units[:0], units[:0]
    grams = rolling(units, lengths[0])
    out = grams
    for level, (have, want) in enumerate(zip(lengths, lengths[1:], strict=False)):
        step = want - have
        # a factor of its own for each level, else exchanged halves of halves would look alike
        out = out[:-step] * _JOIN ** np.uint64(3 * level + 1) + out[step:]
        out = out ^ (out >> _HALF)
    return mix(grams), mix(out)


def window_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbouring keys."""
    out, have = keys, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchored_runs(units: np.ndarray, valid: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """first, n, anchor, context of each run of windows; ``valid`` tells which windows count."""
    grams, windows = level_hashes(units, lengths)
    keys = (grams & _TOP) | np.arange(len(grams), dtype=np.uint64)
    place = window_minimum(keys, lengths[-1] - lengths[0] + 1)[valid] & _LOW
    starts = np.flatnonzero(valid)
    change = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
    first, last = starts[change], starts[np.append(change[1:], len(starts)) - 1] if len(change) else starts[:0]
    at = place[change]
    n = last - first + 1
    shape = (n.astype(np.uint64) << np.uint64(32)) | (at - first.astype(np.uint64))
    context = mix(mix(windows[first] * _JOIN + windows[last]) * _JOIN + shape)
    return {"first": first, "n": n, "anchor": grams[at.astype(np.int64)].view(np.int64), "context": context.view(np.int64)}


RUNS = "doc bigint, mark bigint, anchor bigint, context bigint, at int, n int"


def run_batch(doc, mark, rows: np.ndarray, at: np.ndarray, found: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Runs of a block as rows; ``rows`` is the batch row of each run and ``at`` its place in the text."""
    take = pa.array(rows)
    return pa.RecordBatch.from_arrays(
        [doc.take(take), mark.take(take), pa.array(found["anchor"]), pa.array(found["context"]), pa.array(at.astype(np.int32)), pa.array(found["n"].astype(np.int32))],
        ["doc", "mark", "anchor", "context", "at", "n"],
    )


def repeated_stretches(keyed: DataFrame, runs, windows, earlier: bool, hot: int = HOT, group: int = GROUP) -> DataFrame:
    """(doc, mark, stretches): inclusive ranges of window starts that are repeated, per text.

    ``keyed`` has doc, mark, text. ``runs`` maps its batches to rows of RUNS,
    ``windows`` maps batches of (doc, mark, text, runs array<struct<at, n, ..>>)
    to one list of window hashes per run. With ``earlier`` a window counts if it
    starts in a text with a smaller ``doc`` too, else if it starts anywhere else.
    """
    every = stored(keyed.mapInArrow(runs, RUNS), "runs")
    if earlier:
        known = every.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("anchor")
    else:
        known = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
    known = stored(known, "anchors")
    again = stored(every.join(known, "anchor", "left_semi"), "anchored")

    rep = F.struct("doc", "mark", "at", "n")
    kinds = again.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("c"), F.min(rep).alias("rep"))
    kinds = stored(kinds.select("anchor", "context", "c", "rep.*"), "contexts")
    # Runs that are repeated as a whole.
    if earlier:
        first = kinds.select("anchor", "context", F.col("doc").alias("first"))
        whole = again.join(first, ["anchor", "context"]).where(F.col("doc") > F.col("first"))
    else:
        whole = again.join(kinds.where("c > 1").select("anchor", "context"), ["anchor", "context"])
    whole = whole.select("doc", "mark", F.col("at").alias("s"), (F.col("at") + F.col("n") - 1).alias("e"))

    # Runs of different kinds under one anchor: compare their windows.
    shared = stored(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared-anchors")
    weight = F.col("doc") if earlier else F.col("c")
    asked = kinds.join(shared, "anchor").select("doc", "mark", F.struct("at", "n", "anchor", "context", weight.alias("w"), "m").alias("r"))
    asked = asked.groupBy("doc", "mark").agg(F.collect_list("r").alias("runs"))
    cells = "doc bigint, mark bigint, at int, anchor bigint, context bigint, w bigint, m bigint, hashes array<bigint>"
    cells = stored(keyed.join(asked, ["doc", "mark"]).mapInArrow(windows, cells), "windows")
    columns = ["anchor", "context", "doc", "mark", "at", "w", "hashes"]
    cold = cells.where(F.col("m") <= group).select(*columns, F.lit(0).alias("bucket"), F.lit(None).cast("array<int>").alias("offsets"))
    warm = cells.where((F.col("m") > group) & (F.col("m") <= hot)).select(*columns, F.ceil(F.col("m") / group).cast("int").alias("bucket"))
    groups = cold.union(warm.mapInArrow(_bucketed, cold.schema))
    groups = groups.repartition("anchor", "bucket").sortWithinPartitions("anchor", "bucket")
    found = groups.mapInArrow(_compare(earlier), "anchor bigint, context bigint, doc bigint, mark bigint, at int, w bigint, lo int, hi int")
    found = found.union(_hot(cells.where(F.col("m") > hot), earlier))
    if earlier:
        found = again.join(found.select("anchor", "context", F.col("doc").alias("first"), "lo", "hi"), ["anchor", "context"]).where(F.col("doc") == F.col("first"))
    else:
        found = found.where("w = 1")
    parts = found.select("doc", "mark", (F.col("at") + F.col("lo")).alias("s"), (F.col("at") + F.col("hi")).alias("e"))
    stretches = whole.union(parts).groupBy("doc", "mark").agg(F.collect_set(F.struct("s", "e")).alias("stretches"))
    return stored(stretches, "stretches")


def _repeated(earlier: bool) -> Column:
    return F.min("w").alias("t") if earlier else F.sum("w").alias("t")


def _hot(cells: DataFrame, earlier: bool) -> DataFrame:
    """The same for anchors with very many contexts: windows as rows, counted before they are joined."""
    rows = cells.select("anchor", "context", "doc", "mark", "at", "w", F.posexplode("hashes").alias("o", "h"))
    total = stored(rows.groupBy("anchor", "h").agg(_repeated(earlier)), "hot-windows")
    good = rows.join(total, ["anchor", "h"]).where((F.col("t") < F.col("w")) if earlier else (F.col("t") > 1))
    return good.groupBy("anchor", "context", "doc", "mark", "at", "w").agg(F.min("o").alias("lo"), F.max("o").alias("hi"))


def _bucketed(batches):
    """The windows of a run split by hash into as many rows as ``bucket`` says, with their offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("hashes")
        hashes, sizes = np.asarray(lists.flatten()), np.asarray(lists.value_lengths()).astype(np.int64)
        run = np.repeat(np.arange(len(sizes)), sizes)
        offset = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        bucket = hashes.view(np.uint64) % np.asarray(batch.column("bucket"))[run].astype(np.uint64)
        order = np.lexsort((offset, bucket, run))
        r, b = run[order], bucket[order]
        firsts = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (b[1:] != b[:-1])]))
        ends = pa.array(np.append(firsts, len(r)).astype(np.int32))
        same = batch.drop_columns(["hashes", "bucket"]).take(pa.array(r[firsts]))
        yield pa.RecordBatch.from_arrays(
            [*same.columns, pa.ListArray.from_arrays(ends, pa.array(hashes[order])), pa.array(b[firsts].astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(offset[order].astype(np.int32)))],
            [*same.schema.names, "hashes", "bucket", "offsets"],
        )


def _compare(earlier: bool):
    """Batches sorted by group to the first and last repeated window of each run; whole groups at a time."""

    def flush(table: pa.Table):
        lists = table.column("hashes").combine_chunks()
        hashes, sizes = np.asarray(lists.flatten()), np.asarray(lists.value_lengths()).astype(np.int64)
        run = np.repeat(np.arange(len(sizes)), sizes)
        offset = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        given = table.column("offsets").combine_chunks()
        offset[np.repeat(np.asarray(given.is_valid()), sizes)] = np.asarray(given.flatten())
        anchor, w = np.asarray(table.column("anchor"))[run], np.asarray(table.column("w"))
        order = np.lexsort((hashes, anchor))
        a, h, v = anchor[order], hashes[order], w[run[order]]
        firsts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (h[1:] != h[:-1])]))
        each = np.diff(np.append(firsts, len(order)))
        if earlier:
            good = np.repeat(np.minimum.reduceat(v, firsts), each) < v
        else:
            good = np.repeat(np.add.reduceat(v, firsts), each) > 1
        chosen = np.sort(order[good])
        kept, lo = np.unique(run[chosen], return_index=True)
        hi = np.append(lo[1:], len(chosen))[: len(lo)] - 1
        out = table.drop_columns(["hashes", "bucket", "offsets"]).take(pa.array(kept))
        return out.append_column("lo", pa.array(offset[chosen[lo]].astype(np.int32))).append_column("hi", pa.array(offset[chosen[hi]].astype(np.int32)))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += len(batch.column("hashes").flatten())
            if size < CHUNK:
                continue
            table = pa.concat_tables(held).combine_chunks()
            anchors, buckets = np.asarray(table.column("anchor")), np.asarray(table.column("bucket"))
            heads = np.flatnonzero((anchors[1:] != anchors[:-1]) | (buckets[1:] != buckets[:-1])) + 1
            ends = np.cumsum(np.asarray(table.column("hashes").combine_chunks().value_lengths()))
            at = 0
            # parts of about CHUNK windows, cut between groups; the last group may go on in the next batch
            while len(heads) and at < heads[-1]:
                k = int(np.searchsorted(heads, np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK)))
                stop = int(heads[min(k, len(heads) - 1)])
                yield from flush(table.slice(at, stop - at).combine_chunks()).to_batches()
                at = stop
            held = [table.slice(at).combine_chunks()]
            size = int(ends[-1] - (ends[at - 1] if at else 0))
        if held:
            yield from flush(pa.concat_tables(held).combine_chunks()).to_batches()

    return run


def covered(stretches: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Disjoint (start, end) of the units that the windows of inclusive start ranges cover."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in stretches or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e + length)
        else:
            out.append([s, e + length])
    return [(s, e) for s, e in out]
