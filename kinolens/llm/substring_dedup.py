"""Repeated word passages by level-wise doubling.

Windows that are repeated at one length alone are extended to about twice that
length: 4 words, 8, and 13 (the last step overlaps, since 13 is not a power of
two times the first length). The hash of a longer window is made from two of
the level below. :mod:`kinolens.llm.repeats` says which candidates survive a
level: of the shortest windows only those that occur in two documents.

``longest`` goes on beyond the length that decides removal, doubling it while
any candidate survives, and tells how long the repeats of a document are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import NOT_SPACE, blocks, given_id, keyed, word_hashes, word_spans
from kinolens.llm.repeats import GROUP, HOT, anchored_runs, covered, level_hashes, repeated_stretches, run_batch

WINDOW = 13


def levels(window: int) -> tuple[int, ...]:
    """Lengths that double from a third of ``window`` up to it."""
    out = [max(1, window // 3)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return tuple(out)


def _runs(lengths: tuple[int, ...]):
    window = lengths[-1]

    def run(batches):
        for batch in batches:
            for first, data, offsets in blocks(batch.column("text")):
                doc, starts, ends = word_spans(data, offsets, NOT_SPACE)
                if len(doc) < window:
                    continue
                valid = doc[: len(doc) - window + 1] == doc[window - 1 :]
                found = anchored_runs(word_hashes(data, starts, ends), valid, lengths)
                row = doc[found["first"]]
                head = np.searchsorted(doc, row)
                yield run_batch(batch.column("doc"), batch.column("mark"), first + row, found["first"] - head, found)

    return run


def _windows(lengths: tuple[int, ...]):
    window = lengths[-1]

    def run(batches):
        for batch in batches:
            runs_of = batch.column("runs")
            for first, data, offsets in blocks(batch.column("text")):
                doc, starts, ends = word_spans(data, offsets, NOT_SPACE)
                _, hashes = level_hashes(word_hashes(data, starts, ends), lengths)
                rows = np.arange(len(offsets) - 1)
                heads = np.searchsorted(doc, rows)
                lists = runs_of.slice(first, len(rows))
                runs = pa.Table.from_struct_array(lists.flatten())
                owner = np.repeat(rows, np.asarray(lists.value_lengths()))
                at, n = np.asarray(runs.column("at")).astype(np.int64), np.asarray(runs.column("n")).astype(np.int64)
                ends_of = np.concatenate([[0], np.cumsum(n)])
                chosen = np.arange(ends_of[-1]) - np.repeat(ends_of[:-1] - at - heads[owner], n)
                found = pa.ListArray.from_arrays(pa.array(ends_of.astype(np.int32)), pa.array(hashes[chosen].view(np.int64)))
                same = [batch.column(c).take(pa.array(first + owner)) for c in ("doc", "mark")]
                rest = [runs.column(c).combine_chunks() for c in ("at", "anchor", "context", "w", "m")]
                yield pa.RecordBatch.from_arrays([*same, *rest, found], ["doc", "mark", "at", "anchor", "context", "w", "m", "hashes"])

    return run


def repeated_words(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", hot: int = HOT, group: int = GROUP) -> DataFrame:
    """(doc, mark, stretches): inclusive ranges of word numbers at which a repeated window starts.

    A window counts if its words also start one in a document with a smaller
    id. Words are runs of bytes other than ASCII white space. A null id is
    smaller than every other. Texts with fewer words than a window, empty and
    null ones have none; rows with equal ids are one document and do not repeat
    each other. Only texts with a repeat are listed.
    """
    lengths = levels(window)
    return repeated_stretches(keyed(docs, key, text), _runs(lengths), _windows(lengths), earlier=True, hot=hot, group=group)


def longest_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, longest): the longest of window, 2 window, 4 window, .. words that an earlier document repeats.

    Only documents with a survivor go on to the next length, along with all
    that survived before them; it ends when nobody is left.
    """
    rows = keyed(docs, key, text)
    alive, out, length = rows, None, window
    while True:
        found = repeated_words(alive.withColumnRenamed("doc", key), length, key)
        if found.isEmpty():
            break
        level = found.select(given_id().alias(key), F.lit(length).alias("longest"))
        out = level if out is None else out.union(level)
        length *= 2
    if out is None:
        return rows.where(F.lit(False)).select(given_id().alias(key), F.lit(0).alias("longest"))
    return out.groupBy(key).agg(F.max("longest").alias("longest"))


def remove_repeated_words(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", hot: int = HOT, group: int = GROUP) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256, spans, kept) of every row.

    ``spans`` are removed runs as (start, end) word numbers; ``kept`` is the
    remaining words joined by one space.
    """
    rows = keyed(docs, key, text)
    found = repeated_words(docs, window, key, text, hot, group)

    def run(batches):
        for batch in batches:
            stretches = batch.column("stretches").to_pylist()
            out = []
            for first, data, offsets in blocks(batch.column("text")):
                doc, starts, ends = word_spans(data, offsets, NOT_SPACE)
                raw, starts, ends = data.tobytes(), starts.tolist(), ends.tolist()
                heads = np.searchsorted(doc, np.arange(len(offsets))).tolist()
                for i, (a, b) in enumerate(zip(heads[:-1], heads[1:], strict=True)):
                    spans = covered(stretches[first + i], window)
                    at, kept = a, []
                    for s, e in [*spans, (b - a, b - a)]:
                        kept += [raw[x:y] for x, y in zip(starts[at : a + s], ends[at : a + s], strict=True)]
                        at = a + e
                    line = b" ".join(kept)
                    out.append((b - a, b - a - len(kept), hashlib.sha256(line).hexdigest(), [{"start": s, "end": e} for s, e in spans], line.decode()))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()})), pa.string()]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [batch.schema.names[0], "n_words", "n_removed", "kept_sha256", "spans", "kept"])

    joined = rows.join(found, ["doc", "mark"], "left").select(given_id().alias(key), "text", "stretches")
    schema = f"`{key}` bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<struct<start:int,end:int>>, kept string"
    return joined.mapInArrow(run, schema)


def repeated_words_report(docs: DataFrame) -> DataFrame:
    return remove_repeated_words(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
