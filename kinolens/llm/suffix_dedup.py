"""Repeated byte strings by bucket-pointer refinement.

Suffixes are put into buckets by their first ``LENGTHS[0]`` (40) bytes, and the
buckets are refined by the identifiers of the buckets at later offsets: that at
offset 40 gives depth 80, that of the refined bucket at offset 80 gives depth
160, and one more, at offset 40, depth 200; every refinement reuses the one
before. A bucket identifier is a hash of what its suffixes begin with, so it
means the same in every partition and no rank has to be handed out.

A bucket with one suffix is done. :mod:`kinolens.llm.repeats` therefore looks
first at the buckets of one suffix in about eighty (each window's anchor), and
sorts on refined identifiers only where those are shared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import BLOCK_BYTES, BYTE_VALUES, blocks, given_id, keyed
from kinolens.llm.repeats import GROUP, HOT, anchored_runs, covered, level_hashes, repeated_stretches, run_batch

#: Depths of the buckets; the last one is the length of a repeated string.
LENGTHS = (40, 80, 160, 200)


def depths(length: int) -> tuple[int, ...]:
    """Depths that double from a fifth of ``length`` up to it."""
    out = [max(1, length // 5)]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return tuple(out)


def _runs(lengths: tuple[int, ...]):
    window = lengths[-1]

    def run(batches):
        for batch in batches:
            doc, mark = batch.column("doc"), batch.column("mark")
            for first, data, offsets in blocks(batch.column("text")):
                # a long document is cut so that every window start is in one part
                for base in range(0, max(1, len(data) - window + 1), BLOCK_BYTES) if len(offsets) == 2 else (0,):
                    part = data[base : base + BLOCK_BYTES + window - 1] if len(offsets) == 2 else data
                    if len(part) < window:
                        continue
                    ends = offsets if len(offsets) > 2 else np.array([0, len(part)])
                    change = np.zeros(len(part) + 1, np.int32)
                    long = np.diff(ends) >= window
                    np.add.at(change, ends[:-1][long], 1)
                    np.add.at(change, ends[1:][long] - window + 1, -1)
                    valid = np.cumsum(change)[: len(part) - window + 1] > 0
                    found = anchored_runs(BYTE_VALUES[part], valid, lengths)
                    row = np.searchsorted(ends, found["first"], "right") - 1
                    yield run_batch(doc, mark, first + row, found["first"] - ends[row] + base, found)

    return run


def _windows(lengths: tuple[int, ...]):
    window = lengths[-1]

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            for row in range(batch.num_rows):
                data = np.frombuffer(texts[row].as_buffer(), np.uint8)
                runs = pa.Table.from_struct_array(batch.column("runs")[row].values)
                at, n = np.asarray(runs.column("at")).astype(np.int64), np.asarray(runs.column("n")).astype(np.int64)
                step = max(1, BLOCK_BYTES // (2 * window))
                for i in range(0, len(at), step):
                    part = runs.slice(i, step)
                    sizes = n[i : i + step] + window - 1
                    heads = np.cumsum(sizes) - sizes
                    place = np.arange(int(sizes.sum())) - np.repeat(heads - at[i : i + step], sizes)
                    _, hashes = level_hashes(BYTE_VALUES[data[place]], lengths)
                    many = n[i : i + step]
                    offsets = np.concatenate([[0], np.cumsum(many)])
                    chosen = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - heads, many)
                    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes[chosen].view(np.int64)))
                    same = [pa.repeat(batch.column(c)[row], len(part)) for c in ("doc", "mark")]
                    rest = [part.column(c).combine_chunks() for c in ("at", "anchor", "context", "w", "m")]
                    yield pa.RecordBatch.from_arrays([*same, *rest, lists], ["doc", "mark", "at", "anchor", "context", "w", "m", "hashes"])

    return run


def repeated_bytes(docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text", hot: int = HOT, group: int = GROUP) -> DataFrame:
    """(key, text, stretches) of every row: inclusive ranges of byte offsets at which a repeated string starts.

    A string of ``length`` bytes counts if it also starts anywhere else, in the
    same text or another. ``stretches`` is null where there is none. Texts
    shorter than ``length``, empty and null ones have none; rows that repeat id
    and text repeat each other. Other columns are not read.
    """
    lengths = depths(length)
    rows = keyed(docs, key, text)
    found = repeated_stretches(rows, _runs(lengths), _windows(lengths), earlier=False, hot=hot, group=group)
    return rows.join(found, ["doc", "mark"], "left").select(given_id().alias(key), "text", "stretches")


def remove_repeated_bytes(docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text", hot: int = HOT, group: int = GROUP) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) of every row.

    ``spans`` are the maximal removed runs as (start, end) bytes, ``kept`` the
    remaining bytes; they may end inside a character.
    """

    def run(batches):
        for batch in batches:
            texts, found = batch.column("text"), batch.column("stretches").to_pylist()
            rows = []
            for i, stretches in enumerate(found):
                raw, spans, at, kept = texts[i].as_buffer().to_pybytes(), covered(stretches, length), 0, []
                for s, e in spans:
                    kept.append(raw[at:s])
                    at = e
                kept = b"".join([*kept, raw[at:]])
                rows.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": s, "end": e} for s, e in spans], kept))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()})), pa.binary()]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [batch.schema.names[0], "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    schema = f"`{key}` bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:int,end:int>>, kept binary"
    return repeated_bytes(docs, length, key, text, hot, group).mapInArrow(run, schema)


def repeated_bytes_report(docs: DataFrame) -> DataFrame:
    return remove_repeated_bytes(docs).select(F.col("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
