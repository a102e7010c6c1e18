"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Fingerprints that differ in at most
``MAX_BITS`` (2) bits differ in at most two of them, so they share at least six:
the guaranteed minimum. The posting lists of single positional bytes would hold
1/256 of all fingerprints each, so they are intersected: a list belongs to the
bytes at four positions, and the six sets of four positions in ``POSITIONS``
are chosen so that whichever two bytes differ, one set avoids both. Pairs that
meet in a list are tallied (positional bytes they share), kept from six on, and
verified by their bits.

A list longer than ``LIST_LENGTH`` would make too many pairs. Its fingerprints
are instead linked through all values one bit away: two fingerprints are within
two bits exactly if they share such a value, so each sends 65 rows, whatever the
length of the list, and linking to the least member of a value keeps the same
components.

Equal fingerprints are one node throughout; components are found on nodes.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinolens.llm.common import LOWER, NOT_SPACE, NULL_ID, blocks, given_id, keyed, stored, word_spans
from kinolens.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SHARED_BYTES = 6
LIST_LENGTH = 64

#: Sets of four of the eight positions; every two positions are outside one of them.
POSITIONS = ((0, 1, 2, 3), (0, 1, 4, 5), (0, 1, 6, 7), (2, 3, 4, 5), (2, 3, 6, 7), (4, 5, 6, 7))
if any(all({a, b} & set(p) for p in POSITIONS) for a, b in combinations(range(8), 2)):
    raise AssertionError("two differing bytes would be missed")


def text_fingerprints(column) -> np.ndarray:
    """64-bit SimHash of each text of an Arrow column; texts without words give zero."""
    out = np.zeros(len(column), np.uint64)
    digest = xxhash.xxh64_intdigest
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for first, data, offsets in blocks(column):
        data = LOWER[data]
        doc, starts, ends = word_spans(data, offsets, NOT_SPACE)
        if not len(starts):
            continue
        # words one space apart, so that a shingle is one slice
        lengths = ends - starts
        at = np.cumsum(lengths + 1) - lengths - 1
        joined = np.full(int(at[-1] + lengths[-1] + 1), 0x20, np.uint8)
        place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        joined[place + np.repeat(at, lengths)] = data[place + np.repeat(starts, lengths)]
        raw = joined.tobytes()
        heads = np.searchsorted(doc, np.unique(doc))
        words = np.diff(np.concatenate([heads, [len(doc)]]))
        last = np.arange(len(doc)) + np.repeat(np.minimum(SHINGLE, words) - 1, words)
        tail = np.repeat(heads + words, words)
        good = last < tail
        good[heads] = True
        begin, end = at[good], (at + lengths)[last[good]]
        hashes = np.fromiter([digest(raw[i:j], SEED) for i, j in zip(begin.tolist(), end.tolist(), strict=True)], np.uint64, len(begin))
        owner = doc[good]
        firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        counts = np.diff(np.concatenate([firsts, [len(owner)]]))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, firsts, axis=0, dtype=np.int32)
        out[first + owner[firsts]] = np.where(2 * ones > counts[:, None], bit, np.uint64(0)).sum(1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a last column ``fp``: the SimHash of its ``text`` column as a long."""

    def run(batches):
        for batch in batches:
            fp = pa.array(text_fingerprints(batch.column(text)).view(np.int64))
            rest = [c for c in batch.schema.names if c != text]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], fp], [*rest, "fp"])

    rest = [f for f in docs.schema.fields if f.name != text]
    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", fp bigint")


def near_links(nodes: DataFrame, list_length: int = LIST_LENGTH) -> DataFrame:
    """(a, b): links whose components are those of all pairs of ``fp`` within MAX_BITS bits."""

    masks = [sum(0xFF << (8 * i) for i in p) for p in POSITIONS]
    signed = [m - 2**64 if m >= 2**63 else m for m in masks]
    lists = F.array(*[F.struct(F.lit(k).alias("list"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for k, m in enumerate(signed)])
    postings = nodes.select("fp", F.inline(lists))
    shared = postings.groupBy("list", "bytes").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = stored(shared, "posting-lists")
    postings = stored(postings.join(shared, ["list", "bytes"]), "postings")
    short, long = postings.where(F.col("n") <= list_length), postings.where(F.col("n") > list_length)

    left = short.select("list", "bytes", F.col("fp").alias("a"))
    right = short.select("list", "bytes", F.col("fp").alias("b"))
    pairs = left.join(right, ["list", "bytes"]).where(F.col("a") < F.col("b"))
    differs = F.col("a").bitwiseXOR(F.col("b"))
    tally = sum((F.shiftrightunsigned(differs, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(8))
    pairs = pairs.where((tally >= SHARED_BYTES) & (F.bit_count(differs) <= MAX_BITS)).select("a", "b").distinct()

    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(2**63)) for i in range(64)])
    around = long.select("fp").distinct().select("fp", F.explode(flips).alias("bit"))
    around = around.select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("value"))
    around = stored(around, "one-bit-values")
    least = stored(around.groupBy("value").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "value-least")
    stars = around.join(least, "value").where(F.col("fp") != F.col("b")).select(F.col("fp").alias("a"), "b").distinct()
    return pairs.union(stars)


def _placed(docs: DataFrame, key: str, text: str, list_length: int) -> DataFrame:
    """(doc, mark, fp, root, component_id) of every row; root is a fingerprint of the component."""
    rows = stored(fingerprints(keyed(docs, key, text)), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min(given_id()).alias("first")), "nodes")
    found = components(near_links(nodes.select("fp"), list_length))
    nodes = nodes.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left")
    nodes = stored(nodes.select("fp", "first", F.coalesce("root", "fp").alias("root")), "placed")
    smallest = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    nodes = stored(nodes.join(smallest, "root").select("fp", "root", "component_id"), "components")
    return rows.join(nodes, "fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", list_length: int = LIST_LENGTH) -> DataFrame:
    """(key, fingerprint, component_id) of every row.

    ``component_id`` is the smallest id reachable over links between
    fingerprints, the row's own included. Null and empty texts have the
    fingerprint zero and are linked like any other. Null ids take part in links
    but are never the smallest, so a component of null ids has a null one.
    Repeated rows are in the same component; other columns are not read.
    """
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _placed(docs, key, text, list_length).select(given_id().alias(key), hexed, "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", list_length: int = LIST_LENGTH) -> DataFrame:
    """One row of ``docs`` per component, all columns as they are: that with the smallest id.

    Rows without an id come last. Of rows that repeat an id and a text, any one
    stays.
    """
    return first_rows(docs, _placed(docs, key, text, list_length), key, text)


def first_rows(docs: DataFrame, placed: DataFrame, key: str, text: str) -> DataFrame:
    """The row of ``docs`` with the smallest id of each ``root``; ``placed`` has doc, mark and root of every row."""
    order = F.struct((F.col("doc") == NULL_ID).alias("late"), "doc", "mark")
    chosen = stored(placed.groupBy("root").agg(F.min(order).alias("c")).select("c.doc", "c.mark"), "chosen")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.coalesce(F.col(f"row.`{key}`").cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(F.coalesce(F.col(f"row.`{text}`"), F.lit(""))).alias("mark"))
    kept = rows.join(chosen, ["doc", "mark"], "left_semi")
    first = kept.withColumn("n", F.row_number().over(Window.partitionBy("doc", "mark").orderBy("mark"))).where(F.col("n") == 1)
    return first.select("row.*")
