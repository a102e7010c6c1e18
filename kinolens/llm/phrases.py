"""Phrases whose words stand together more often than by chance.

Texts become *blocks*: some megabytes of documents as one sequence of units,
with a gap wherever a phrase can't go on. Units are words first. Of the units
that are frequent in all blocks, each gets its rank by frequency as id, and
every block counts its pairs of neighbouring units in tiles of that ranking:
the tiles of frequent units directly addressed by ``bincount``, the others as
sorted coordinates. Spark adds up the blocks' counts. The frequent pairs are
ranked again and are the units of the next round, whose neighbours overlap in
all but one word, so a pair of them is a phrase of one more word. Every part of
a frequent phrase is frequent, so none is lost.

Blocks and frequent pairs meet by tile, and what a block learns of its units
goes to it by the block's number, so nothing that grows with the vocabulary is
broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinolens.llm.common import LOWER, blocks, byte_set, discard, stored, word_spans
from kinolens.operators.ranking import top_k_by

BLOCK_BYTES = 4 << 20
#: Units of a block; a longer text is cut at its gaps.
BLOCK_UNITS = 1 << 20
#: A tile has TILE x TILE pairs.
TILE = 2048
#: A tile with a pair for so many of its cells is counted by direct address.
DENSE = 32
GAP = -1

_BREAK = byte_set(lambda b: b in b".,;:!?" or 0x0A <= b <= 0x0D)
_WORD = byte_set(lambda b: b not in b".,;:!? \t" and not 0x0A <= b <= 0x0D)

#: Bits for the right half of a tile's name.
SIDE = 31
#: Blocks whose rows of one tile are looked up in one group; a tile of more blocks is split.
SLICE_BLOCKS = 256
#: Partitions of the texts whose blocks stand in one list of a word; a power of two.
PART_SPAN = 256
#: Pairs that a task holds while it adds up blocks.
HELD_PAIRS = 1 << 22

WORDS = "block long, seq binary, lang string, word string, local int, n long"
PAIRS = "block long, seq binary, tile long, first int, cells binary, counts binary"


# ---- within a block ----


def word_sequence(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Lower-cased words of a block's texts, the document of each, and whether a gap follows it."""
    data = LOWER[data]
    doc, starts, ends = word_spans(data, offsets, _WORD)
    sizes = ends - starts
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(data[np.flatnonzero(_WORD[data])])).dictionary_encode()
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data], dtype=np.int32)])
    gap = np.ones(len(starts), bool)
    gap[:-1] = (doc[1:] != doc[:-1]) | (breaks[starts[1:]] != breaks[ends[:-1]])
    return words, doc, gap


def stretches(seq: np.ndarray, most: int = BLOCK_UNITS) -> Iterator[np.ndarray]:
    """Cut a sequence at gaps into stretches of about ``most`` units."""
    while len(seq) > most:
        gaps = np.flatnonzero(seq[:most] == GAP)
        at = int(gaps[-1]) if len(gaps) else most + int(np.argmax(seq[most:] == GAP))
        if seq[at] != GAP:
            break
        yield seq[: at + 1]
        seq = seq[at + 1 :]
    yield seq


def tiled_pairs(seq: np.ndarray, tile: int = TILE, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Count neighbours in a sequence of ranks, ``GAP`` between stretches.

    Returns the tiles that have pairs, the number of the first pair of each (one
    more: the end), the cells of all pairs by tile, their counts, and for each
    place the number of the pair that starts there, or ``GAP``. Pair (x, y) lies
    in the tile of its quotients by ``tile`` and the cell of its remainders.
    """
    left, right = seq[:-1].astype(np.int64), seq[1:].astype(np.int64)
    places = np.flatnonzero((left >= 0) & (right >= 0))
    left, right = left[places], right[places]
    number = np.full(len(seq), GAP, np.int32)
    tiles = (left // tile << SIDE) | right // tile
    cells = left % tile * tile + right % tile
    names, inverse, sizes = np.unique(tiles, return_inverse=True, return_counts=True)
    heavy = np.flatnonzero(sizes * dense >= tile * tile)
    rest = np.ones(len(places), bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    known = 0
    for t in heavy.tolist():
        here = np.flatnonzero(inverse == t)
        rest[here] = False
        n = np.bincount(cells[here], minlength=tile * tile)
        used = np.flatnonzero(n)
        number_of = np.zeros(tile * tile, np.int32)
        number_of[used] = np.arange(known, known + len(used))
        number[places[here]] = number_of[cells[here]]
        found.append((np.full(len(used), t), used, n[used]))
        known += len(used)
    here = np.flatnonzero(rest)
    if len(here):
        # Sorted coordinates of all sparse tiles.
        used, place, n = np.unique(inverse[here] * (tile * tile) + cells[here], return_inverse=True, return_counts=True)
        number[places[here]] = place + known
        found.append((used // (tile * tile), used % (tile * tile), n))
    of, cell, n = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return names[of[first]], np.append(first, len(of)), cell, n, number


def without_double_gaps(seq: np.ndarray) -> np.ndarray:
    keep = seq != GAP
    keep[1:] |= seq[:-1] != GAP
    return seq[keep]


def _squeezed(seq: np.ndarray) -> bytes:
    """A sequence compressed, its bytes by their place within a number: high ones are mostly alike."""
    planes = seq.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _released(data: bytes) -> np.ndarray:
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _rows(block: int, seq: np.ndarray | None, parts: dict[str, pa.Array]) -> pa.Table:
    """One row with a block's sequence (unless it is not needed), then the rows of its units."""
    n, head = len(next(iter(parts.values()))), int(seq is not None)
    columns = {
        "block": pa.array(np.full(n + head, block), pa.int64()),
        "seq": pa.array(([_squeezed(seq)] if head else []) + [None] * n, pa.binary()),
    }
    for name, values in parts.items():
        columns[name] = pa.concat_arrays([pa.nulls(head, values.type), values])
    return pa.table(columns)


def _packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Stretches of 32-bit numbers as binary values."""
    data = values.astype("<u4")
    return pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * 4).astype(np.int32)), pa.py_buffer(data)])


def _unpacked(column, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of binary values, and how many each value has."""
    values = [np.frombuffer(v, kind) for v in column.to_pylist()]
    return np.concatenate(values) if values else np.zeros(0, kind), np.array([len(v) for v in values], np.int64)


# ---- over all blocks ----


def word_blocks(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Sequences and words of all blocks: rows (block, seq) and rows (block, local, n, lang, word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for first, data, offsets in blocks(batch.column("text"), BLOCK_BYTES):
                words, doc, gap = word_sequence(data, offsets)
                if not len(doc):
                    continue
                n_words = len(words.dictionary)
                # A unit is a word of a language.
                unit = langs.indices.to_numpy()[first + doc].astype(np.int64) * n_words + words.indices.to_numpy()
                spread = np.arange(len(unit)) + np.concatenate([[0], np.cumsum(gap[:-1])])
                seq = np.full(len(unit) + int(gap.sum()), GAP, np.int64)
                seq[spread] = unit
                for part in stretches(seq):
                    units, inverse, counts = np.unique(part, return_inverse=True, return_counts=True)
                    if units[0] == GAP:
                        units, inverse, counts = units[1:], inverse - 1, counts[1:]
                    if not len(units):
                        continue
                    names = {
                        "lang": langs.dictionary.take(pa.array(units // n_words)),
                        "word": words.dictionary.take(pa.array(units % n_words)),
                        "local": pa.array(np.arange(len(units)), pa.int32()),
                        "n": pa.array(counts, pa.int64()),
                    }
                    yield from _rows((pid << 32) + number, inverse, names).combine_chunks().to_batches()
                    number += 1

    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, WORDS)


def next_blocks(held: DataFrame, known: DataFrame, last: bool) -> DataFrame:
    """Blocks of one more word: rows (block, seq) and rows (block, tile, first, cells, counts).

    ``known`` has (of, locals, ids): a block's units that are frequent, packed.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = None
        if left.num_rows and right.num_rows:
            local, _ = _unpacked(right.column("locals"), "<u4")
            ids, _ = _unpacked(right.column("ids"), "<i8")
            seq = _released(left.column("seq")[0].as_py())
            rank = np.full(max(int(local.max()), int(seq.max())) + 2, GAP, np.int64)
            rank[local] = ids
            tiles, edges, cells, counts, number = tiled_pairs(rank[seq])  # a gap is the last, empty place
            if len(tiles):
                parts = {"tile": pa.array(tiles, pa.int64()), "first": pa.array(edges[:-1], pa.int32()), "cells": _packed(cells, edges), "counts": _packed(counts, edges)}
                out = _rows(left.column("block")[0].as_py(), None if last else without_double_gaps(number), parts)
        kinds = [("block", pa.int64()), ("seq", pa.binary()), ("tile", pa.int64()), ("first", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())]
        return out if out is not None else pa.schema(kinds).empty_table()

    sequences = held.where("seq is not null").select("block", "seq")
    return sequences.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(run, PAIRS)


def known_words(held: DataFrame, words: DataFrame) -> DataFrame:
    """(of, locals, ids) of the frequent words of each block, one row per block.

    The blocks of a word are gathered before it meets the frequent words, so
    the join has a row per word and not one per word and block. A list holds the
    blocks of PART_SPAN partitions at most, whatever the input.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # From lists of blocks by word to lists of words by block.
        for batch in batches:
            at = batch.column("at")
            both = at.flatten()
            block, local = both.field("block").to_numpy(), both.field("local").to_numpy()
            ids = np.repeat(batch.column("id").to_numpy(), pa.compute.list_value_length(at).to_numpy())
            order = np.argsort(block, kind="stable")
            edges = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[order][edges[:-1]]), _packed(local[order], edges), pa.BinaryArray.from_buffers(
                    pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * 8).astype(np.int32)), pa.py_buffer(ids[order].astype("<i8"))]
                )], ["of", "locals", "ids"],
            )

    def gathered(table: pa.Table) -> pa.Table:
        both = [pa.array([b"".join(table.column(c).to_pylist())], pa.binary()) for c in ("locals", "ids")]
        return pa.table([table.column("of").slice(0, 1), *both], names=["of", "locals", "ids"])

    units = held.where("seq is null").select("block", "local", "lang", "word").repartition("lang", "word")
    span = F.shiftright("block", 32 + PART_SPAN.bit_length() - 1)
    lists = units.groupBy("lang", "word", span.alias("span")).agg(F.collect_list(F.struct("block", "local")).alias("at"))
    known = lists.join(words.select("id", "lang", "word").hint("shuffle_hash"), ["lang", "word"]).select("id", "at")
    kind = "of long, locals binary, ids binary"
    return known.mapInArrow(spread, kind).groupBy("of").applyInArrow(gathered, kind)


def tile_counts(held: DataFrame) -> DataFrame:
    """(tile, cell, f): the counts of all blocks. Tasks add up their own blocks first, then Spark adds up the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(keys, counts):
            keys, counts = np.concatenate(keys), np.concatenate(counts)
            tiles, of = np.unique(keys[:, 0], return_inverse=True)
            pair, place = np.unique(of * (TILE * TILE) + keys[:, 1], return_inverse=True)
            n = np.zeros(len(pair), np.int64)
            np.add.at(n, place, counts)
            for at in range(0, len(pair), 1 << 17):
                some = pair[at : at + (1 << 17)]
                columns = [pa.array(tiles[some // (TILE * TILE)]), pa.array((some % (TILE * TILE)).astype(np.int32)), pa.array(n[at : at + (1 << 17)])]
                yield pa.RecordBatch.from_arrays(columns, ["tile", "cell", "n"])

        keys, counts, size = [], [], 0
        for batch in batches:
            cells, sizes = _unpacked(batch.column("cells"), "<u4")
            keys.append(np.column_stack([np.repeat(batch.column("tile").to_numpy(), sizes), cells.astype(np.int64)]))
            counts.append(_unpacked(batch.column("counts"), "<u4")[0].astype(np.int64))
            size += len(cells)
            if size >= HELD_PAIRS:
                yield from added(keys, counts)
                keys, counts, size = [], [], 0
        if size:
            yield from added(keys, counts)

    rows = held.where("seq is null").select("tile", "cells", "counts").mapInArrow(run, "tile long, cell int, n long")
    return rows.groupBy("tile", "cell").agg(F.sum("n").alias("f"))


def known_pairs(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """(of, locals, ids) of the frequent pairs of each block.

    Blocks meet the frequent pairs by tile. A tile that many blocks have is
    split by block, and its frequent pairs go to every part.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = pa.schema([("of", pa.int64()), ("locals", pa.binary()), ("ids", pa.binary())])
        if not left.num_rows or not right.num_rows:
            return kinds.empty_table()
        cell, ids = right.column("cell").to_numpy(), right.column("id").to_numpy()
        order = np.argsort(cell)
        cell, ids = cell[order], ids[order]
        cells, sizes = _unpacked(left.column("cells"), "<u4")
        local = np.arange(len(cells)) + np.repeat(left.column("first").to_numpy() - (np.cumsum(sizes) - sizes), sizes)
        at = np.minimum(np.searchsorted(cell, cells), len(cell) - 1)
        found = np.flatnonzero(cell[at] == cells)
        row = np.repeat(np.arange(len(sizes)), sizes)[found]
        edges = np.searchsorted(row, np.arange(len(sizes) + 1))
        packed_ids = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((edges * 8).astype(np.int32)), pa.py_buffer(ids[at[found]].astype("<i8"))])
        out = pa.table([left.column("block"), pa.chunked_array([_packed(local[found], edges)]), pa.chunked_array([packed_ids])], kinds)
        return out.filter(pa.array(np.diff(edges) > 0))

    units = held.where("seq is null").select("block", "tile", "first", "cells")
    sizes = units.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / SLICE_BLOCKS).cast("int").alias("slices")).where("slices > 1")
    sizes = stored(sizes, "split-tiles")
    left = units.join(sizes, "tile", "left").withColumn("slice", F.coalesce(F.pmod(F.xxhash64("block"), F.col("slices")), F.lit(0)).cast("int")).drop("slices")
    right = pairs.select("tile", "cell", "id").join(sizes, "tile", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))).drop("slices")
    return left.groupBy("tile", "slice").cogroup(right.groupBy("tile", "slice")).applyInArrow(run, "of long, locals binary, ids binary")


def numbered(df: DataFrame, order: list) -> DataFrame:
    """Stored with ``id``: the row's place in ``order``, from 0, without a window over all rows."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__row", F.monotonically_increasing_id())
    table = stored(placed, "ranked")
    part, place = F.shiftright("__row", 33), F.col("__row").bitwiseAND((1 << 33) - 1)
    sizes = table.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    # One row per partition.
    before = F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    out = table.withColumn("__part", part).join(starts, "__part").withColumn("id", F.col("__start") + place)
    return stored(out.drop("__part", "__row", "__start"), "numbered")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the frequent phrases of 1, 2, ... ``longest`` words, and (lang, n): all words of each language.

    Columns: id (rank by frequency), lang, words, f, and ``firsts`` and
    ``lasts``: how often the phrase's first and last 1, 2, ... words occur; from
    two words on also a and b, the ids of all but its last and its first word
    one level below. A null language is ``und``, a null text is empty. The list ends with the first table that has no
    rows; without any words it holds one empty table.
    """
    held = stored(word_blocks(docs, text, lang), "phrase-blocks", codec="zstd")
    totals = stored(held.where("seq is null").groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    counts = held.where("seq is null").groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    once = F.array("f")
    words = stored(counts.select("lang", "word", "f"), "frequent").select("lang", F.array("word").alias("words"), "word", "f", once.alias("firsts"), once.alias("lasts"))
    levels = [numbered(words, [F.desc("f"), "lang", "word"])]
    known = stored(known_words(held, levels[0]), "known-units", codec="zstd")
    # The words themselves have done their work; only the sequences go on.
    sequences = stored(held.where("seq is not null").select("block", "seq"), "phrase-blocks", codec="zstd")
    discard(held)
    held = sequences
    for size in range(2, longest + 1):
        below = levels[-1]
        if below.isEmpty():
            break
        grown = stored(next_blocks(held, known, last=size == longest), "phrase-blocks", codec="zstd")
        discard(held)
        discard(known)
        held = grown
        a, b = (F.shiftright("tile", SIDE) * TILE + F.floor(F.col("cell") / TILE)), F.col("tile").bitwiseAND((1 << SIDE) - 1) * TILE + F.col("cell") % TILE
        pairs = stored(tile_counts(held).where(F.col("f") >= least).select("tile", "cell", a.alias("a"), b.alias("b"), "f"), "frequent")
        head = below.select(F.col("id").alias("a"), "lang", F.col("words").alias("__words"), F.col("firsts").alias("__firsts"))
        tail = below.select(F.col("id").alias("b"), F.element_at("words", -1).alias("__word"), F.col("lasts").alias("__lasts"))
        longer = pairs.join(head, "a").join(tail, "b").select(
            "tile", "cell", "a", "b", "lang", F.concat("__words", F.array("__word")).alias("words"), "f",
            F.concat("__firsts", F.array("f")).alias("firsts"), F.concat("__lasts", F.array("f")).alias("lasts"),
        )
        levels.append(numbered(longer, [F.desc("f"), "a", "b"]))
        known = stored(known_pairs(held, levels[-1]), "known-units", codec="zstd")
    discard(held)
    discard(known)
    return levels, totals


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, keep: int = 2000, share: int = 100,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``keep`` best phrases.

    A phrase of 2 to ``longest`` words that occurs a >= ``least`` times scores
    floor(1000 * a * n / (l * r)) for a cut into its first and its other words,
    which occur l and r times among n words; its lowest cut counts, and the
    first of those. Phrases within a longer one that occurs at least ``share``
    percent as often are left out: as counts never grow with length, only
    phrases of one more word need be looked at. Other columns are not read;
    repeated rows count as often as they stand there.
    """
    levels, totals = frequent_phrases(docs, text, lang, least, longest)
    found = None
    for i, level in enumerate(levels[1:], 1):
        kept = level
        if i + 1 < len(levels):
            longer = levels[i + 1].select(F.explode(F.array("a", "b")).alias("id"), F.col("f").alias("__f")).groupBy("id").agg(F.max("__f").alias("__f"))
            kept = level.join(stored(longer, "longer"), "id", "left").where("__f is null or 100 * __f < cast(%d as decimal(5,0)) * f" % share)
        rows = kept.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "firsts", "lasts")
        found = rows if found is None else found.union(rows)
    if found is None:
        return levels[0].select("lang", F.lit(1).cast("long").alias("rank"), F.lit("").alias("phrase"), *[F.lit(0).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]).limit(0)
    size = F.size("firsts")
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(k.alias("k"), F.element_at("firsts", k).alias("l"), F.element_at("lasts", size - k).alias("r")))
    exact = lambda c: c.cast("decimal(38,0)")  # noqa: E731  products of three counts pass 64 bits
    scored = F.expr("transform(cuts, c -> struct(cast(1000 as decimal(38,0)) * a * n div (cast(c.l as decimal(38,0)) * c.r) as score, c.k as k, c.l as l, c.r as r))")
    best = found.join(totals, "lang").withColumn("cuts", cuts).withColumn("cut", F.array_min(scored))
    rows = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    top = top_k_by(stored(rows, "scored-phrases"), "lang", [F.desc("score"), F.desc("a"), "phrase"], keep, rank="rank")
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
