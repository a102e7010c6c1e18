"""Near copies by the exact similarity of their five-word shingles.

Two texts are near copies when their sets of shingles have a Jaccard similarity
of ``SIMILARITY`` or more. Such sets must share a shingle among the first
``n - ceil(SIMILARITY * n) + 1`` of each in any order that is common to all, so
lists of those prefixes hold every pair. The order here is rare before frequent:
shingles are counted, and the most frequent (at most ``FREQUENT``, in tasks as
one sorted array) come last, by their counts. Any order gives the same result;
this one keeps passages that many texts share out of the prefixes.

The first shingle that two sets share stands at places i and j, so they share at
most ``min(n - i, m - j)``. This bounds the sizes of partners from above, as the
similarity does from below. Short lists make the pairs within those bounds. A
list longer than ``LIST_LENGTH`` is split by size classes, and a class that is
still longer works in rounds: all members are compared with one of them, the
leader. 1 - similarity is a metric, so a member at distance y from the leader,
linked to it, is done when no unlinked member is within y + (1 - SIMILARITY):
whatever it could be linked to is in the leader's group already. The leader
itself is done too. A group of thousands of copies thus makes one comparison per
member. After ``ROUNDS`` rounds the links so far are joined to groups, and what
is left of the lists is compared in pairs of different groups, so no link that
joins two groups is lost.

Pairs are verified by their whole sets, which are built only for texts that are
in a shared list and kept in ``SLICES`` ranges of hashes. What two sets share is
the sum over the ranges, so pairs meet one range at a time and only that range
is shuffled. Where the distance of unlinked pairs is not needed, a pair leaves as
soon as the ranges ahead can't make it similar enough. Texts with equal sets are
one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import BLOCK_BYTES, LOWER, NOT_SPACE, blocks, discard, keyed, mix, stored, word_hashes, word_spans
from kinolens.llm.components import components
from kinolens.llm.repeats import rolling
from kinolens.llm.simhash import first_rows

SHINGLE = 5
SIMILARITY = 0.8
LIST_LENGTH = 32
#: Most shingles that are ordered by their counts; 16 bytes each in a task.
FREQUENT = 1 << 20
#: Last bits of a hash that are left out where shingles are counted.
CUT = 20
_CUT = np.uint64(CUT)
#: Ratio of neighbouring size classes.
CLASS = 1.02
#: Rounds with leaders; then only pairs of two groups that are not linked yet are compared.
ROUNDS = 3
#: Ranges of hashes that whole sets are compared in, one after the other.
SLICES = 4
SLICE_NAMES = [f"s{k}" for k in range(SLICES)]


def shingle_sets(column, length: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text as ascending hashes; all words of a shorter text are one shingle."""
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(column)
    for first, data, offsets in blocks(column):
        data = LOWER[data]
        doc, starts, ends = word_spans(data, offsets, NOT_SPACE)
        words = word_hashes(data, starts, ends)
        heads = np.searchsorted(doc, np.arange(len(offsets)))
        long = mix(rolling(words, length)) if len(words) >= length else words[:0]
        for i in range(len(offsets) - 1):
            a, b = int(heads[i]), int(heads[i + 1])
            if b - a >= length:
                out[first + i] = np.unique(long[a : b - length + 1])
            elif b > a:
                out[first + i] = mix(rolling(words[a:b], b - a))
    return out


def prefix_length(n: int, similarity: float = SIMILARITY) -> int:
    """How many of a set's first shingles hold one of every set that is similar enough."""
    return n - int(np.ceil(similarity * n - 1e-9)) + 1 if n else 0


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)))


def _node(shingles: np.ndarray) -> int:
    """A hash of a whole set: a sum over spread values, which keeps 64 bits."""
    return int((mix(shingles + np.uint64(0x51ED2701)).sum(dtype=np.uint64) + np.uint64(len(shingles))).view(np.int64)) if len(shingles) else 0


def _parts(batch: pa.RecordBatch, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text: the sets of a whole batch are several times its text."""
    for first, _, offsets in blocks(batch.column("text"), size):
        yield batch.slice(first, len(offsets) - 1)


def _nodes(length: int):
    def run(batches):
        for batch in batches:
            for part in _parts(batch):
                sets = shingle_sets(part.column("text"), length)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("mark"), pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32())],
                    ["doc", "mark", "node", "n"],
                )

    return run


def _whole(length: int):
    """node, n, and the shingles of each range of hashes in a column of their own."""
    inner = np.array([(k << 64) // SLICES for k in range(1, SLICES)], np.uint64)

    def run(batches):
        for batch in batches:
            for part in _parts(batch):
                sets = shingle_sets(part.column("text"), length)
                cut = [np.split(s, np.searchsorted(s, inner)) for s in sets]
                ranges = [_lists([c[k] for c in cut]) for k in range(SLICES)]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([len(s) for s in sets], pa.int32()), *ranges], ["node", "n", *SLICE_NAMES])

    return run


def _prefixes(length: int, similarity: float, values: np.ndarray, ranks: np.ndarray):
    """node, n, prefix: the shingles outside ``values`` by hash, then those of ``values`` by rank, cut to the prefix."""

    def run(batches):
        for batch in batches:
            for part in _parts(batch):
                sets = [s for s in shingle_sets(part.column("text"), length) if len(s)]
                out = []
                for s in sets:
                    key = s >> _CUT
                    at = np.minimum(np.searchsorted(values, key), max(0, len(values) - 1))
                    often = values[at] == key if len(values) else np.zeros(len(s), bool)
                    ordered = np.concatenate([s[~often], s[often][np.argsort(ranks[at[often]], kind="stable")]]) if often.any() else s
                    out.append(ordered[: prefix_length(len(s), similarity)])
                yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), _lists(out)], ["node", "n", "prefix"])

    return run


def _dealt(length: int):
    """slot, low: the shingles of some texts by their first bits, of each the next 32 bits."""

    def run(batches):
        for batch in batches:
            for part in _parts(batch, 4 * BLOCK_BYTES):
                key = np.sort(np.concatenate([np.zeros(0, np.uint64), *shingle_sets(part.column("text"), length)])) >> _CUT
                slot = (key >> np.uint64(32)).astype(np.int64)
                first = np.flatnonzero(np.concatenate([[True], np.diff(slot) != 0])) if len(slot) else slot
                edges = np.append(first, len(slot)).astype(np.int32) * 4
                low = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(edges), pa.py_buffer(key.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([pa.array(slot[first], pa.int32()), low], ["slot", "low"])

    return run


def _counted(least: int):
    def run(group: pa.Table) -> pa.Table:
        low = np.frombuffer(b"".join(group.column("low").to_pylist()), "<u4")
        low, c = np.unique(low, return_counts=True)
        often = c > least
        s = (np.int64(group.column("slot")[0].as_py()) << np.int64(32)) + low[often].astype(np.int64)
        return pa.table([pa.array(s, pa.int64()), pa.array(c[often], pa.int64())], ["s", "c"])

    return run


def frequent(texts: DataFrame, length: int = SHINGLE, least: int = LIST_LENGTH, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """First bits of hashes, ascending, and ranks by count of the shingles that stand more than ``least`` times; at most ``most``.

    All shingles are counted, by the first ``64 - CUT`` bits of their hashes,
    which also order them; four bytes each are shuffled. The least count is
    raised by powers of two until no more than ``most`` are left, so only a
    histogram of a few rows and the shingles wanted reach the driver.
    """
    dealt = texts.select("text").mapInArrow(_dealt(length), "slot int, low binary")
    counts = stored(dealt.groupBy("slot").applyInArrow(_counted(least), "s bigint, c bigint"), "near-frequent")
    sizes = {r.p: r.k for r in counts.groupBy(F.floor(F.log2("c")).alias("p")).agg(F.count(F.lit(1)).alias("k")).collect()}
    power, total = max(sizes, default=0) + 1, 0
    while power > 0 and total + sizes.get(power - 1, 0) <= most:
        power -= 1
        total += sizes.get(power, 0)
    rows = counts.where(F.col("c") >= 2**power).toPandas()
    discard(counts)
    values, c = rows["s"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64)
    by_value = np.argsort(values)
    values, c = values[by_value], c[by_value]
    ranks = np.empty(len(c), np.int64)
    ranks[np.lexsort((values, c))] = np.arange(len(c))
    return values, ranks


def _pairs(members: DataFrame) -> DataFrame:
    """(a, b): pairs of members of a list whose sizes and places allow the similarity; a is the larger set.

    Where members have a group that is ``known``, only pairs of two groups.
    """
    group = F.col("known") if "known" in members.columns else F.col("node")
    left = members.where("least <= most").select("list", F.col("node").alias("a"), F.col("n").alias("na"), "least", "most", group.alias("ga"))
    right = members.select("list", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("most").alias("up"), group.alias("gb"))
    allowed = F.col("nb").between(F.col("least"), F.col("most")) & ((F.col("nb") < F.col("na")) | (F.col("a") < F.col("b")))
    # the smaller set must be able to hold the larger one's share as well
    return left.join(right, "list").where(allowed & (F.col("na") <= F.col("up")) & (F.col("ga") != F.col("gb"))).select("a", "b").distinct()


def _compared(pairs: DataFrame, sets: DataFrame, similarity: float, exact: bool = True) -> DataFrame:
    """(a, b, far, linked): distance of each pair, and whether it is similar enough; if not ``exact``, only linked pairs."""
    judged, before = pairs.select("a", "b", *[F.lit(0).alias(c) for c in ("common", "seen_a", "seen_b")]), None
    for name in SLICE_NAMES:
        sides = [sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col(name).alias(f"s{x}")) for x in "ab"]
        both = judged.join(sides[0], "a").join(sides[1], "b")
        common = F.col("common") + F.size(F.array_intersect("sa", "sb"))
        both = both.select("a", "b", "na", "nb", common.alias("common"), *[(F.col(f"seen_{x}") + F.size(f"s{x}")).alias(f"seen_{x}") for x in "ab"])
        if not exact:
            most = F.col("common") + F.least(F.col("na") - F.col("seen_a"), F.col("nb") - F.col("seen_b"))
            both = both.where(_similar(most, F.col("na") + F.col("nb") - most, similarity))
        judged = stored(both.drop("na", "nb"), "near-compared")
        if before is not None:
            discard(before)
        before = judged
    union = F.col("seen_a") + F.col("seen_b") - F.col("common")
    return judged.select("a", "b", (1 - F.col("common") / union).alias("far"), _similar(F.col("common"), union, similarity).alias("linked"))


def _similar(common, union, similarity: float):
    return common >= similarity * union - 1e-9


def _postings(prefixes: DataFrame, similarity: float) -> DataFrame:
    """(list, node, n, least, most): the members of all lists, with the sizes that a partner may have.

    Sets of n and m that share c are similar enough from c = (n + m) * s / (1 + s)
    on, and c is at most n less the place of their first shared shingle.
    """
    rows = prefixes.select("node", "n", F.posexplode("prefix").alias("i", "list"))
    shares = (1 + similarity) / similarity
    most = F.floor((F.col("n") - F.col("i")) * shares - F.col("n") + 1e-9)
    return rows.select("list", "node", "n", F.ceil(F.col("n") * similarity - 1e-9).alias("least"), most.alias("most"))


def _classes(long: DataFrame) -> DataFrame:
    """Long lists split by size class: a member is in the class of its size and in those of smaller partners."""
    level = lambda n: F.floor(F.log(n.cast("double")) / F.log(F.lit(CLASS))).cast("int")
    home = level(F.col("n"))
    top = F.least(F.col("most"), F.col("n").cast("long"))
    looks = F.when(F.col("least") <= top, F.sequence(level(F.col("least")), level(F.greatest(top, F.col("least"))))).otherwise(F.array().cast("array<int>"))
    spread = long.select("*", home.alias("home"), looks.alias("looks"))
    spread = spread.select("list", "node", "n", "least", "most", "home", F.explode(F.array_union("looks", F.array("home"))).alias("class"), "looks")
    spread = spread.select("list", "class", "node", "n", "least", "most", (F.col("class") == F.col("home")).alias("lives"), F.array_contains("looks", F.col("class")).alias("looks"))
    spread = stored(spread, "near-classes")
    useful = spread.groupBy("list", "class").agg(F.count(F.lit(1)).alias("size"), F.max("lives").alias("some"), F.max("looks").alias("seen")).where("size > 1 and some and seen")
    split = spread.join(useful.select("list", "class", "size"), ["list", "class"])
    return stored(split.select(F.xxhash64("list", "class").alias("list"), "node", "n", "least", "most", "size"), "near-split")


def near_copy_links(rows: DataFrame, texts: DataFrame, length: int = SHINGLE, similarity: float = SIMILARITY, list_length: int = LIST_LENGTH, rounds: int = ROUNDS) -> DataFrame:
    """(a, b): links between similar nodes whose components are those of all of them."""
    values, ranks = frequent(texts, length, list_length)
    # Prefixes, not texts, are shuffled to leave one of each set.
    prefixes = texts.select("text").mapInArrow(_prefixes(length, similarity, values, ranks), "node bigint, n int, prefix array<bigint>")
    prefixes = stored(prefixes.dropDuplicates(["node"]), "near-prefixes")
    postings = _postings(prefixes, similarity)
    shared = stored(postings.groupBy("list").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-lists")
    members = stored(postings.join(shared, "list"), "near-members")
    discard(prefixes)
    discard(shared)
    short = members.where(F.col("size") <= list_length).drop("size")
    split = _classes(members.where(F.col("size") > list_length).drop("size"))
    asked = members.select("node").distinct()
    chosen = rows.join(asked, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc", "mark")).alias("r")).select("r.doc", "r.mark", "node")
    own = texts.join(stored(chosen, "near-chosen"), ["doc", "mark"]).dropDuplicates(["doc", "mark"])
    columns = ", ".join(f"{name} array<bigint>" for name in SLICE_NAMES)
    sets = stored(own.select("node", "text").mapInArrow(_whole(length), f"node bigint, n int, {columns}"), "near-sets")

    pairs = stored(_pairs(short).union(_pairs(split.where(F.col("size") <= list_length).drop("size"))).distinct(), "near-pairs")
    discard(members)
    links = stored(_compared(pairs, sets, similarity, exact=False).where("linked").select("a", "b"), "near-links")
    discard(pairs)
    rest = split.where(F.col("size") > list_length).drop("size")
    for turn in range(rounds):
        if rest.isEmpty():
            return links
        heads = rest.groupBy("list").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node")).alias("m")).select("list", F.col("m.node").alias("b"))
        led = rest.join(heads, "list").where("node != b")
        judged = stored(_compared(led.select(F.col("node").alias("a"), "b").distinct(), sets, similarity), "near-judged")
        links = links.union(judged.where("linked").select("a", "b"))
        led = stored(led.join(judged.withColumnRenamed("a", "node"), ["node", "b"]).drop("b"), "near-distances")
        ring = led.groupBy("list").agg(F.min(F.when(~F.col("linked"), F.col("far"))).alias("ring"))
        # 1e-6 above the sum of distances: rounding must not settle a member too early
        done = F.col("linked") & (F.col("ring").isNull() | (F.col("far") + (1 - similarity) + 1e-6 < F.col("ring")))
        rest = stored(led.join(ring, "list").where(~done).drop("far", "linked", "ring"), "near-rest")
    if rest.isEmpty():
        return links
    links = stored(links.distinct(), "near-links")
    roots = components(links).withColumnRenamed("root", "known")
    rest = stored(rest.join(roots, "node", "left").withColumn("known", F.coalesce("known", "node")), "near-rest")
    several = rest.groupBy("list").agg((F.min("known") != F.max("known")).alias("several")).where("several").select("list")
    last = stored(_pairs(rest.join(several, "list")), "near-last")
    return links.union(_compared(last, sets, similarity, exact=False).where("linked").select("a", "b"))


def keep_first_copy(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = SHINGLE, similarity: float = SIMILARITY, list_length: int = LIST_LENGTH
) -> DataFrame:
    """One row of ``docs`` per group of near copies, all columns as they are: that with the smallest id.

    Rows without an id come last. Texts without words are one group. Of rows
    that repeat an id and a text, any one stays.
    """
    texts = keyed(docs, key, text)
    rows = stored(texts.mapInArrow(_nodes(length), "doc bigint, mark bigint, node bigint, n int"), "near-rows")
    found = components(near_copy_links(rows, texts, length, similarity, list_length))
    placed = rows.select("doc", "mark", "node").join(found, "node", "left")
    return first_rows(docs, placed.select("doc", "mark", F.coalesce("root", "node").alias("root")), key, text)
