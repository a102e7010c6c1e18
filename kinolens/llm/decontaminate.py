"""Benchmark decontamination with a generalised suffix automaton over words.

The normalised test items are turned into word numbers and put into one suffix
automaton. Training texts are streamed through it: the state and the length of
the longest match that ends at each word are tracked, so a word belongs to a
copied passage when a match of at least a window's length covers it. Stretches
of a text whose words are all known to the benchmark and that are at least as
long as the shortest window are found with array operations first; the
automaton only has to read those, since a match cannot leave such a stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import LETTERS, LOWER, ROWS_OUT, blocks, stored, word_hashes, word_spans

WINDOW = 13
#: Words of the items that one automaton holds; more items go into further automata, one pass each.
BLOCK_WORDS = 200_000


class ItemAutomaton:
    """Suffix automaton of the word sequences of items."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = pa.array([t for _, t in items], pa.large_string())
        sequences: list[list[int]] = [[] for _ in items]
        known: dict[int, int] = {}
        for first, data, offsets in blocks(texts):
            data = LOWER[data]
            doc, starts, ends = word_spans(data, offsets, LETTERS)
            raw = data.tobytes()
            for d, s, e, h in zip(doc.tolist(), starts.tolist(), ends.tolist(), word_hashes(data, starts, ends).tolist(), strict=True):
                sequences[first + d].append(self.vocabulary.setdefault(raw[s:e], len(self.vocabulary)))
                known[h] = 1
        self.known = np.sort(np.fromiter(known, np.uint64, len(known)))
        sequences = [(name, words) for (name, _), words in zip(items, sequences, strict=True) if words]
        for _, words in sequences:
            state = 0
            for w in words:
                state = self.extend(state, w)
        self.names = [name for name, _ in sequences]
        self.shortest = min((min(window, len(words)) for _, words in sequences), default=window)
        #: Items by the state of a window, and (length, item) by the state of an item shorter than one.
        self.windows: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for number, (_, words) in enumerate(sequences):
            self.mark(words, number)

    def extend(self, last: int, word: int) -> int:
        """The state of the current item with one more word (generalised: it may exist already)."""
        if word in self.next[last]:
            return self.split(last, word)
        new = self.state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self.split(p, word)
        return new

    def split(self, p: int, word: int) -> int:
        """The target of an edge, cloned if it also stands for longer strings."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self.state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def holder(self, state: int, length: int) -> int:
        """The state that stands for the last ``length`` words of a match."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def mark(self, words: list[int], number: int) -> None:
        """Note an item at the states of its windows; a shorter item is one window."""
        state = 0
        for i, w in enumerate(words):
            state = self.next[state][w]
            if i + 1 >= self.window:
                self.windows.setdefault(self.holder(state, self.window), set()).add(number)
        if len(words) < self.window:
            self.short.setdefault(self.holder(state, len(words)), []).append((len(words), number))

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged (start, end) of the words covered by windows, and the items they belong to."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        state = length = 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if w not in self.next[state]:
                continue
            state, length = self.next[state][w], length + 1
            covered = 0
            if length >= self.window:
                covered = self.window
                items |= self.windows[self.holder(state, self.window)]
            p = state if self.short else 0
            while p > 0:
                for n, number in self.short.get(p, ()):
                    if n <= length:
                        covered = max(covered, n)
                        items.add(number)
                p = self.link[p]
            if covered:
                start = i + 1 - covered
                if spans and spans[-1][1] >= start:
                    start = min(spans.pop()[0], start)
                spans.append((start, i + 1))
        return spans, items


def item_blocks(benchmark: DataFrame, item: str, text: str, block_words: int) -> list[list[tuple[str, str]]]:
    """The benchmark in blocks of a bounded number of words (estimated by their bytes)."""
    rows = benchmark.where(F.col(text).isNotNull()).select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-total // (4 * block_words)))
    if n == 1:
        return [[(r.i, r.t) for r in rows.collect()]]
    spread = rows.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
    return [[(r.i, r.t) for r in spread.where(F.col("b") == k).collect()] for k in range(n)]


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, min_share: float = 0.05, carry: bool = False, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(key, n_words, n_hit, hits, items, contaminated) for every row of ``docs``.

    ``hits`` lists the (start, end) byte spans of the covered words, ``items``
    the items with a window in the text, sorted as strings. A text is
    contaminated when it has a hit and hits make up ``min_share`` of its words.
    With ``carry`` the rows keep all their columns as one struct ``row``.

    The benchmark is a stated query set: its items go to the tasks in blocks of
    ``block_words`` words, one narrow pass for each (stored in between, so a task
    holds one automaton), and the documents are never shuffled. Null texts have no words; an item without words has no window.
    Repeated rows and items count as often as they occur, an item once per id.
    """
    out, judge, schema = _judged(docs, benchmark, key, text, item, item_text, window, min_share, carry, block_words)
    return out.mapInArrow(judge, schema)


def _judged(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str, window: int, min_share: float, carry: bool, block_words: int):
    """Rows with the hits of all blocks but the last, the pass over the last block that sums up, and the columns that pass makes."""
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(
        F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text"), *row,
        F.expr("cast(array() as array<struct<s:int,e:int,a:int,b:int>>)").alias("__hits"), F.expr("cast(array() as array<string>)").alias("__items"),
    )
    *others, last = item_blocks(benchmark, item, item_text, block_words)
    for block in others:
        out = stored(out.mapInArrow(_scanner(block, window), out.schema), "hits")
    scan, sum_up = _scanner(last, window), _summary(min_share)
    tail = f", row {out.schema['row'].dataType.simpleString()}" if carry else ""
    schema = f"`{key}` {kind}, n_words bigint, n_hit bigint, hits array<struct<start:int,end:int>>, items array<string>, contaminated boolean{tail}"
    return out, lambda batches: sum_up(scan(batches)), schema


def _scanner(items: list[tuple[str, str]], window: int):
    def run(batches):
        automaton = ItemAutomaton(items, window)
        for batch in batches:
            hits, found = batch.column("__hits").to_pylist(), batch.column("__items").to_pylist()
            for first, data, offsets in blocks(batch.column("__text")):
                data = LOWER[data]
                doc, starts, ends = word_spans(data, offsets, LETTERS)
                for d, i, j in known_stretches(automaton, data, doc, starts, ends):
                    raw = [data[s:e].tobytes() for s, e in zip(starts[i:j].tolist(), ends[i:j].tolist(), strict=True)]
                    spans, names = automaton.scan([automaton.vocabulary.get(w, -1) for w in raw])
                    if spans:
                        head = int(np.searchsorted(doc, d))
                        hits[first + d] += [
                            {"s": int(starts[i + a] - offsets[d]), "e": int(ends[i + b - 1] - offsets[d]), "a": i + a - head, "b": i + b - head}
                            for a, b in spans
                        ]
                        found[first + d] += [automaton.names[n] for n in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hits, batch.schema.field(c).type) if c == "__hits" else pa.array(found, batch.schema.field(c).type) if c == "__items" else batch.column(c) for c in batch.schema.names],
                schema=batch.schema,
            )

    return run


def known_stretches(automaton: ItemAutomaton, data, doc, starts, ends):
    """(document, first, last + 1) of runs of known words that could hold a window."""
    if not len(starts) or not len(automaton.known):
        return
    hashes = word_hashes(data, starts, ends)
    at = np.minimum(np.searchsorted(automaton.known, hashes), len(automaton.known) - 1)
    known = automaton.known[at] == hashes
    opens, closes = known.copy(), known.copy()
    same = doc[1:] == doc[:-1]
    opens[1:] &= ~(known[:-1] & same)
    closes[:-1] &= ~(known[1:] & same)
    i, j = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = j - i >= automaton.shortest
    yield from zip(doc[i[long]].tolist(), i[long].tolist(), j[long].tolist(), strict=True)


def _summary(min_share: float):
    def run(batches):
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            for first, data, offsets in blocks(batch.column("__text")):
                doc, _, _ = word_spans(LOWER[data], offsets, LETTERS)
                n_words[first : first + len(offsets) - 1] = np.bincount(doc, minlength=len(offsets) - 1)
            spans = [merged(h) for h in batch.column("__hits").to_pylist()]
            n_hit = np.array([sum(b - a for _, _, a, b in h) for h in spans], np.int64)
            columns = [
                batch.column(0), pa.array(n_words), pa.array(n_hit),
                pa.array([[{"start": s, "end": e} for s, e, _, _ in h] for h in spans], pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()}))),
                pa.array([sorted(set(x)) for x in batch.column("__items").to_pylist()], pa.list_(pa.string())),
                pa.array((n_hit > 0) & (n_hit >= min_share * n_words - 1e-9)),
            ]
            names = [batch.schema.names[0], "n_words", "n_hit", "hits", "items", "contaminated"]
            if "row" in batch.schema.names:
                columns, names = [*columns, batch.column("row")], [*names, "row"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def merged(hits: list[dict]) -> list[tuple[int, int, int, int]]:
    """Overlapping word spans of several automata joined: (byte start, byte end, first word, last word + 1)."""
    out: list[list[int]] = []
    for h in sorted(hits, key=lambda h: (h["a"], h["b"])):
        if out and h["a"] < out[-1][3]:
            if h["b"] > out[-1][3]:
                out[-1][1], out[-1][3] = h["e"], h["b"]
        else:
            out.append([h["s"], h["e"], h["a"], h["b"]])
    return [tuple(x) for x in out]


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, min_share: float = 0.05) -> DataFrame:
    """The rows of ``docs`` without contaminated ones; copied spans are cut from the text of the others.

    A cut span takes the bytes from its first to its last word. All other
    columns stay; ``n_chars``, if there is one, is counted anew for cut texts.
    """
    out, judge, _ = _judged(docs, benchmark, key, text, "item_id", "text", window, min_share, True, BLOCK_WORDS)
    at = docs.columns.index(text)

    # One map for judging and cutting: each further one would hold another Python worker per core.
    def run(batches):
        for batch in judge(batches):
            batch = batch.filter(pc.invert(batch.column("contaminated")))
            texts, hits = batch.column("row").field(at), batch.column("hits")
            for start in range(0, batch.num_rows, ROWS_OUT):
                cut = []
                for t, spans in zip(texts.slice(start, ROWS_OUT).to_pylist(), hits.slice(start, ROWS_OUT).to_pylist(), strict=True):
                    if t is not None and spans:
                        raw, end, kept = t.encode(), 0, []
                        for s in spans:
                            kept.append(raw[end : s["start"]])
                            end = s["end"]
                        t = b"".join([*kept, raw[end:]]).decode()
                    cut.append(t)
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(start, ROWS_OUT), pa.array(cut, pa.string())], ["row", "__new"])

    kept = out.mapInArrow(run, f"row {out.schema['row'].dataType.simpleString()}, __new string")
    columns = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == text:
            value = F.col("__new")
        elif c == "n_chars":
            value = F.when(F.col("__new").eqNullSafe(F.col(f"row.`{text}`")), value).otherwise(F.length("__new")).cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    return kept.select(*columns)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contaminated_spans(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )
