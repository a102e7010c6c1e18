"""Token counts that follow edits without counting a text anew.

A text is cut into pre-tokens, which merges never cross, so its count is the
sum of theirs. A segment tree over blocks of pre-tokens holds the characters
and tokens below each node. An edit finds the first pre-token that can change
(those that end just in front of the edit look ahead into it), cuts the text again from there until a cut falls on an old one behind the edit,
encodes only what lies between, and updates the sums on the way up.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 256
MEMO = 300_000
#: Characters behind its end that can decide where a pre-token ends ("'r" before "e", a run of spaces before a word).
AHEAD = 2


class PieceCounter:
    """Pre-tokens of a text and the number of tokens of each, by a rank file and a pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.memo: dict[str, int] = {}

    def counts(self, parts: list[str]) -> list[int]:
        found = list(map(self.memo.get, parts))
        if None in found:
            if len(self.memo) > MEMO:
                self.memo = {}
            found = [self.count(p) if n is None else n for p, n in zip(parts, found, strict=True)]
        return found

    def count(self, part: str) -> int:
        n = self.memo.get(part)
        if n is None:
            n = len(self.encoding._encode_single_piece(part))
            if len(part) <= 64:
                self.memo[part] = n
        return n


@cache
def counter(path: str, pattern: str) -> PieceCounter:
    """One counter per Python worker."""
    return PieceCounter(path, pattern)


class TokenTree:
    """Segment tree over the pre-tokens of one text."""

    def __init__(self, text: str, coder: PieceCounter):
        self.text, self.coder = text, coder
        parts = coder.pattern.findall(text)
        self.encoded = len(parts)
        self.build(list(map(len, parts)), coder.counts(parts))

    def build(self, sizes: list[int], counts: list[int]) -> None:
        self.blocks = [(sizes[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, len(sizes), BLOCK)] or [([], [])]
        self.raise_sums()

    def raise_sums(self) -> None:
        level = np.array([[sum(s), sum(c)] for s, c in self.blocks], np.int64)
        self.levels = [level]
        while len(level) > 1:
            level = np.add.reduceat(level, np.arange(0, len(level), 2), axis=0)
            self.levels.append(level)

    @property
    def tokens(self) -> int:
        return int(self.levels[-1][0, 1])

    def block_at(self, place: int) -> tuple[int, int]:
        """The first block that ends at or behind ``place``, and where it starts."""
        node, start = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            if start + level[node, 0] < place and node + 1 < len(level):
                start += int(level[node, 0])
                node += 1
        return node, start

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from ``start`` to ``end`` (clipped to the text) by ``new``."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        b, at = self.block_at(start - AHEAD)
        sizes, _ = self.blocks[b]
        i = 0
        while i < len(sizes) and at + sizes[i] < start - AHEAD:
            at += sizes[i]
            i += 1
        parts, lb, li, old = [], b, i, at
        stop = start + len(new)
        for match in self.coder.pattern.finditer(text, at):
            parts.append(match[0])
            cut = match.end()
            while old < cut - shift and lb < len(self.blocks):
                if li < len(self.blocks[lb][0]):
                    old += self.blocks[lb][0][li]
                    li += 1
                else:
                    lb, li = lb + 1, 0
            if cut >= stop and old == cut - shift and old >= end:
                break
        else:
            lb, li = len(self.blocks) - 1, len(self.blocks[-1][0])
        lb = min(lb, len(self.blocks) - 1)
        self.encoded = len(parts)
        head, tail = self.blocks[b], self.blocks[lb]
        merged = (head[0][:i] + list(map(len, parts)) + tail[0][li:], head[1][:i] + self.coder.counts(parts) + tail[1][li:])
        self.text = text
        if lb == b and len(merged[0]) <= 2 * BLOCK:
            change = np.array([sum(merged[0]) - sum(head[0]), sum(merged[1]) - sum(head[1])], np.int64)
            self.blocks[b] = merged
            for level in self.levels:
                level[b] += change
                b //= 2
        else:
            n = len(merged[0])
            parts = [(merged[0][k : k + BLOCK], merged[1][k : k + BLOCK]) for k in range(0, n, BLOCK)] or [([], [])]
            self.blocks[b : lb + 1] = parts
            self.raise_sums()


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def edited_counts(
    docs: DataFrame, edits: str = "edits", key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """(key, n_tokens, n_tokens_edited, n_encoded, n_pieces) for every row of ``docs``.

    ``edits`` is an array of structs (start, end, new): code points to replace,
    one edit after the other, each on the text that the one before left; places
    outside the text are clipped. ``n_encoded`` counts the pre-tokens that the
    edits had to encode, ``n_pieces`` those of the text before. Null texts are
    empty, null edits are none, null places are 0. Repeated rows are counted alike. One map; the
    rank file at ``path`` must be readable on every executor.
    """
    path, pattern = path or rank_file(), pattern or split_pattern()

    def run(batches):
        coder = counter(path, pattern)
        for batch in batches:
            rows = []
            for t, changes in zip(batch.column("__text").to_pylist(), batch.column("__edits").to_pylist(), strict=True):
                tree = TokenTree(t, coder)
                before, pieces, encoded = tree.tokens, tree.encoded, 0
                for change in changes or ():
                    tree.edit(change["start"], change["end"], change["new"])
                    encoded += tree.encoded
                rows.append((before, tree.tokens, encoded, pieces))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            names = ["n_tokens", "n_tokens_edited", "n_encoded", "n_pieces"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], [batch.schema.names[0], *names])

    change = F.transform(edits, lambda x: F.struct(_place(x["start"]).alias("start"), _place(x["end"]).alias("end"), F.coalesce(x["new"], F.lit("")).alias("new")))
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text"), change.alias("__edits"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_tokens bigint, n_tokens_edited bigint, n_encoded bigint, n_pieces bigint")


def _place(column):
    return F.coalesce(column.cast("int"), F.lit(0))


def count_report(docs: DataFrame) -> DataFrame:
    """Counts of every document, and of it with its source written over its middle and its head put behind its end."""
    third = F.floor(F.length("text") / 3).cast("int")
    edits = F.array(
        F.struct(third.alias("start"), (third + 24).alias("end"), F.coalesce("source", F.lit("")).alias("new")),
        F.struct((2 * third).alias("start"), (2 * third).alias("end"), F.left("text", F.lit(40)).alias("new")),
    )
    return edited_counts(docs.withColumn("edits", edits))
