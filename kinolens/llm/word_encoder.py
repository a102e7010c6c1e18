"""Encoding by a tokenizer file whose pre-tokens never cross white space, with a memo of words.

Most words of a text have been seen before. Texts are cut at ASCII white space,
and at a run of ASCII punctuation that ends a word behind an ASCII letter; the
tokenizer's pattern always cuts at both, so the parts can be encoded alone. Each
different part of a block is looked up once, and the library encodes only those
that the memo lacks. A full memo keeps the parts that came in more than one
block: most others never come again.
"""

from __future__ import annotations

import os
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from kinolens.llm.common import LOWER, NOT_SPACE, blocks, byte_set, word_spans

#: Parts that a worker keeps.
MEMO = 500_000
#: Bytes of text in a block: large ones have fewer different parts in all, each of which is looked up.
ENCODED_BYTES = 1 << 22
_LETTER = byte_set(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
_SIGN = byte_set(lambda b: b < 0x80 and not (0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 or b == 0x20 or 0x09 <= b <= 0x0D))


class WordEncoder:
    """Ids of whole texts by the tokenizer file at ``path``, equal to the library's for each text.

    The file must lower-case, drop white space, mark word ends, and take runs
    of letters, single digits, contractions and runs of other signs as
    pre-tokens. Texts with ``<|``, which may be a special token, go to the
    library whole.
    """

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32
        #: Lower-case ASCII words pass the file's normalizer and pre-tokenizer as they are, so its model alone has their ids.
        self.model = self.tokenizer.model
        self.direct = not any(t.content.isalpha() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.most = memo
        self.clear()

    def clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, self.kind), 0
        self.first, self.sizes, self.uses = (np.zeros(1 << 14, np.int64) for _ in range(3))

    def _make_room(self) -> None:
        """Keep the parts that were used by two blocks since this was done last, unless these are more than half of a memo."""
        n = len(self.memo)
        kept = np.flatnonzero(self.uses[:n] > 1)
        parts, first, sizes, flat = list(self.memo), self.first[kept], self.sizes[kept], self.flat
        self.clear()
        if 2 * len(kept) <= self.most:
            before = np.cumsum(sizes) - sizes
            ids = flat[np.arange(int(sizes.sum())) + np.repeat(first - before, sizes)]
            self._add([parts[i] for i in kept.tolist()], ids, sizes)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def _learn(self, parts: list[str]) -> None:
        if self.direct:
            simple = [p for p in parts if p.isascii() and p.isalpha()]
            tokenize = self.model.tokenize
            self._add_lists(simple, [[t.id for t in tokenize(p)] for p in simple])
            parts = [p for p in parts if not (p.isascii() and p.isalpha())]
        plain = [p for p in parts if p.isalpha()]
        rest = [p for p in parts if not p.isalpha()]
        for k in range(0, len(plain), 4096):
            # Each of these is one pre-token, so its last id is one that ends a word.
            some = plain[k : k + 4096]
            ids = self.whole(" ".join(some))
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                self._add(some, ids, np.diff(stops, prepend=0))
            else:
                rest += some
        if rest:
            self._add_lists(rest, [e.ids for e in self.tokenizer.encode_batch(rest, add_special_tokens=False)])

    def _add_lists(self, parts: list[str], found: list[list[int]]) -> None:
        self._add(parts, np.fromiter(chain.from_iterable(found), self.kind), np.fromiter(map(len, found), np.int64, len(found)))

    def _add(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, at = len(self.memo), self.used
        while at + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(parts) > len(self.first):
            self.first, self.sizes, self.uses = (np.concatenate([a, np.zeros_like(a)]) for a in (self.first, self.sizes, self.uses))
        self.flat[at : at + len(ids)] = ids
        self.first[n : n + len(parts)] = at + np.cumsum(sizes) - sizes
        self.sizes[n : n + len(parts)] = sizes
        self.memo.update(zip(parts, range(n, n + len(parts)), strict=True))
        self.used = at + len(ids)

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, and how many each has."""
        n = len(offsets) - 1
        doc, starts, ends = word_spans(data, offsets, NOT_SPACE)
        if not len(starts):
            return np.zeros(0, self.kind), np.zeros(n, np.int64)
        sign = _SIGN[data]
        closed = np.flatnonzero(sign[ends - 1])
        if len(closed):
            # The run of signs that ends each such part; it is cut off if it begins inside the part, behind a letter.
            runs = np.flatnonzero(sign & ~np.concatenate([[False], sign[:-1]]))
            cuts = runs[np.searchsorted(runs, ends[closed], "left") - 1]
            inside = (cuts > starts[closed]) & _LETTER[data[cuts - 1]]
            closed, cuts = closed[inside], cuts[inside]
            starts, ends, doc = np.insert(starts, closed + 1, cuts), np.insert(ends, closed, cuts), np.insert(doc, closed + 1, doc[closed])
        sizes = ends - starts
        firsts = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        values = np.compress(NOT_SPACE[data], data)
        lower, wide = LOWER[values], np.maximum.reduceat(values, firsts) >= 0x80
        if wide.any():
            np.copyto(lower, values, where=np.repeat(wide, sizes))
        edges = np.append(firsts, total).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(lower)).dictionary_encode()
        words = parts.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist() makes a scalar of each first
        known = self._found(words)
        missing = np.flatnonzero(known < 0)
        if len(missing) and len(self.memo) + len(missing) > self.most:
            self.uses[known[known >= 0]] += 1
            self._make_room()
            known = self._found(words)
            missing = np.flatnonzero(known < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            self._learn(new)
            known[missing] = self._found(new)
        self.uses[known] += 1
        held = known[parts.indices.to_numpy()]
        lengths = self.sizes[held]
        before = np.cumsum(lengths) - lengths
        ids = self.flat[np.arange(int(lengths.sum())) + np.repeat(self.first[held] - before, lengths)]
        return ids, np.bincount(doc, lengths, n).astype(np.int64)

    def _found(self, parts: list[str]) -> np.ndarray:
        """The numbers of ``parts`` in the memo, -1 for those it lacks."""
        return np.fromiter(map(self.memo.get, parts, repeat(-1)), np.int64, len(parts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        found, counts = [np.zeros(0, self.kind)], [np.zeros(0, np.int64)]
        for first, data, offsets in blocks(texts, ENCODED_BYTES):
            ids, n = self._block(data, offsets)
            special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
            if len(special):
                rows = np.unique(np.searchsorted(offsets, special, "right") - 1)
                each = np.split(ids, np.cumsum(n)[:-1])
                for r in rows.tolist():
                    each[r] = self.whole(data[offsets[r] : offsets[r + 1]].tobytes().decode())
                    n[r] = len(each[r])
                ids = np.concatenate(each)
            found.append(ids)
            counts.append(n)
        return np.concatenate(found), np.concatenate(counts)


@cache
def encoder(path: str, memo: int = MEMO) -> WordEncoder:
    """One encoder per Python worker."""
    return WordEncoder(path, memo)
