"""A wavelet matrix over token ids, and its file format.

The ids are written bit by bit, highest bit first. Each level keeps one bit of
every id; behind it the ids are ordered by that bit, zeros first, each half in
the order it had. With the number of ones in front of every 512 bits (a rank
directory), any id can be read, counted up to a place, and found by its number,
from 1 + 1/16 bits per id and level, without unpacking the rest.

A file holds, little-endian: ``HEADER`` (magic, ids, documents, levels, crc32 of
all that follows), document ids and document starts, the number of zeros of
every level, then per level its bits in words of 64 and its directory.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"KLWAVE01"
HEADER = struct.Struct("<8sQQII")
BLOCK = 512
_WORDS = BLOCK // 64


def _padded(n: int) -> int:
    """Words of a level: whole blocks, and at least one more bit than ids, so that the end has a rank."""
    return (n // BLOCK + 1) * _WORDS


class WaveletMatrix:
    """Ids of the documents of one file; places are counted from its first id."""

    def __init__(self, n: int, zeros: np.ndarray, planes: np.ndarray, directory: np.ndarray, docs: np.ndarray, starts: np.ndarray):
        self.n, self.zeros, self.planes, self.directory = n, zeros, planes, directory
        self.docs, self.starts = docs, starts

    # ---- building and storing ----

    @classmethod
    def build(cls, ids: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> WaveletMatrix:
        """From ids, the documents' ids, and where each starts (one more: the end)."""
        n = len(ids)
        levels = max(1, int(ids.max()).bit_length()) if n else 1
        x = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes = np.zeros((levels, _padded(n)), np.uint64)
        zeros = np.zeros(levels, np.uint64)
        for level in range(levels):
            bit = (x & x.dtype.type(1 << (levels - 1 - level))) != 0
            packed = np.packbits(bit, bitorder="little")
            planes[level].view(np.uint8)[: len(packed)] = packed
            low = np.compress(~bit, x)
            zeros[level] = len(low)
            x = np.concatenate([low, np.compress(bit, x)])
        ones = np.bitwise_count(planes).reshape(levels, -1, _WORDS).sum(axis=2, dtype=np.uint32)
        directory = np.cumsum(ones, axis=1, dtype=np.uint32) - ones
        return cls(n, zeros, planes, directory, docs.astype(np.int64), starts.astype(np.uint64))

    def to_bytes(self) -> bytes:
        body = b"".join(
            [self.docs.astype("<i8").tobytes(), self.starts.astype("<u8").tobytes(), self.zeros.astype("<u8").tobytes(), self.planes.astype("<u8").tobytes(), self.directory.astype("<u4").tobytes()]
        )
        return HEADER.pack(MAGIC, self.n, len(self.docs), len(self.zeros), zlib.crc32(body)) + body

    @classmethod
    def from_bytes(cls, data) -> WaveletMatrix:
        """Views into ``data``; a file that is cut short or changed is refused."""
        view = memoryview(data)
        if len(view) < HEADER.size:
            raise ValueError("not a token file: too short")
        magic, n, docs, levels, crc = HEADER.unpack(view[: HEADER.size])
        body = view[HEADER.size :]
        words = _padded(n)
        sizes = [8 * docs, 8 * (docs + 1), 8 * levels, 8 * levels * words, 4 * levels * (words // _WORDS)]
        if magic != MAGIC or len(body) != sum(sizes) or zlib.crc32(body) != crc:
            raise ValueError("not a token file, or a damaged one")
        parts, at = [], 0
        for size, kind in zip(sizes, ("<i8", "<u8", "<u8", "<u8", "<u4"), strict=True):
            parts.append(np.frombuffer(body[at : at + size], kind))
            at += size
        ids, starts, zeros, planes, directory = parts
        return cls(n, zeros, planes.reshape(levels, -1), directory.reshape(levels, -1), ids, starts)

    # ---- rank and select on one level ----

    def _bits(self, level: int, places: np.ndarray) -> np.ndarray:
        return (self.planes[level][places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)

    def _ones(self, level: int, places: np.ndarray) -> np.ndarray:
        """Ones in front of each place."""
        block, word = places // BLOCK, places >> 6
        found = self.directory[level][block].astype(np.int64)
        plane = self.planes[level]
        for k in range(_WORDS - 1):
            inner = block * _WORDS + k
            found += np.where(inner < word, np.bitwise_count(plane[inner]).astype(np.int64), 0)
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return found + np.bitwise_count(plane[word] & below).astype(np.int64)

    def _select(self, level: int, numbers: np.ndarray, one: bool) -> np.ndarray:
        """Place of the one (or zero) with each number, from 0."""
        directory = self.directory[level].astype(np.int64)
        if not one:
            directory = np.arange(len(directory)) * BLOCK - directory
        block = np.searchsorted(directory, numbers, "right") - 1
        bits = np.unpackbits(self.planes[level].reshape(-1, _WORDS)[block].view(np.uint8), axis=1, bitorder="little") == one
        rank = np.cumsum(bits, axis=1) - 1
        return block * BLOCK + np.argmax(bits & (rank == (numbers - directory[block])[:, None]), axis=1)

    # ---- queries ----

    def access(self, places) -> np.ndarray:
        """The ids at ``places``."""
        at = np.asarray(places, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("no id at such a place")
        out = np.zeros(len(at), np.uint32)
        for level, zeros in enumerate(self.zeros.astype(np.int64)):
            bit, ones = self._bits(level, at), self._ones(level, at)
            out = (out << np.uint32(1)) | bit.astype(np.uint32)
            at = np.where(bit == 1, zeros + ones, at - ones)
        return out

    def _narrow(self, token: int, low: int, high: int) -> tuple[int, int]:
        """The range that ``token``'s occurrences among places low to high have behind the last level."""
        levels = len(self.zeros)
        if token < 0 or token >> levels:
            return 0, 0
        edges = np.array([low, high], np.int64)
        for level, zeros in enumerate(self.zeros.astype(np.int64)):
            ones = self._ones(level, edges)
            edges = zeros + ones if token >> (levels - 1 - level) & 1 else edges - ones
        return int(edges[0]), int(edges[1])

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` at the places from ``low`` up to ``high``."""
        first, last = self._narrow(token, low, self.n if high is None else high)
        return last - first

    def occurrences(self, token: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """The places of ``token`` from ``low`` up to ``high``, ascending."""
        first, last = self._narrow(token, low, self.n if high is None else high)
        at = np.arange(first, last)
        levels = len(self.zeros)
        for level in range(levels - 1, -1, -1):
            one = bool(token >> (levels - 1 - level) & 1)
            out = np.empty_like(at)
            for k in range(0, len(at), 1 << 14):  # a block of bits is unpacked for each
                part = at[k : k + (1 << 14)]
                out[k : k + len(part)] = self._select(level, part - int(self.zeros[level]) if one else part, one)
            at = out
        return at

    def decode(self) -> np.ndarray:
        """All ids in order: the levels undone from the last to the first."""
        levels = len(self.zeros)
        x = np.zeros(self.n, np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            bit = np.unpackbits(self.planes[level].view(np.uint8), count=self.n, bitorder="little").view(bool)
            zeros = int(self.zeros[level])
            y = np.empty_like(x)
            y[np.flatnonzero(~bit)] = x[:zeros]
            y[np.flatnonzero(bit)] = x[zeros:] | x.dtype.type(1 << (levels - 1 - level))
            x = y
        return x
