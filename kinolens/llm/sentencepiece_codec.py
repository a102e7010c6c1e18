"""SentencePiece encoding and decoding by a merge-type prefix table.

Every prefix of a text has one encoding, so it has one last token. The table
stores that token for each prefix: among the pieces that an automaton finds
ending there, it is the one whose start is the beginning of the text, or whose
left neighbour (the last token of the prefix that ends where it starts) forms a
*compatible pair* with it, which means that the two merge back to themselves
when their joined text is encoded. The ids are then read from the end of the
table backwards.

Merges cannot cross two neighbouring characters that no piece contains side by
side. Texts are cut there, and the parts (mostly words) are kept in a memo of
bounded size, so the table is filled once per distinct part.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import sys
from array import array
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import blocks

SPACE = "▁"
#: Most parts in one half of the memo; a full half becomes the old half. As one
#: of several steps of a pipeline, whose workers keep what earlier steps left,
#: it is smaller than where encoding is all that a worker does.
MEMO_PARTS, ALONE_PARTS = 100_000, 400_000
#: Most pairs of tokens whose test is kept.
MEMO_PAIRS = 150_000
#: Longer parts are not kept.
MEMO_LENGTH = 64


class PieceCodec:
    """Encoder and decoder of one BPE model file."""

    def __init__(self, path: str, memo: int | None = None):
        self.most = memo or MEMO_PARTS
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = model.normalize
        self.bytes_ids = {}
        self.piece_of, self.id_of, self.score = {}, {}, {}
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.piece_of[i], self.id_of[piece], self.score[piece] = piece, i, model.get_score(i)
        if any(model.is_unused(i) for i in range(model.vocab_size())):
            raise ValueError("models with unused pieces are not supported")
        self.unknown, self.unknown_text = model.unk_id(), model.decode([model.unk_id()])
        self.byte_of = {i: b for b, i in self.bytes_ids.items()}
        self.prefix = model.normalize("a").startswith(SPACE)
        self.joined = {p[i : i + 2] for p in self.id_of for i in range(len(p) - 1)}
        self.longest = max(map(len, self.id_of))
        self.automaton = ahocorasick.Automaton()
        #: Pieces that share their score with another one; ties between them are broken by place.
        seen: dict[float, str] = {}
        self.tied = set()
        for piece, score in self.score.items():
            if len(piece) > 1:
                if score in seen:
                    self.tied |= {piece, seen[score]}
                seen[score] = piece
        for piece in self.id_of:
            if self.merge(piece) == [piece]:
                self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.parts = self.coarse()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.surface = {i: b"" for i in range(model.vocab_size())}
        self.surface |= {i: p.replace(SPACE, " ").encode() for i, p in self.piece_of.items()}
        self.surface |= {i: bytes([b]) for i, b in self.byte_of.items()}
        self.surface[self.unknown] = self.unknown_text.encode()
        self.surfaces = pa.array([self.surface[i] for i in range(model.vocab_size())], pa.large_binary())
        self.decimals = pa.array([f"{i},".encode() for i in range(model.vocab_size())], pa.large_binary())
        self.tied = {p for p in self.tied if not any(q in p for q in self.tied if q != p)}

    def merge(self, text: str) -> list[str]:
        """Best-scoring neighbour merges on a short text, the leftmost of equals first."""
        parts: list[str | None] = list(text)
        after = [*range(1, len(parts)), -1]
        ahead = [-1, *range(len(parts) - 1)]
        heap = [(-self.score[parts[i] + parts[i + 1]], i, parts[i] + parts[i + 1]) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.score]
        heapq.heapify(heap)
        while heap:
            _, i, whole = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or parts[j] is None or parts[i] + parts[j] != whole:
                continue
            parts[i], parts[j], after[i] = whole, None, after[j]
            if after[i] >= 0:
                ahead[after[i]] = i
            for a, b in ((ahead[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (joined := parts[a] + parts[b]) in self.score:
                    heapq.heappush(heap, (-self.score[joined], a, joined))
        return [p for p in parts if p is not None]

    def compatible(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def part_tokens(self, part: str) -> list[str]:
        """Tokens of a part without safe cuts: fill the prefix table, read it backwards."""
        if len(part) == 1:
            return [part]
        if any([p in part for p in self.tied]):
            return self.merge(part)  # pieces of equal score are ordered by place, which pairs can't tell
        last: list[str | None] = [None] * len(part)
        pairs, compatible = self.pairs, self.compatible
        for end, piece in self.automaton.iter(part):
            if last[end] is None:
                start = end - len(piece)
                if start < 0:
                    last[end] = piece
                elif (left := last[start]) is not None:
                    good = pairs.get((left, piece))
                    if compatible(left, piece) if good is None else good:
                        last[end] = piece
        tokens, end = [], len(part) - 1
        while end >= 0:
            piece = last[end] or part[end]  # a character without a piece stands alone
            tokens.append(piece)
            end -= len(piece)
        tokens.reverse()
        return tokens

    def token_ids(self, token: str) -> list[int]:
        if token in self.id_of:
            return [self.id_of[token]]
        if self.bytes_ids:
            return [self.bytes_ids[b] for b in token.encode()]
        return [self.unknown]

    def cuts(self, text: str) -> list[str]:
        """Parts between which no merge is possible."""
        joined = self.joined
        at = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in joined]
        if not at:
            return [text]
        return [text[i:j] for i, j in zip([0, *at], [*at, len(text)], strict=True)]

    def coarse(self) -> re.Pattern:
        """Cuts a text into parts that no merge crosses; most are a space mark and a word.

        The letters are closed under "may stand in front of" in the pieces, so
        no piece has a letter in front of another kind of character.
        """
        letters = {c for p in self.id_of for c in p if c.isalpha()}
        while more := {b for a, b in self.joined if a in letters} - letters:
            letters |= more
        if SPACE in letters or any(p[1] == SPACE and p[0] != SPACE for p in self.joined):
            return re.compile("(?s).+")
        kind = "".join(map(re.escape, sorted(letters)))
        tail = f"[{kind}]*" if any(b in letters and a not in letters and a != SPACE for a, b in self.joined) else ""
        return re.compile(f"{SPACE}*[{kind}]+|{SPACE}*[^{kind}{SPACE}]+{tail}|{SPACE}+")

    def part(self, part: str) -> bytes:
        """Packed ids of a part: from the memo, or by cutting it further and filling the table."""
        known = self.old.get(part)
        if known is None:
            known = pack([i for p in self.cuts(part) for t in self.part_tokens(p) for i in self.token_ids(t)])
        if len(part) <= MEMO_LENGTH:
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[part] = known
        return known

    def encode_packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers one behind the other."""
        if not text:
            return b""
        parts = self.parts.findall(self.normalize(text))
        found = list(map(self.young.get, parts))
        if None in found:
            found = [self.part(p) if f is None else f for p, f in zip(parts, found, strict=True)]
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        return array("I", self.encode_packed(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(b"".join([self.surface[i] for i in ids]), ids[0] if ids else self.unknown).decode()

    def decode_bytes(self, joined: bytes, first: int) -> bytes:
        """UTF-8 of joined surfaces: the mark put in front is dropped, bad bytes become U+FFFD."""
        if self.prefix and self.piece_of.get(first, "").startswith(SPACE):
            joined = joined[1:]
        try:
            joined.decode()
        except UnicodeDecodeError:
            return replaced(joined).encode()
        return joined

    def columns(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        """Of each text: number of ids, ids as decimals joined by commas, decoded text."""
        packed = [self.encode_packed(t) for t in texts]
        counts = np.array([len(p) // 4 for p in packed], np.int64)
        ids = pa.array(np.frombuffer(b"".join(packed), np.uint32))
        ends = np.cumsum(counts)
        joined, decoded = [], []
        for table, out in ((self.decimals, joined), (self.surfaces, decoded)):
            _, offsets, data = table.take(ids).buffers()
            at = np.frombuffer(offsets, np.int64)[np.concatenate([[0], ends])] if len(ids) else np.zeros(len(ends) + 1, np.int64)
            view = memoryview(data) if len(ids) else memoryview(b"")
            out += [bytes(view[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        firsts = [int.from_bytes(p[:4], sys.byteorder) for p in packed]
        return counts, [j[:-1] for j in joined], [self.decode_bytes(d, i) for d, i in zip(decoded, firsts, strict=True)]


def pack(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def replaced(raw: bytes) -> str:
    """Bytes as text; each byte that starts no valid character becomes U+FFFD."""
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + n].decode())
            except UnicodeDecodeError:
                continue
            i += n
            break
        else:
            out.append("\ufffd")
            i += 1
    return "".join(out)


@cache
def codec(path: str, memo: int | None = None) -> PieceCodec:
    """One codec per Python worker."""
    return PieceCodec(path, memo)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", memo: int = MEMO_PARTS) -> DataFrame:
    """(key, n_tokens, ids, decoded): ids as a list of decimals joined by commas, and their decoded text.

    One map over the rows; the file at ``path`` must be readable on every
    executor. A null text is empty and has no ids. Repeated rows give repeated
    results; other columns of ``docs`` are not read.
    """
    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(
        _encoder(path or model_path(), memo, digest=False), _schema(docs, key, "ids string, decoded string")
    )


def encoded_digests(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", memo: int = ALONE_PARTS) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of :func:`encode_documents`, hashed where they arise."""
    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(
        _encoder(path or model_path(), memo, digest=True), _schema(docs, key, "ids_sha256 string, decoded_sha256 string")
    )


def _schema(docs: DataFrame, key: str, rest: str) -> str:
    return f"`{key}` {docs.schema[key].dataType.simpleString()}, n_tokens bigint, {rest}"


def _encoder(path: str, memo: int, digest: bool):
    def run(batches):
        coder = codec(path, memo)
        names = ("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded")
        for batch in batches:
            # about a megabyte of text at a time: its ids and surfaces take many times that
            for first, _, offsets in blocks(batch.column(1)):
                part = batch.slice(first, len(offsets) - 1)
                counts, ids, decoded = coder.columns(part.column(1).to_pylist())
                if digest:
                    ids, decoded = ([hashlib.sha256(t).hexdigest() for t in x] for x in (ids, decoded))
                else:
                    ids, decoded = ([t.decode() for t in x] for x in (ids, decoded))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    [batch.schema.names[0], "n_tokens", *names],
                )

    return run
