"""Token ids as files of wavelet matrices, written and read by Spark tasks.

Documents are range-partitioned by id; every task encodes its stretch in order
and writes a file whenever it holds ``shard_tokens`` ids. A small table names
the files, with their documents, ids, and the ids of all files before them. Files lie in the shared folder and are
written under another name first, so a task that runs again puts the same file
in the same place and no reader sees half of one.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinolens.llm.common import given_id, keyed, stored
from kinolens.llm.wavelet import WaveletMatrix
from kinolens.llm.word_encoder import MEMO, encoder
from kinolens.session import fresh_dir

#: Ids after which a file is ended; a document is never cut, so one longer document makes a larger file.
SHARD_TOKENS = 1 << 22
END_ID = 2
#: Ids in one batch of rows that are read back.
BATCH_TOKENS = 1 << 20


def token_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _store(folder: str):
    """The file system and path of a folder that Spark names by URI or path (s3a is s3 here)."""
    from pyarrow import fs

    uri = folder.replace("s3a://", "s3://", 1)
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri.replace("file:", "file://", 1)
    return fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None, tokenizer: str | None = None, end_id: int | None = END_ID,
    shard_tokens: int = SHARD_TOKENS, memo: int = MEMO,
) -> DataFrame:
    """Encode every text and write the ids; returns (file, path, n_docs, n_tokens, start), one row per file.

    Ids follow each other by ascending document id (null first; equal ids by a
    hash of their text), ``end_id`` behind each document. ``start`` is the
    number of ids in all files before. Null texts are empty. No rows, no files.
    Other columns are not read. ``tokenizer`` must be readable on every executor;
    ``folder`` must be one that every executor can reach.
    """
    folder, model = folder or fresh_dir(docs.sparkSession, "token-files"), tokenizer or token_model()

    def run(batches):
        coder, pid, number = encoder(model, memo), TaskContext.get().partitionId(), 0
        held, ids, sizes, total = [], [], [], 0

        def written():
            store, base = _store(folder)
            starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            data = WaveletMatrix.build(np.concatenate(ids), np.concatenate(held), starts).to_bytes()
            name = f"{pid:06d}-{number:04d}.wm"
            store.create_dir(base, recursive=True)
            hidden = f"{base}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(hidden) as out:
                out.write(data)
            store.move(hidden, f"{base}/{name}")
            row = [[pid], [number], [f"{folder.rstrip('/')}/{name}"], [len(starts) - 1], [int(starts[-1])]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["pid", "part", "path", "n_docs", "n_tokens"])

        for batch in batches:
            keys, texts = batch.column("doc").to_numpy(), batch.column("text")
            for at, stop in _runs(texts, min(1 << 23, 4 * shard_tokens)):
                found, n = coder.encode(texts.slice(at, stop - at))
                if end_id is not None:
                    closed = np.full(len(found) + len(n), end_id, np.result_type(found.dtype, np.min_scalar_type(end_id)))
                    closed[np.arange(len(found)) + np.repeat(np.arange(len(n)), n)] = found
                    found, n = closed, n + 1
                held.append(keys[at:stop])
                ids.append(found)
                sizes.append(n)
                total += len(found)
                if total >= shard_tokens:
                    yield written()
                    held, ids, sizes, total, number = [], [], [], 0, number + 1
        if held:
            yield written()

    rows = keyed(docs, key, text).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc", "mark", "row").sortWithinPartitions("doc", "mark", "row").select("doc", "text")
    files = stored(ordered.mapInArrow(run, "pid int, part int, path string, n_docs long, n_tokens long"), "token-file-sizes")
    # One row per file: small enough for one task, whatever the files hold.
    order = Window.orderBy("pid", "part")
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = files.select((F.row_number().over(order) - 1).cast("long").alias("file"), "path", "n_docs", "n_tokens", before.alias("start"))
    return stored(numbered, "token-file-list")


def _runs(texts: pa.Array, size: int):
    """Stretches of rows with some ``size`` bytes of text each, so that files end near their size."""
    ends = np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield at, stop
        at = stop


def _opened(path: str) -> WaveletMatrix:
    store, place = _store(path)
    with store.open_input_file(place) as file:
        return WaveletMatrix.from_bytes(file.read_buffer())


def _each_file(files: DataFrame, read, schema: str) -> DataFrame:
    """``read(start, matrix)`` yields batches; a task takes one file at a time."""

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                yield from read(start, _opened(path))

    return files.select("path", "start").repartition(max(1, files.count())).mapInArrow(run, schema)


def read_tokens(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) of every document; ids as little-endian unsigned 32-bit numbers."""

    def read(start, matrix):
        ids, starts = matrix.decode(), matrix.starts.astype(np.int64)
        first = 0
        while first < len(matrix.docs):
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + BATCH_TOKENS, "right")) - 1)
            edges = starts[first : last + 1]
            data = ids[edges[0] : edges[-1]].astype("<u4")
            held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer((edges - edges[0]) * 4), pa.py_buffer(data)])
            columns = [pa.array(matrix.docs[first:last]), pa.array(start + edges[:-1]), pa.array(np.diff(edges)), held.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "start", "n_tokens", "ids"])
            first = last

    rows = _each_file(files, read, "doc long, start long, n_tokens long, ids binary")
    return rows.select(given_id().alias(key), "start", "n_tokens", "ids")


def token_frequencies(files: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of ``tokens`` stands in all files, counted on the bit-planes without decoding."""
    wanted = sorted(set(tokens))

    def read(_, matrix):
        yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array([matrix.count(t) for t in wanted], pa.int64())], ["token", "n"])

    return _each_file(files, read, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def token_places(files: DataFrame, token: int, key: str = "doc_id") -> DataFrame:
    """(key, place, position): every occurrence of ``token``, counted from its document's first id and from the first of all."""

    def read(start, matrix):
        at = matrix.occurrences(token)
        starts = matrix.starts.astype(np.int64)
        doc = np.searchsorted(starts, at, "right") - 1
        for k in range(0, len(at), BATCH_TOKENS):
            a, d = at[k : k + BATCH_TOKENS], doc[k : k + BATCH_TOKENS]
            yield pa.RecordBatch.from_arrays([pa.array(matrix.docs[d]), pa.array(a - starts[d]), pa.array(start + a)], ["doc", "place", "position"])

    return _each_file(files, read, "doc long, place long, position long").select(given_id().alias(key), "place", "position")


def tokens_at(files: DataFrame, positions: DataFrame, position: str = "position") -> DataFrame:
    """(position, token) for a table of places counted from the first id of all.

    Places are sent to the files that hold them (ranges of the file list, a
    row per file); only those bits are read. Places outside are left out.
    """

    def run(batches):
        for batch in batches:
            path, start, at = batch.column("path")[0].as_py(), batch.column("start")[0].as_py(), batch.column("position").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(_opened(path).access(at - start).astype(np.int64))], ["position", "token"])

    spans = files.select("path", "start", (F.col("start") + F.col("n_tokens")).alias("stop"))
    wanted = positions.select(F.col(position).cast("long").alias("position"))
    # Cells of the size of a file keep the range join an equal join: a file spans few cells.
    cell = F.lit(SHARD_TOKENS)
    spans = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / cell), F.floor((F.col("stop") - 1) / cell))))
    held = wanted.withColumn("cell", F.floor(F.col("position") / cell)).join(spans, "cell").where("position >= start and position < stop")
    # The places of one file are split by hash, so that no task holds all of a file that is asked for often.
    grouped = held.withColumn("slice", F.pmod(F.xxhash64("position"), F.lit(16))).select("path", "slice", "start", "position")
    return grouped.groupBy("path", "slice").applyInArrow(_group(run), "position long, token long")


def _group(run):
    def one(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(run(table.combine_chunks().to_batches()), pa.schema([("position", pa.int64()), ("token", pa.int64())]))

    return one


def token_file_report(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: ``documents`` written as token files and read back."""
    return read_tokens(write_token_files(docs)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
