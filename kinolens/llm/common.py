"""Shared pieces: reading, storing between steps, and word tables over Arrow text.

A *block* is a run of whole documents whose UTF-8 bytes lie next to each other
in one array. Working on blocks of about a megabyte keeps numpy's temporaries
small and in cache, whatever the batch size; one longer document is a block of
its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolens.session import fresh_dir

BLOCK_BYTES = 1 << 20
#: Whole texts leave a task so many at a time, so that neither side holds a second copy of a large batch.
ROWS_OUT = 500

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = tuple(np.uint64(s) for s in (30, 27, 31))
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: A random value per byte, fixed by its seed, for content hashes.
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of a write are removed once it is done, not at some later collection."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of so many rows in what is run here: neither Spark nor a Python worker holds many texts at a time."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a frame that :func:`stored` returned, once nothing is going to read it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, mark, text: the columns that identify a row's content, and its text.

    ``mark`` hashes the whole text, so rows that repeat an id with another text
    stay apart; rows that repeat both get the same result. A null id becomes
    the smallest long and a null text is empty.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(whole).alias("mark"), whole.alias("text")
    )


#: Stands for a null id while documents are compared.
NULL_ID = -(2**63)


def given_id(doc: str = "doc") -> Column:
    """The id as it was given, null again where it was null."""
    return F.when(F.col(doc) != NULL_ID, F.col(doc))


def bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of an Arrow text column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1 + column.offset)[column.offset :] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets.astype(np.int64)


def blocks(column, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of rows with about ``size`` bytes."""
    data, offsets = text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser of the splitmix kind)."""
    x = (x ^ (x >> _SHIFTS[0])) * _MIX_A
    x = (x ^ (x >> _SHIFTS[1])) * _MIX_B
    return x ^ (x >> _SHIFTS[2])


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An order-sensitive hash of two hashes."""
    return mix(a * _MULTIPLIER + b)


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of each word of a block; words never cross documents."""
    inside = is_word[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit content hash of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(firsts[-1] + lengths[-1]) - np.repeat(firsts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _MULTIPLIER))
    values = BYTE_VALUES[data[place + np.repeat(starts, lengths)]] * powers[place]
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


def byte_set(inside) -> np.ndarray:
    """Which of the 256 byte values satisfy ``inside``."""
    return np.array([bool(inside(b)) for b in range(256)])


#: Bytes of words between ASCII white space, and of lower-cased letters-and-digits words.
NOT_SPACE = byte_set(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
LETTERS = byte_set(lambda b: not (b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F))
#: A-Z to a-z, all other bytes as they are.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
