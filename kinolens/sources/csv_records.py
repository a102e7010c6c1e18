"""CSV files with line breaks inside quoted fields, read by many tasks.

Spark's ``multiLine`` gives a whole file to one task. Here files are read as
lines, in splits of any size. A line ends a record if the quotes before it are
even in number. Every split counts its own quotes; their running sum over the
splits of a file (one row per split) tells how many stand in front of each. With
that a second pass cuts its split into whole records, and only the pieces that a
split border cuts off, two per split at most, are put together in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinolens.session import materialise

PLACE = "file string, start long"


def _lines(spark: SparkSession, path) -> DataFrame:
    """(file, start, line): lines in file order within each split; ``start`` is the split's first byte."""
    meta = F.col("_metadata")
    rows = spark.read.text(path, lineSep="\n")
    return rows.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("start"), F.col("value").alias("line"))


def _odd(lines: pa.Array, quote: str, escape: str) -> list[bool]:
    """Whether each line holds an odd number of quotes; an escaped one isn't counted."""
    if escape != quote:
        lines = pc.replace_substring_regex(lines, "\\" + escape + ".", "")
    return pc.equal(pc.bit_wise_and(pc.count_substring(lines, quote), 1), 1).to_pylist()


def split_parities(lines: DataFrame, quote: str, escape: str) -> DataFrame:
    """(file, start, odd, to_even, to_odd): a split's own parity, and whether some line of it ends at each parity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, open_, seen, out = None, False, [False, False], []
        for batch in batches:
            odd = _odd(batch.column("line"), quote, escape)
            for here, flips in zip(zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True), odd, strict=True):
                if here != place:
                    if place:
                        out.append((*place, open_, *seen))
                    place, open_, seen = here, False, [False, False]
                open_ ^= flips
                seen[open_] = True
        if place:
            out.append((*place, open_, *seen))
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        columns = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "start", "odd", "to_even", "to_odd"])

    return lines.mapInArrow(run, f"{PLACE}, odd boolean, to_even boolean, to_odd boolean")


def split_starts(parities: DataFrame) -> DataFrame:
    """(file, start, within, owner): whether a split begins inside a record, and the split that this record began in."""
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(F.col("odd").cast("int")).over(before) % 2 == 1, F.lit(False))
    known = parities.withColumn("within", within)
    # A split leaves a record of its own open if it ends at odd parity and began, or some line ended, at even parity.
    open_after = F.col("within") != F.col("odd")
    closes = F.when(F.col("within"), F.col("to_odd")).otherwise(F.lit(True))
    opened = F.when(open_after & closes, F.col("start"))
    return known.withColumn("opened", opened).select("file", "start", "within", F.last("opened", ignorenulls=True).over(before).alias("owner"))


def record_pieces(lines: DataFrame, starts: DataFrame, quote: str, escape: str) -> DataFrame:
    """(file, owner, start, part, first, record): whole records (part 0), and pieces at the borders.

    Part 1 is the head of a split that belongs to a record begun before, part 2
    the tail that goes on behind it. ``first`` marks a file's first record. The
    table of splits goes to every task: a split is a file block, so that table
    has some ten bytes for every megabyte of text; it is refused beyond 256 MB.
    """
    held = starts.toArrow()
    if held.nbytes > 256 << 20:
        raise ValueError("too many splits to ship; raise spark.sql.files.maxPartitionBytes")
    shipped = lines.sparkSession.sparkContext.broadcast(
        {(r["file"], r["start"]): (r["within"], r["owner"]) for r in held.to_pylist()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits, place, open_, part, owner, held, first, out = shipped.value, None, False, 0, None, [], False, []

        def piece(part):
            return (*place, owner if part == 1 else place[1], part, first and part != 1, "\n".join(held))

        def rows():
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            columns = list(zip(*out, strict=True)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "start", "owner", "part", "first", "record"])

        for batch in batches:
            odd = _odd(batch.column("line"), quote, escape)
            for file, start, line, flips in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), batch.column("line").to_pylist(), odd, strict=True):
                if (file, start) != place:
                    if held:
                        out.append(piece(part or 2))
                    place, held = (file, start), []
                    open_, owner = splits[place]
                    part, first = int(open_), start == 0 and not open_
                held.append(line)
                open_ ^= flips
                if not open_:
                    out.append(piece(part))
                    held, part, first = [], 0, False
            yield rows()
            out = []
        if held:
            out.append(piece(part or 2))
            yield rows()

    return lines.mapInArrow(run, f"{PLACE}, owner long, part int, first boolean, record string")


def csv_records(spark: SparkSession, path, quote: str = '"', escape: str = "\\") -> DataFrame:
    """(file, start, first, record): the text of every record, line breaks in quotes kept.

    Records that lie in one split are a map; those that a border cuts are joined by (file, split they began in).
    """
    lines = _lines(spark, path)
    starts = split_starts(materialise(split_parities(lines, quote, escape), "csv-splits"))
    pieces = materialise(record_pieces(lines, starts, quote, escape), "csv-records")
    whole = pieces.where("part = 0").select("file", "start", "first", "record")
    ordered = F.array_sort(F.collect_list(F.struct("pieces.start", "record")))
    cut = pieces.alias("pieces").where("part > 0").groupBy("file", "owner").agg(F.max("first").alias("first"), ordered.alias("p"))
    return whole.union(cut.select("file", F.col("owner").alias("start"), "first", F.array_join("p.record", "\n").alias("record")))


def read_csv_split(spark: SparkSession, path, schema: str | T.StructType, header: bool = True, quote: str = '"', escape: str = "\\") -> DataFrame:
    """Rows of CSV files, equal to those of ``multiLine`` reading, from splits of any size.

    Quotes only enclose fields (or are escaped within them), lines end with a
    line feed, and empty lines outside quotes are no records.
    """
    records = csv_records(spark, path, quote, escape)
    if header:
        records = records.where("not first")
    kept = records.where(F.trim(F.rtrim(F.regexp_replace("record", "\r$", ""))) != "")
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", ddl, {"quote": quote, "escape": escape, "mode": "PERMISSIVE"})
    return kept.select(parsed.alias("r")).select("r.*")
