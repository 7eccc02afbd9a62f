"""Csv files whose fields hold line breaks, read by many tasks.

Whether a line begins a record depends on all quotes before it. So quotes are counted per block of a file
first; a running sum over these few counts tells for each block whether it begins inside of a field. Then every
task puts the lines of its blocks together by itself, and only records that go over the end of a block
meet in a shuffle. Fields follow RFC 4180: quotes inside of a field are doubled, and a field with any is in quotes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpusmix
from corpusmix.session import materialize, ship_packages

MOST_BLOCKS = 2_000_000  # 256 TB in blocks of 128 MB
OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}
PIECES = "file string, block bigint, piece bigint, record string, first boolean, begins boolean, ends boolean"


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, or pieces of them, of lines ``file, block, inside, value`` in the order of the file."""
    at: tuple[str, int] | None = None
    lines: list[str] = []  # of the record that is open
    begins = first = inside = False
    piece = 0
    out: list[tuple] = []

    def put(ends: bool) -> None:
        nonlocal piece, lines, begins, first
        if lines:
            out.append((at[0], at[1], piece, "\n".join(lines), first, begins, ends))
            piece += 1
        lines, begins, first = [], True, False

    def batch_of() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_()]
        columns = [pa.array(list(values), kind) for values, kind in zip(zip(*out), kinds)]
        names = ["file", "block", "piece", "record", "first", "begins", "ends"]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        quotes = pc.count_substring(batch.column(3), '"').to_pylist()
        files, blocks, inner, values = (batch.column(k).to_pylist() for k in range(4))
        for file, block, opened, value, count in zip(files, blocks, inner, values, quotes):
            if at != (file, block):
                if at is not None:
                    put(ends=False)
                at, piece, inside = (file, block), 0, opened
                begins, first = not opened, block == 0
            lines.append(value)
            inside ^= count % 2 == 1
            if not inside:
                put(ends=True)
        if out:
            yield batch_of()
    if at is not None:
        put(ends=False)
        if out:
            yield batch_of()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record`` of each record below the header lines of all files at ``path``; blank ones are left out."""
    ship_packages(spark, corpusmix)
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    opened = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside")
    starts = materialize(blocks.select("file", "block", opened), "csv_blocks")
    # A line per block is sent to every task, as a join that moved text would lose the order of the lines.
    found = starts.count()
    if found > MOST_BLOCKS:
        raise ValueError(f"{found} blocks at {path}: set spark.sql.files.maxPartitionBytes for {MOST_BLOCKS} at most")
    pieces = lines.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "inside", "value")
    pieces = pieces.mapInArrow(_assembled, PIECES)
    whole = pieces.where(F.col("begins") & F.col("ends")).select("record", "first")
    in_file = Window.partitionBy("file").orderBy("block", "piece")
    number = F.sum(F.col("begins").cast("int")).over(in_file).alias("number")
    parts = pieces.where(~(F.col("begins") & F.col("ends"))).select("*", number)
    joined = parts.groupBy("file", "number").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("block", "piece", "record"))), lambda p: p["record"]), "\n"
        ).alias("record"),
        F.bool_or("first").alias("first"),
    )
    records = whole.unionByName(joined.select("record", "first")).where(~F.col("first"))
    clean = F.regexp_replace("record", "\r$", "")
    return records.select(clean.alias("record")).where(F.trim("record") != "")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, corrupt: str | None = None
) -> DataFrame:
    """The rows of csv files with a header line; without a ``schema`` all columns are text, named by the header.

    A record that does not fit the schema has null where it does not, and goes whole into the column
    ``corrupt`` if that is wanted.
    """
    columns = schema
    if columns is None:
        columns = spark.read.option("header", True).options(**OPTIONS).csv(path).schema
    options = dict(OPTIONS)
    if corrupt is not None:
        columns = T.StructType([field for field in columns.fields if field.name != corrupt])
        columns = columns.add(corrupt, T.StringType())
        options["columnNameOfCorruptRecord"] = corrupt
    # Declared by its own text, as names may hold blanks and dots.
    parsed = F.from_csv("record", _ddl(columns), options)
    return csv_records(spark, path).select(parsed.alias("row")).select("row.*")


def _ddl(columns: T.StructType) -> str:
    names = [field.name.replace("`", "``") for field in columns.fields]
    return ", ".join(f"`{name}` {field.dataType.simpleString()}" for name, field in zip(names, columns.fields))
