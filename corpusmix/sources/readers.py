"""Scans: recipe sources, prepared tables and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmix.functions.fixed_values import SEED
from corpusmix.functions.text import keyed_hash, row_key
from corpusmix.sources.csv_records import read_csv
from corpusmix.sources.published import current_version, is_published, read_version
from corpusmix.sources.recipe import SourceEntry


def read_source(spark: SparkSession, entry: SourceEntry, schema: T.StructType | None = None) -> DataFrame:
    """Scan one source. ``config`` names a folder below the source's path.

    A ``schema``, given here or in the entry, saves a scan that only infers it. The fields of a csv file may hold
    line breaks; where they never do, ``multi_line: false`` in the entry saves the pass that looks for them. What does not
    fit the schema goes into the entry's ``corrupt_column``, if it names one.
    """
    path = f"{entry.path.rstrip('/')}/{entry.config}" if entry.config else entry.path
    columns = entry.schema if schema is None else schema
    if isinstance(columns, str):
        columns = T.StructType.fromDDL(columns)
    if entry.format == "csv" and entry.multi_line:
        return read_csv(spark, path, columns, entry.corrupt_column)
    reader = spark.read.format(entry.format)
    if columns is not None:
        if entry.corrupt_column and entry.format != "parquet":
            columns = T.StructType(columns.fields).add(entry.corrupt_column, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", entry.corrupt_column)
        reader = reader.schema(columns)
    if entry.format == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return reader.load(path)


def with_order_key(df: DataFrame, entry: SourceEntry, seed: int = SEED) -> DataFrame:
    """Add the seeded order of a source's rows, without moving any row.

    Rows with equal keys are copies of each other: the key comes from the
    declared id columns, which must identify a row, or from all columns.
    """
    return df.withColumn("order_key", keyed_hash(seed, row_key(df, entry.id_columns)))


def available_splits(df: DataFrame) -> list[str]:
    """Names of all splits in a prepared table. Reads every file's footer, so only for messages."""
    return sorted(str(row["split"]) for row in df.select("split").distinct().collect())


def _first_available(df: DataFrame, names: tuple[str, ...]) -> str | None:
    """The first of ``names`` with rows. Each look is pruned to one folder and ends at a row."""
    for name in names:
        if not df.where(F.col("split") == name).select("split").isEmpty():
            return name
    return None


def resolve_split(df: DataFrame, requested: str) -> str:
    """The requested split; ``test`` stands in for a missing ``validation``."""
    found = _first_available(df, (requested, "test") if requested == "validation" else (requested,))
    if found is None:
        raise ValueError(f"split {requested!r} is not available, only {', '.join(available_splits(df))}")
    return found


def resolve_held_out_split(df: DataFrame) -> str:
    """``validation`` where there is one, else ``test``."""
    found = _first_available(df, ("validation", "test"))
    if found is None:
        raise ValueError(f"neither a validation nor a test split, only {', '.join(available_splits(df))}")
    return found


def read_prepared(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """A prepared table: ``train``, ``test`` or ``all`` splits of its current version.

    A folder that was never published is read as it is, by its ``split`` folders.
    """
    if is_published(spark, path):
        return read_version(spark, path, current_version(spark, path), split)
    df = spark.read.parquet(path)
    return df if split == "all" else df.where(F.col("split") == split)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
