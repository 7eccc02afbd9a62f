"""Prepared tables with versions: written aside, then switched to as a whole.

Below the path of a table, ``data/<id>`` holds the files of one version and their list, and ``versions/v=<n>`` a
single document that names the version's folders and row counts. That document is written last, and a
version counts from the moment it is there; so a write that fails half-way leaves the table as it was,
and readers of an older version keep their files. One writer at a time is assumed.

Every version has an order of its rows: that of its files, as listed, and of the rows in each.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.text import keyed_hash
from corpusmix.session import folder_names, path_exists, remove_folder

ROWS_PER_FILE = 1_000_000
GATHERED_SHARE = 1 / 8  # of all rows, at most, that are written a second time
SHUFFLE_SEED = f"{fixed.SEED}/shuffle"

PART = "split string, folder string, rows bigint, files bigint"
VERSION = (
    f"version bigint, id string, shuffled boolean, columns string, parts array<struct<{PART}>>, counts map<string, bigint>"
)


@dataclass(frozen=True)
class Part:
    split: str | None
    folder: str
    rows: int
    files: int


@dataclass(frozen=True)
class Version:
    """What the document of a version says."""

    version: int
    id: str
    shuffled: bool
    schema: T.StructType
    parts: tuple[Part, ...]
    counts: dict[str, int]

    @property
    def splits(self) -> list[str]:
        return sorted(str(part.split) for part in self.parts)


def is_published(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/versions")


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions of a table, oldest first. A document that is not whole does not count."""
    if not is_published(spark, path):
        return []
    read = spark.read.schema(VERSION).option("recursiveFileLookup", True).json(f"{path}/versions")
    found = read.where(F.col("version").isNotNull() & F.col("parts").isNotNull()).collect()
    return sorted(
        (
            Version(
                row["version"],
                row["id"],
                row["shuffled"],
                T.StructType.fromJson(json.loads(row["columns"])),
                tuple(Part(**part.asDict()) for part in row["parts"]),
                dict(row["counts"] or {}),
            )
            for row in found
        ),
        key=lambda version: version.version,
    )


def current_version(spark: SparkSession, path: str) -> Version:
    found = versions(spark, path)
    if not found:
        raise ValueError(f"nothing has been published at {path}")
    return found[-1]


def shuffle_key(key: str = "pair_hash", seed: object = SHUFFLE_SEED) -> Column:
    """The seeded random order in which rows are written."""
    return keyed_hash(seed, F.col(key))


def _listed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """``split, name, rows, place`` of the files below ``folder``; reads only their footers."""
    columns = T.StructType([field for field in schema.fields if field.name != "split"])
    rows = spark.read.schema(columns.add("split", T.StringType())).parquet(folder)
    counted = rows.groupBy("split", F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("rows"))
    # Files are numbered by their task and, within a task, from c000.
    task = F.regexp_extract("name", r"^part-(\d+)", 1).cast("bigint").alias("task")
    more = F.regexp_extract("name", r"[.-]c(\d+)(?:\.[a-z0-9]+)?\.parquet$", 1)
    within = F.coalesce(F.nullif(more, F.lit("")).cast("bigint"), F.lit(0)).alias("within")
    return counted.withColumn("place", F.struct(task, within))


def publish(
    df: DataFrame,
    path: str,
    order: Column | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    counters: dict[str, Column] | None = None,
) -> Version:
    """Write ``df`` as the next version of the table at ``path``, by its column ``split``.

    Without an ``order`` rows are written where they are, with no shuffle; a small split, such as the few test rows
    that every task meets, is then gathered into as many files as its rows need. With one, all splits are range-partitioned and sorted by it in one pass, so their
    files, in their order, hold the rows in that order. ``counters`` are aggregates over all rows, taken
    while these are written and kept in the version's document.
    """
    spark = df.sparkSession
    schema = T.StructType([field for field in df.schema.fields if field.name != "split"])
    made = uuid.uuid4().hex
    folder = f"{path}/data/{made}"
    if order is None:
        placed = df
    else:
        wanted = -(-df.count() // rows_per_file)
        drawn = df.withColumn("_draw", order)
        placed = drawn.repartitionByRange(max(wanted, 1), "split", "_draw").sortWithinPartitions("split", "_draw")
        placed = placed.drop("_draw")
    seen = Observation(f"publish-{made}")
    if counters:
        placed = placed.observe(seen, *[value.cast("bigint").alias(name) for name, value in counters.items()])
    placed.write.option("maxRecordsPerFile", rows_per_file).partitionBy("split").parquet(f"{folder}/rows")
    listed = _listed(spark, f"{folder}/rows", schema).withColumn("folder", F.lit("rows"))
    listed.write.parquet(f"{folder}/listed")
    files = spark.read.schema(listed.schema).parquet(f"{folder}/listed")
    parts = []
    lists = []
    found = _per_split(files)
    total = sum(line["rows"] for line in found)
    for line in found:
        split, rows, count = line["split"], line["rows"], line["files"]
        wanted = -(-rows // rows_per_file)
        own = files.where(F.col("split").eqNullSafe(split))
        where = f"rows/{_partition(split)}"
        if order is None and count > wanted and rows <= total * GATHERED_SHARE:
            where = f"gathered/{_partition(split)}"
            scattered = spark.read.schema(schema).parquet(f"{folder}/rows/{_partition(split)}")
            scattered.repartition(wanted).write.parquet(f"{folder}/{where}")
            own = _listed(spark, f"{folder}/gathered", schema).where(F.col("split").eqNullSafe(split))
            own = own.withColumn("folder", F.lit("gathered"))
            count = wanted
            remove_folder(spark, f"{folder}/rows/{_partition(split)}")
        parts.append(Part(split, where, rows, count))
        lists.append(own)
    if lists:
        first = F.sum("rows").over(Window.partitionBy("split").orderBy("place")) - F.col("rows")
        every = reduce(DataFrame.unionByName, lists)
        every.withColumn("first_row", first).write.parquet(f"{folder}/files")
    counts = dict(seen.get) if counters else {}
    return _commit(spark, path, made, order is not None, schema, parts, counts)


def _per_split(files: DataFrame) -> list:
    """One line per split: there are as many as names of splits."""
    totals = files.groupBy("split").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))
    return totals.orderBy("split").collect()


def _partition(split: str | None) -> str:
    if split is None:
        return "split=__HIVE_DEFAULT_PARTITION__"
    if not split.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"a split must have a plain name, not {split!r}")
    return f"split={split}"


def _commit(
    spark: SparkSession,
    path: str,
    made: str,
    shuffled: bool,
    schema: T.StructType,
    parts: list[Part],
    counts: dict[str, int],
) -> Version:
    """The switch: one small file, which Spark moves into place when it is whole."""
    before = versions(spark, path)
    number = before[-1].version + 1 if before else 1
    version = Version(number, made, shuffled, schema, tuple(parts), counts)
    line = (number, made, shuffled, schema.json(), [(p.split, p.folder, p.rows, p.files) for p in parts], counts)
    # A folder of this number without a document is left of a write that did not finish.
    remove_folder(spark, f"{path}/versions/v={number}")
    spark.createDataFrame([line], VERSION).coalesce(1).write.json(f"{path}/versions/v={number}")
    return version


def read_version(spark: SparkSession, path: str, version: Version, split: str = "all") -> DataFrame:
    """The rows of a version with their ``split``; only the folders of the wanted split are opened."""
    parts = [part for part in version.parts if split in ("all", part.split) and part.rows]
    if not parts:
        return spark.createDataFrame([], version.schema).withColumn("split", F.lit(split))
    frames = [
        spark.read.schema(version.schema)
        .parquet(f"{path}/data/{version.id}/{part.folder}")
        .withColumn("split", F.lit(part.split).cast("string"))
        for part in parts
    ]
    return reduce(DataFrame.unionByName, frames)


def read_in_order(spark: SparkSession, path: str, split: str, version: Version | None = None) -> DataFrame:
    """The rows of a split with ``row_at``, their place in the order of the version, from 0.

    A row's place is the first place of its file and its own place there, so nothing is sorted.
    """
    version = version or current_version(spark, path)
    files = spark.read.parquet(f"{path}/data/{version.id}/files").where(F.col("split") == split)
    firsts = files.select(F.col("name").alias("_name"), F.col("first_row").alias("_first"))
    rows = read_version(spark, path, version, split)
    at = rows.select("*", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_index"))
    joined = at.join(firsts, "_name")
    return joined.withColumn("row_at", F.col("_first") + F.col("_index")).drop("_name", "_first", "_index")


def clean_up(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove what no kept version needs: older versions, and what failed writes have left. Returns the removed ids.

    Readers of a removed version lose their files, so keep as many versions as may still be read.
    """
    known = versions(spark, path)
    kept = known[-keep:] if keep > 0 else known
    for version in known[: len(known) - len(kept)]:
        remove_folder(spark, f"{path}/versions/v={version.version}")
    numbers = {f"v={version.version}" for version in kept}
    for name in folder_names(spark, f"{path}/versions"):
        if name not in numbers:
            remove_folder(spark, f"{path}/versions/{name}")
    gone = sorted(set(folder_names(spark, f"{path}/data")) - {version.id for version in kept})
    for name in gone:
        remove_folder(spark, f"{path}/data/{name}")
    return gone
