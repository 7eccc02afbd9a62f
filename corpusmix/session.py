"""Session settings and the shared folder that stages are written to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from types import ModuleType

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
STAGE_CODEC = "zstd"  # for stages with texts, which are most of what a build writes
_LOCAL_FOLDERS: dict[str, str] = {}

# Only what the plans rely on. Partition counts and memory belong to the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Writing by split keeps a file open for each of them instead of sorting the rows.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Call-site capture triples the cost of building a plan from Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "corpusmix", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session without the setting gets a fresh temporary folder of its
    own, kept for as long as it lives; a cluster without it is an error.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="corpusmix-")
        folder = _LOCAL_FOLDERS[application]
    return folder.rstrip("/")


class StageLedger:
    """A folder for written stages that goes away when nobody holds it any more.

    Whoever opens a ledger holds it once. Further readers hold it for as long as they need its
    stages; the last one to let go removes the folder, in whatever store it is.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/corpusmix/{uuid.uuid4().hex}"
        self.holders = 1

    @property
    def is_open(self) -> bool:
        return self.holders > 0

    def release(self) -> None:
        if not self.is_open:
            raise ValueError("the stages have been released already")
        self.holders -= 1
        if not self.holders:
            remove_folder(self.spark, self.folder)

    @contextmanager
    def hold(self) -> Iterator[StageLedger]:
        """The stages stay at least until the end of the block."""
        if not self.is_open:
            raise ValueError("the stages have been released already")
        self.holders += 1
        try:
            yield self
        finally:
            self.release()

    @contextmanager
    def writing(self) -> Iterator[StageLedger]:
        """Stages written in the block belong to this ledger."""
        with self.hold():
            before = _LEDGER.set(self)
            try:
                yield self
            finally:
                _LEDGER.reset(before)


_LEDGER: ContextVar[StageLedger | None] = ContextVar("corpusmix_ledger", default=None)


@contextmanager
def stages(spark: SparkSession) -> Iterator[StageLedger]:
    """All stages written in the block, removed at its end unless someone else holds the ledger."""
    ledger = StageLedger(spark)
    try:
        with ledger.writing():
            yield ledger
    finally:
        ledger.release()


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder in the open ledger, or one that is left for the cluster's clean-up."""
    ledger = _LEDGER.get()
    top = f"{shared_folder(spark)}/corpusmix" if ledger is None else ledger.folder
    return f"{top}/{uuid.uuid4().hex}/{name}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if there is no such path."""
    files, where = _file_system(spark, path)
    if not files.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(where) if entry.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage in a way that survives losing executors, and later
    passes read only the columns they need, unlike a row-wise checkpoint. ``compression`` is
    a Parquet codec, by default the session's.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialize`` of texts, and the values of aggregates over the rows, taken while these are written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    watched = df.observe(seen, *[value.alias(counter) for counter, value in counters.items()])
    return materialize(watched, name, STAGE_CODEC), dict(seen.get)


def pin_small(df: DataFrame, limit: int = 10_000) -> DataFrame:
    """Fetch a result of at most ``limit`` rows so that the planner knows its size.

    The rows come back as a local relation, whose exact size lets Catalyst
    choose a broadcast join by itself. A larger result is returned as the plan
    it was, and joins with it shuffle (adaptive skew handling splits hot keys).
    """
    head = df.limit(limit + 1).toArrow()
    if head.num_rows > limit:
        return df
    return df.sparkSession.createDataFrame(head, schema=df.schema)


def ship_packages(spark: SparkSession, *packages: ModuleType) -> None:
    """Send packages to the Python workers, once per session.

    Needed only for the slots that run a caller's Python on the executors, and
    only where the cluster does not have the packages installed.
    """
    for package in packages:
        folder = os.path.dirname(os.path.abspath(package.__file__))
        archive = f"{package.__name__}-{spark.sparkContext.applicationId}.zip"
        if archive in {os.path.basename(path) for path in spark.sparkContext.listFiles}:
            continue
        path = os.path.join(tempfile.mkdtemp(prefix="corpusmix-"), archive)
        with zipfile.ZipFile(path, "w") as packed:
            for where, _, names in os.walk(folder):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(where, name)
                        packed.write(full, os.path.relpath(full, os.path.dirname(folder)))
        spark.sparkContext.addPyFile(path)
