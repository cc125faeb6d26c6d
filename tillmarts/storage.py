"""Written tables in the folder that all executors share.

A table written here replaces a long lineage: it survives the loss of an executor, is parsed
once, and gives the planner real file sizes, so whether a join side is broadcast is decided
against ``spark.sql.autoBroadcastJoinThreshold`` instead of by a hint.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

#: The session setting by which Spark deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_folder: dict[str, str] = {}
_staged: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}
_schemas: dict[tuple[str, str], T.StructType] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a session within one process gets a temporary folder of its own; on a
    cluster, whose executors would not find what others wrote there, that is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="tillmarts-")
    return _own_folder[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written yet, under a folder of this application."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tillmarts/{app}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in this block leave no shuffle files behind.

    Otherwise these stay until the driver happens to collect its garbage, so a job of many steps holds the
    shuffles of all of them on disk.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def packed(df: DataFrame) -> DataFrameWriter:
    """The writer of ``df`` for tables of texts, with the codec that takes the least disk."""
    return df.write.option("compression", "zstd")


def _write(df: DataFrame, path: str) -> None:
    with shuffles_dropped(df.sparkSession):
        packed(df).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh path and return the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    _write(df, path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as a written table that is deleted at the end of the block."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    _write(df, path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def staged(
    spark: SparkSession,
    source: str,
    label: str,
    build: Callable[[], DataFrame],
) -> DataFrame:
    """``materialize(build())``, written once per application, source folder and label."""
    key = (spark.sparkContext.applicationId, source, label)
    if key not in _staged:
        path = fresh_path(spark, label)
        df = build()
        _write(df, path)
        _staged[key] = (path, df.schema)
    path, schema = _staged[key]
    return spark.read.schema(schema).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table whose schema is looked up once per application, not on every read.

    For tables that do not change while the application runs, such as the test tables.
    """
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def forget_staged() -> None:
    """Build staged tables anew on their next use."""
    _staged.clear()
