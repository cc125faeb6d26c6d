"""Appends, reloads, upserts and JSON dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmarts.operators.aggregates import distinct_by_key
from tillmarts.sources.columns import fitted
from tillmarts.storage import materialize, shuffles_dropped


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one output partition brought together, so that not every task writes a file to
    every partition; a partition above the advisory size is split over several tasks."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def sink_append(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), columns: str = "equal"
) -> None:
    """Append, creating the table on first use.

    The columns of the first write are the table's: a batch with others is refused, or with
    ``columns="widen"`` adds them; ``read_appended`` shows all columns there are.
    """
    spark = df.sparkSession
    if table_exists(spark, path):
        df, _ = fitted(df, read_appended(spark, path).schema, columns, partition_by)
    with shuffles_dropped(spark):
        _gathered(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with the columns of all its files."""
    return spark.read.option("mergeSchema", True).parquet(path)


def sink_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Truncate and reload."""
    with shuffles_dropped(df.sparkSession):
        _gathered(df, partition_by).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy(*partition_by).parquet(path)


def sink_empty_like(df: DataFrame, path: str) -> None:
    """Create a table with the columns of ``df`` and no rows. Runs nothing of ``df``'s plan."""
    df.sparkSession.createDataFrame([], df.schema).write.mode("ignore").parquet(path)


def sink_json(df: DataFrame, path: str) -> None:
    """Raw records, one JSON object per line, missing fields kept as null."""
    df.write.option("ignoreNullFields", False).json(path)


def sink_model(
    df: DataFrame,
    name: str,
    kind: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """A named result as ``view``, ``table`` (written to ``path``) or ``inline``."""
    if kind == "inline":
        return df
    if kind == "table":
        sink_overwrite(df, path, partition_by)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``. Only a path that is not there counts as absent; a
    folder that holds no readable table is an error, as is any other failure."""
    try:
        spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


# The folder column of tables that no column of their own divides.
BUCKET = "_bucket"


def touched_partitions(base: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The rows of ``base`` in the partitions listed in ``values``, and those of the NULL partition.

    ``values`` is a written table, so at planning time its size is known: as long as it may be
    broadcast it prunes the scan's partitions, and above that it is joined.
    """
    # True for every value but NULL; Spark prunes by values only if a comparison selects them.
    known = values.filter(F.length(F.col(column).cast("string")) >= 0)
    named = base.join(known, column, "left_semi")
    return named.unionByName(base.filter(F.col(column).isNull()))


def upsert(base: DataFrame, staging: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """``base`` with rows of ``staging`` replacing those of equal key, the rest of ``staging`` added.

    A key repeated in ``staging`` would make a MERGE fail; here the row that comes first by
    ``order_by`` is taken. Rows with a NULL key never match, so they are only added.
    """
    source = distinct_by_key(staging.filter(F.col(key).isNotNull()), [key], order_by)
    unkeyed = staging.filter(F.col(key).isNull())
    kept = base.join(source.select(key), key, "left_anti")
    return kept.unionByName(source).unionByName(unkeyed)


def _refuse_moved_keys(base: DataFrame, staging: DataFrame, key: str, column: str) -> None:
    """An error if a key is stored in another partition than the one the batch has for it."""
    keys = staging.filter(F.col(key).isNotNull()).select(key, F.col(column).alias("_to")).distinct()
    stored = base.select(key, F.col(column).alias("_from")).join(keys, key)
    moved = stored.filter(~F.col("_from").eqNullSafe(F.col("_to"))).select(key).limit(5)
    split = keys.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key).limit(5)
    found = [row[0] for row in moved.unionByName(split).take(5)]
    if found:
        raise ValueError(f"{key} {found} would stand in two partitions of {column}")


def sink_upsert(
    path: str,
    staging: DataFrame,
    key: str,
    order_by: Sequence[str],
    partition_by: str | None = None,
    buckets: int = 1,
) -> None:
    """Upsert into the table at ``path``, creating it with the columns of ``staging`` if absent.

    ``partition_by`` is a column fixed by the key, such as the day in ``ad_day`` keys; empty text
    in it is stored as NULL. A key that is stored with another value is refused before anything
    is written. Without it the table is divided into ``buckets`` folders by the key's hash, and
    ``read_upserted`` hides that column. Only folders that the batch touches (and the NULL one) are
    read and replaced. The merged rows are written once, beside the stored ones, which Spark
    swaps when all tasks have ended; until then a failure leaves the table as it was.
    """
    spark = staging.sparkSession
    folder = partition_by or BUCKET
    if partition_by is None:
        staging = staging.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    elif staging.schema[partition_by].dataType == T.StringType():
        staging = staging.withColumn(folder, F.nullif(F.col(folder), F.lit("")))
    staging = materialize(staging, "upsert-staging")
    if table_exists(spark, path):
        base = spark.read.schema(staging.schema).parquet(path)
        if partition_by:
            _refuse_moved_keys(base, staging, key, folder)
        base = touched_partitions(base, materialize(staging.select(folder).distinct(), "touched"), folder)
    else:
        base = staging.limit(0)
    merged = upsert(base, staging, key, order_by).select(*staging.columns)
    with shuffles_dropped(spark):
        _gathered(merged, [folder]).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(folder).parquet(path)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` without the folder column that ``sink_upsert`` may have added."""
    return spark.read.parquet(path).drop(BUCKET)
