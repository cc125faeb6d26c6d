"""Tables, seeds, landed API pages and generated date series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmarts.schemas import COLOUR_SEED

# The column for the text of a malformed record.
_BROKEN = "_broken"


def scan_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_rename(df: DataFrame, names: Mapping[str, str], **casts: str) -> DataFrame:
    """Only the columns in ``names``, under their business names, cast where asked."""
    return df.select(
        [
            (F.col(old).cast(casts[new]) if new in casts else F.col(old)).alias(new)
            for old, new in names.items()
        ]
    )


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType = COLOUR_SEED) -> DataFrame:
    """A CSV with a header line. Columns are taken by position, so stray blanks in the header
    names do not matter."""
    return (
        spark.read.option("header", True).option("enforceSchema", True).schema(schema).csv(path)
    )


def _pages(
    spark: SparkSession, path: str, item: T.DataType, field: str, multi_line: bool, mode: str
) -> DataFrame:
    """Landed pages as rows of the list in ``field`` and the record's text where it is malformed."""
    page = T.StructType([T.StructField(field, T.ArrayType(item)), T.StructField(_BROKEN, T.StringType())])
    options = {"multiLine": multi_line, "mode": mode, "columnNameOfCorruptRecord": _BROKEN}
    return spark.read.schema(page).options(**options).json(path)


def read_json_pages(
    spark: SparkSession,
    path: str,
    item: T.DataType,
    field: str = "items",
    multi_line: bool = False,
) -> DataFrame:
    """Landed API pages ``{field: [..]}`` flattened to one row per item. A malformed page is an
    error; ``split_json_pages`` sets such pages apart instead."""
    pages = _pages(spark, path, item, field, multi_line, "FAILFAST")
    return pages.select(F.explode(field).alias("item")).select("item.*")


def split_json_pages(
    spark: SparkSession,
    path: str,
    item: T.DataType,
    field: str = "items",
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The items of well-formed pages, and the text of the malformed ones in ``record``."""
    pages = _pages(spark, path, item, field, multi_line, "PERMISSIVE")
    # The list stands in both conditions because Spark does not read the text column alone.
    good = pages.filter(F.col(_BROKEN).isNull()).select(F.explode(field).alias("item")).select("item.*")
    bad = pages.filter(F.col(_BROKEN).isNotNull() & (F.col(field).isNull() | F.col(field).isNotNull()))
    return good, bad.select(F.col(_BROKEN).alias("record"), field).drop(field)


def date_series(
    spark: SparkSession,
    start: dt.date | str,
    end: dt.date | str,
    name: str = "fecha",
) -> DataFrame:
    """One row per day, both ends included."""
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("first"), F.lit(str(end)).cast("date").alias("last")
    )
    return series_between(bounds, F.col("first"), F.col("last"), name)


def series_between(df: DataFrame, first: Column, last: Column, name: str = "fecha") -> DataFrame:
    """One row per day or integer between two columns of each row of ``df``."""
    return df.select(F.explode(F.sequence(first, last)).alias(name))
