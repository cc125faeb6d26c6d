"""Small helpers that several operators share."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, wherever an operator counts or cuts words.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
LOWERED = str.maketrans(UPPER, LOWER)


_shipped: set[str] = set()


#: Bytes of a batch of rows on its way to a Python worker, at most; Spark's own bound is 64 MB.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_code(spark: SparkSession) -> None:
    """Hand this library to the Python workers, once per application, wherever the driver found it.

    Also lowers the bound of what is handed over at a time: a batch stands in memory several times over,
    in the executor and in the worker.
    """
    if int(spark.conf.get(_BATCH_SETTING).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    # The driver serves this file to executors for as long as the application runs.
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed; NULL stays NULL.

    Where every code point is one byte, ``lower`` does just that and is much cheaper.
    """
    one_byte = F.length(text) == F.octet_length(text)
    return F.when(one_byte, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def unit_interval(*parts: Column, seed: str) -> Column:
    """A number in [0, 1) fixed by ``parts`` and ``seed``; 52 bits of an MD5, so SQL can repeat it."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts], F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def map_batches(
    df: DataFrame,
    schema: str,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> DataFrame:
    """``mapInArrow`` with a function of this library."""
    ship_code(df.sparkSession)
    return df.mapInArrow(function, schema)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], least: int
) -> Iterator[pa.Table]:
    """Rows that come sorted by ``keys``, in tables that end where a group ends.

    A table has ``least`` rows, or up to one group more; the last one may have fewer.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= least:
            rows = pa.Table.from_batches(held)
            at, last = size, [rows.column(k)[-1].as_py() for k in keys]
            while at and [rows.column(k)[at - 1].as_py() for k in keys] == last:
                at -= 1
            if at:
                yield rows.slice(0, at).combine_chunks()
            held, size = rows.slice(at).to_batches(), size - at
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
