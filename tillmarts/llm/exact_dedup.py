"""Exact duplicates by a persistent digest index.

The index is a table bucketed and sorted by digest: one row per distinct text ever kept, with the
batch that brought it. A batch is reduced to one row per digest and anti-joined with what other
batches stored (a sort-merge join that reads the index bucket by bucket, without shuffling it); its
fates are written, and only then what is new is appended. ``compact`` leaves one sorted file in
each bucket. All of it is DataFrame operations.

A batch may be repeated, after a failure at any point: what it stored itself does not count as known, and
what is stored already is not appended again, so the fates are the same every time. A batch is
known by ``batch_id`` or, without one, by its rows; batches of equal rows are one batch then.

Defined results: a NULL text counts as empty; empty texts are equal to each other; of equal texts
the row with the largest key stays, a NULL key only where all are NULL; a text the index already
holds keeps the key stored there; repeated rows (equal key and text) count in ``group_size`` and
are all marked as kept by ``dedup``, while ``drop_duplicates`` leaves one of them; an empty
batch gives no rows and appends nothing. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmarts.llm.common import ascii_lower, fresh_name
from tillmarts.storage import materialize

#: Buckets of a new index. An index keeps the number it was made with; about 1 GB of it per bucket
#: and 50 bytes per text make 64 good for a few billion texts.
BUCKETS = 64


def digest_of(text: Column) -> Column:
    """SHA-256 of the lower-cased (A-Z) text in UTF-8, as lower-case hex."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def create_index(spark: SparkSession, index: str, buckets: int = BUCKETS) -> None:
    """An empty index table, if there is none under this name.

    Like any table it lies in the warehouse, which on a cluster must be a shared folder.
    """
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) and not spark.sparkContext.getConf().contains(
        "spark.sql.warehouse.dir"
    ):
        raise RuntimeError("set spark.sql.warehouse.dir to a folder that all executors share")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {index} (digest STRING, keep_id BIGINT, batch STRING) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
    )


def buckets_of(spark: SparkSession, index: str) -> int:
    """The number of buckets the index was made with."""
    rows = spark.sql(f"DESCRIBE FORMATTED {index}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


@contextmanager
def _stored_order(spark: SparkSession) -> Iterator[None]:
    """Scans within tell the planner that a bucket of a single file is sorted, so it isn't sorted again."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def new_digests(spark: SparkSession, index: str, groups: DataFrame, batch: str | None = None) -> DataFrame:
    """Rows of ``groups`` whose digest the index does not hold from another batch: a sort-merge anti-join."""
    held = spark.table(index)
    if batch is not None:
        held = held.filter(F.col("batch") != batch)
    return groups.hint("merge").join(held.select("digest"), "digest", "left_anti")


def _write(rows: DataFrame, index: str, buckets: int, mode: str) -> None:
    """One file per bucket, sorted by digest."""
    # Dealt by the bucket itself, so that a bucket is one task's whatever the number of partitions.
    rows = rows.select("digest", "keep_id", "batch").repartition(buckets, F.pmod(F.hash("digest"), F.lit(buckets)))
    rows.write.mode(mode).format("parquet").bucketBy(buckets, "digest").sortBy("digest").saveAsTable(index)


def append(spark: SparkSession, index: str, fresh: DataFrame, batch: str = "") -> None:
    """Append the (digest, keep_id) rows that the index does not hold yet, a file per bucket."""
    missing = new_digests(spark, index, fresh).withColumn("batch", F.lit(batch))
    _write(missing, index, buckets_of(spark, index), "append")


def compact(spark: SparkSession, index: str, buckets: int | None = None) -> None:
    """Rewrite the index with one sorted file per bucket, if wanted with another number of buckets.

    The new table is complete before it takes the name. If the driver is lost between the two
    renames, the table ``<index>_replaced`` still holds everything.
    """
    new, old = f"{index}_{uuid.uuid4().hex}", f"{index}_replaced"
    create_index(spark, new, buckets or buckets_of(spark, index))
    _write(spark.table(index), new, buckets_of(spark, new), "append")
    spark.sql(f"ALTER TABLE {index} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {index}")
    spark.sql(f"DROP TABLE {old}")


def _name_of(digests: DataFrame) -> str:
    """A name for the rows of a batch, whatever their order: their number and the sums of two hashes."""
    both = [F.sum(F.xxhash64(F.lit(seed), "doc_id", "digest").cast("decimal(38,0)")) for seed in (1, 2)]
    return ":".join(str(v) for v in digests.agg(F.count(F.lit(1)), *both).first())


def dedup(
    spark: SparkSession,
    batch: DataFrame,
    index: str,
    key: str = "doc_id",
    text: str = "text",
    batch_id: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every row of ``batch`` with its fate, after adding the batch's new texts to ``index``.

    Returns doc_id, keep_id, group_size (rows of this batch with the text), kept, text_sha256.
    ``buckets`` is for an index that is made here.
    """
    create_index(spark, index, buckets)
    # Digests are narrow, so they are written once instead of hashing the texts twice.
    digests = materialize(
        batch.select(F.col(key).cast("long").alias("doc_id"), digest_of(F.col(text)).alias("digest")),
        "digests",
    )
    name = batch_id if batch_id is not None else _name_of(digests)
    groups = digests.groupBy("digest").agg(F.max("doc_id").alias("own_id"), F.count(F.lit(1)).alias("group_size"))
    # Another batch's entry decides; without one, this batch's largest key does, stored already or not.
    with _stored_order(spark):
        held = spark.table(index).filter(F.col("batch") != name).select(
            "digest", F.col("keep_id").alias("held_id"), F.lit(True).alias("is_held")
        )
        met = groups.hint("merge").join(held, "digest", "left")
        fates = materialize(
            met.select(
                "digest",
                "group_size",
                F.col("is_held").isNull().alias("is_new"),
                F.when(F.col("is_held"), F.col("held_id")).otherwise(F.col("own_id")).alias("keep_id"),
            ),
            "digest-fates",
        )
        fresh = fates.filter("is_new").select("digest", "keep_id")
        append(spark, index, fresh, name)
    # The batch's rows are on the side that adaptive execution splits where one text is hot.
    return digests.join(fates, "digest", "left").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def dedup_in_batches(
    spark: SparkSession, batches: list[DataFrame], index: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The fates of several batches that meet one index in turn, with group sizes over all of them.

    The index is compacted between batches, so every join reads it in its stored order.
    """
    fates = []
    for number, batch in enumerate(batches):
        if number:
            compact(spark, index)
        # Written, for the index moves on.
        fates.append(materialize(dedup(spark, batch, index, key, text), "batch-fates"))
    rows = fates[0]
    for more in fates[1:]:
        rows = rows.unionByName(more)
    sizes = rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"))
    rows = rows.drop("group_size").join(sizes, "text_sha256", "left")
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_duplicates(
    spark: SparkSession, batch: DataFrame, index: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``batch`` that stay, whole and once each, with the columns they came with."""
    fates = dedup(spark, batch, index, key, text)
    kept = materialize(
        fates.filter("kept").groupBy("text_sha256").agg(F.count(F.lit(1)).alias("ties"), F.max("keep_id").alias("id")),
        "kept-digests",
    )
    digest, ties, number = (fresh_name(batch, n) for n in ("digest", "ties", "number"))
    keep = kept.select(
        F.col("text_sha256").alias(digest), F.col("ties").alias(ties), F.col("id").alias(number)
    )
    rows = batch.withColumn(digest, digest_of(F.col(text))).join(keep, digest)
    rows = rows.filter(F.col(key).cast("long").eqNullSafe(F.col(number))).drop(number)
    single = rows.filter(F.col(ties) == 1).select(batch.columns)
    # Repeated rows, equal in key and text: one of each text, the first by its other columns.
    first = F.min(F.struct(*batch.columns))
    repeated = rows.filter(F.col(ties) > 1).groupBy(digest).agg(first.alias(number)).select(f"{number}.*")
    return single.unionByName(repeated)


def index_exists(spark: SparkSession, index: str) -> bool:
    try:
        spark.table(index).schema
    except AnalysisException as error:
        if error.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
            return False
        raise
    return True
