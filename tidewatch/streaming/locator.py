"""Where each id of a partitioned table is stored: an append-only table of ids by hash bucket.

Finding out which rows of a micro-batch are new, or which partitions a label belongs to, must not cost a scan of a day or of the log.  The locator has a row
per id (bucket, id, the partition it went to, the batch that brought it), in a folder per bucket.  A batch reads the buckets of its own ids, and of
those the row groups that may hold them; what it reads follows the batch, not the table.

The locator is written before the rows.  A batch that failed in between finds its own name beside its ids when it is replayed, and only then looks for them in the table itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.lake import path_exists

#: Folders of a locator. A batch of fewer ids reads as many folders as it has ids, at most; each batch adds a file to each folder it
#: touches, which ``lake.compact(path, ["bucket"])`` joins.
BUCKETS = 32
#: Ids of a batch up to which they are named to the scan, one by one, so that row groups without them are skipped.
NAMED_IDS = 1_000


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def known(spark: SparkSession, path: str, ids: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame | None:
    """Locator rows of ``ids`` (column ``key``, not NULL); None where there is no locator yet.

    What is collected are bucket numbers, and at most ``NAMED_IDS`` ids.
    """
    if not path_exists(spark, path):
        return None
    wanted = ids.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("id")).distinct()
    numbers = sorted(r[0] for r in wanted.select(bucket_of(F.col("id"), buckets)).distinct().collect())
    held = spark.read.parquet(path).where(F.col("bucket").isin(numbers))
    if len(named := [r["id"] for r in wanted.limit(NAMED_IDS + 1).collect()]) <= NAMED_IDS:
        return held.where(F.col("id").isin(named))
    return held.join(wanted, "id", "left_semi")


def add(path: str, rows: DataFrame, key: str, partition_by: Sequence[str], batch: str, buckets: int = BUCKETS) -> None:
    """Append the ids of ``rows``, sorted within each bucket."""
    wanted = rows.where(F.col(key).isNotNull()).select(
        bucket_of(F.col(key), buckets).alias("bucket"), F.col(key).cast("string").alias("id"), *partition_by, F.lit(batch).alias("batch")
    )
    wanted.repartition("bucket").sortWithinPartitions("bucket", "id").write.mode("append").partitionBy("bucket").parquet(path)


def build(spark: SparkSession, table_path: str, path: str, key: str, partition_by: Sequence[str], buckets: int = BUCKETS) -> None:
    """A locator for a table that has none."""
    add(path, spark.read.parquet(table_path), key, partition_by, "built", buckets)


def partitions_of(spark: SparkSession, path: str, ids: DataFrame, key: str, first: str, buckets: int = BUCKETS) -> list:
    """Distinct values of partition column ``first`` under which ``ids`` are stored."""
    held = known(spark, path, ids, key, buckets)
    return [] if held is None else [r[0] for r in held.select(first).distinct().collect()]
