"""State kept in plain parquet folders: pinned snapshots, label merges, run tags, maintenance."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import labels
from tidewatch.operators.validate import two_class_check
from tidewatch.sources.writers import write_table

SNAPSHOT_LOG = "table string, snapshot_id string, committed_at timestamp_ntz, path string"


def _fs(spark: SparkSession, path: str):
    """Hadoop file system and path object, so object stores and HDFS work alike."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


# -- snapshots ------------------------------------------------------------------------------------


def snapshot(df: DataFrame, root: str, table: str, committed_at: datetime | str) -> str:
    """Write an immutable copy and log it; returns the snapshot id.

    The log row is written after the data, so a failed write leaves an unlogged folder that
    :func:`vacuum` removes.
    """
    spark = df.sparkSession
    snapshot_id = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/{table}/snapshots/{snapshot_id}"
    df.write.parquet(path)
    log = spark.range(1).select(
        F.lit(table).alias("table"),
        F.lit(snapshot_id).alias("snapshot_id"),
        F.lit(str(committed_at)).cast("timestamp_ntz").alias("committed_at"),
        F.lit(path).alias("path"),
    )
    log.write.mode("append").parquet(f"{root.rstrip('/')}/{table}/log")
    return snapshot_id


def snapshots(spark: SparkSession, root: str, table: str) -> DataFrame:
    path = f"{root.rstrip('/')}/{table}/log"
    if not path_exists(spark, path):
        return spark.createDataFrame([], SNAPSHOT_LOG)
    return spark.read.schema(SNAPSHOT_LOG).parquet(path)


def current_snapshot_id(spark: SparkSession, root: str, table: str) -> str | None:
    row = snapshots(spark, root, table).agg(F.max_by("snapshot_id", F.struct("committed_at", "snapshot_id")).alias("id")).first()
    return row["id"]


def read_snapshot(spark: SparkSession, root: str, table: str, snapshot_id: str | None = None) -> DataFrame:
    """The table as of a pinned snapshot, or its latest one when none is pinned."""
    chosen = snapshot_id or current_snapshot_id(spark, root, table)
    if chosen is None:
        raise FileNotFoundError(f"{table} has no snapshot under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{table}/snapshots/{chosen}")


def read_version(spark: SparkSession, table: str, version: str | None = None) -> DataFrame:
    """The same for a catalog whose tables support time travel."""
    return spark.sql(f"SELECT * FROM {table}" + (f" VERSION AS OF {version}" if version else ""))


def expire_snapshots(
    spark: SparkSession, root: str, table: str, now: datetime, older_than_days: int = 7, pinned: Sequence[str] = ()
) -> list[str]:
    """Delete snapshot folders older than the limit; never pinned ones, never the latest.

    Reads one short log row per snapshot.
    """
    rows = snapshots(spark, root, table).collect()
    latest = current_snapshot_id(spark, root, table)
    limit = now - timedelta(days=older_than_days)
    keep = set(pinned) | {latest}
    gone = [r["snapshot_id"] for r in rows if r["committed_at"] < limit and r["snapshot_id"] not in keep]
    for snapshot_id in gone:
        delete_path(spark, f"{root.rstrip('/')}/{table}/snapshots/{snapshot_id}")
    return sorted(gone)


def vacuum(spark: SparkSession, root: str, table: str) -> list[str]:
    """Delete snapshot folders the log does not know (left by failed writes)."""
    folder = f"{root.rstrip('/')}/{table}/snapshots"
    known = {r["snapshot_id"] for r in snapshots(spark, root, table).select("snapshot_id").collect()}
    orphans = [n for n in child_folders(spark, folder) if n not in known]
    for name in orphans:
        delete_path(spark, f"{folder}/{name}")
    return orphans


def compact(spark: SparkSession, path: str, partition_by: Sequence[str], where: str | None = None) -> None:
    """Rewrite the chosen partitions into fewer files.

    Rows are rebalanced by partition value: small partitions end as one file, large ones as files of
    the size set by ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.  ``where`` chooses whole
    partitions, so it may name partition columns only; anything else is an error, as the overwrite
    would delete the rows it leaves out.
    """
    rows = spark.read.parquet(path)
    if where:
        if not partition_by:
            raise ValueError("an unpartitioned table is compacted as a whole")
        try:
            spark.createDataFrame([], rows.select(*partition_by).schema).where(where).schema  # noqa: B018
        except AnalysisException as e:
            raise ValueError(f"only partition columns ({', '.join(partition_by)}) can choose what is compacted: {where}") from e
        rows = rows.where(where)
    _overwrite(rows, path, partition_by)


def _overwrite(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace partitions of ``path`` by ``rows`` that were read from it.

    They are staged beside the table first, as no job may overwrite what it reads.  The copy is deleted
    once the table is complete; after a failure it stays, for it may hold the only whole version.
    """
    spark = rows.sparkSession
    staging = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex}"
    rows.write.parquet(staging)
    write_table(spark.read.schema(rows.schema).parquet(staging), path, "overwrite", partition_by)
    delete_path(spark, staging)


# -- label merge and run tags ---------------------------------------------------------------------


def merge_labels_into(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    partition_by: Sequence[str] = ("request_date", "endpoint_name"),
    force: bool = False,
    as_of: datetime | str | None = None,
    window_hours: int | None = None,
    dry_run: bool = False,
    days_of: Callable[[DataFrame], list] | None = None,
) -> int:
    """Merge labels into a partitioned prediction log; returns the number of changed predictions.

    Only partitions that hold a changed prediction are rewritten; NULL is a partition value like any
    other.  What is collected is the list of those partitions.  If every update carries a
    ``prediction_timestamp``, only the days they name are searched; else those that ``days_of`` finds for the ids of the
    updates (see ``streaming.locator.partitions_of``), and without it the whole log.
    """
    table = spark.read.parquet(path)
    recent = labels.recent_updates(updates, as_of, window_hours)
    latest = labels.latest_labels(recent)
    candidates = table if force else table.where("ground_truth is null")
    named = [None]
    if "prediction_timestamp" in recent.columns:
        named = [r["day"] for r in recent.select(F.to_date("prediction_timestamp").alias("day")).distinct().collect()]
    if None in named and days_of is not None:
        named = [day for day in days_of(latest) if day is not None]
    if None not in named:
        candidates = candidates.where(F.col(partition_by[0]).isin(named) | F.col(partition_by[0]).isNull())
    hit = candidates.join(latest.select("inference_id"), "inference_id", "left_semi")
    touched = hit.groupBy(*partition_by).agg(F.count("*").alias("__n")).collect()
    changed = sum(r["__n"] for r in touched)
    if dry_run or not touched:
        return changed
    first = F.col(partition_by[0])
    days = {r[partition_by[0]] for r in touched}
    # Literal partition values prune the scan to the affected folders.
    chosen = first.isin(sorted(days - {None}))
    affected = table.where(chosen | first.isNull() if None in days else chosen)
    if len(partition_by) > 1:
        keys = spark.createDataFrame([tuple(r[p] for p in partition_by) for r in touched], table.select(*partition_by).schema)
        keys = keys.withColumnsRenamed({p: f"__{p}" for p in partition_by})
        affected = affected.join(keys, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in partition_by], "left_semi")
    _overwrite(labels.merge_labels(affected, updates, force, as_of, window_hours), path, partition_by)
    return changed


def append_run_membership(windows: DataFrame, path: str) -> None:
    """Run tags as an append-only table of (endpoint, run, lo, hi]; applied when the log is read."""
    windows.write.mode("append").parquet(path)


# -- seeding --------------------------------------------------------------------------------------


def seed_split(
    typed: DataFrame, root: str, target: str, committed_at: datetime | str, force: bool = False
) -> str:
    """Fill training and evaluation tables from rows with a ``split`` column.

    Skips when both tables hold both classes already, else replaces and checks again.  Returns
    ``skipped`` or ``seeded``.
    """
    spark = typed.sparkSession
    names = {"training_data": "train", "evaluation_data": "eval"}

    def healthy() -> bool:
        if any(current_snapshot_id(spark, root, n) is None for n in names):
            return False
        tables = {n: read_snapshot(spark, root, n) for n in names}
        return all(r["ok"] for r in two_class_check(tables, target).collect())

    if not force and healthy():
        return "skipped"
    for name, side in names.items():
        snapshot(typed.where(F.col("split") == side).drop("split"), root, name, committed_at)
    if not healthy():
        raise ValueError("a split table lacks a class after seeding")
    return "seeded"
