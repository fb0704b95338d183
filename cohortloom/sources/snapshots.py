"""Versions of a Parquet table: one folder per write, and a small table of what was done.

A table has one writer at a time. Data of a version lie in ``version=N``; the history row that
names it is written after them, so a write that was interrupted is not read, and the next one
takes its folder. A restore is a history row for older data, which stay where they are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortloom.sources.publish import read_if_present

HISTORY = "version long, committed_at timestamp, operation string, source_version long, rows long"


def _history_path(path: str) -> str:
    return f"{path.rstrip('/')}/history"


def _data_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """(version, committed_at, operation, source_version, rows), one row per write or restore."""
    return read_if_present(spark, _history_path(path), HISTORY)


def _one(history: DataFrame):
    """Newest matching history row, or None."""
    rows = history.orderBy(F.desc("version")).limit(1).collect()
    return rows[0] if rows else None


def _enter(spark: SparkSession, path: str, operation: str, source_version: int | None, rows: int, at: dt.datetime | None) -> int:
    last = _one(snapshot_history(spark, path))
    version = last["version"] + 1 if last else 0
    row = (version, at or dt.datetime.now(dt.timezone.utc), operation, version if source_version is None else source_version, rows)
    spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("append").parquet(_history_path(path))
    return version


def write_snapshot(
    df: DataFrame, path: str, committed_at: dt.datetime | None = None, balanced: bool = False
) -> int:
    """Write ``df`` as the newest version and return its number.

    Rows are counted by the write itself. ``balanced`` makes files of about equal size.
    """
    spark = df.sparkSession
    last = _one(snapshot_history(spark, path))
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    out = counted.hint("rebalance") if balanced else counted
    out.write.mode("overwrite").parquet(_data_path(path, last["version"] + 1 if last else 0))
    return _enter(spark, path, "write", None, seen.get["rows"], committed_at)


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or the given one."""
    history = snapshot_history(spark, path)
    if version is not None:
        history = history.where(F.col("version") == version)
    row = _one(history)
    if row is None:
        raise ValueError(f"no such version of {path}: {version}")
    return spark.read.parquet(_data_path(path, row["source_version"]))


def snapshot_changes(spark: SparkSession, path: str, old: int, new: int) -> DataFrame:
    """Rows that one version has more often than another: ``change`` is added or removed, ``n`` how often."""
    both = read_snapshot(spark, path, new).withColumn("n", F.lit(1)).unionByName(
        read_snapshot(spark, path, old).withColumn("n", F.lit(-1)))
    sums = both.groupBy(*[c for c in both.columns if c != "n"]).agg(F.sum("n").alias("n")).where("n <> 0")
    return sums.withColumn("change", F.expr("IF(n > 0, 'added', 'removed')")).withColumn("n", F.abs("n"))


def restore_version(
    spark: SparkSession, path: str, version: int, committed_at: dt.datetime | None = None
) -> int:
    """Make an older version the newest one; history is kept."""
    target = _one(snapshot_history(spark, path).where(F.col("version") == version))
    if target is None:
        raise ValueError(f"no version {version} of {path}")
    return _enter(spark, path, "restore", target["source_version"], target["rows"], committed_at)


def restore_timestamp(
    spark: SparkSession, path: str, moment: str | dt.datetime, committed_at: dt.datetime | None = None
) -> int:
    """Restore the last version committed at or before a moment."""
    history = snapshot_history(spark, path)
    target = _one(history.where(F.col("committed_at") <= F.lit(moment).cast("timestamp")))
    if target is None:
        raise ValueError(f"{path} has no version at or before {moment}")
    return _enter(spark, path, "restore", target["source_version"], target["rows"], committed_at)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file) of the live data files; a listing, no data is read."""
    row = _one(snapshot_history(spark, path))
    if row is None:
        raise ValueError(f"{path} has no version")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return files.load(_data_path(path, row["source_version"])).select(F.col("path").alias("file"))


def write_manifest(spark: SparkSession, path: str, target: str) -> None:
    """Write the live data files as text, one path per line."""
    manifest(spark, path).coalesce(1).write.mode("overwrite").text(target)
