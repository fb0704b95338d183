"""Incremental loading of arriving cube files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortloom.sources.extracts import headers
from cohortloom.sources.publish import read_if_present

FILES = "path string, modificationTime timestamp, length bigint, content binary"
LEDGER = "path string, modified timestamp, length bigint, header string, loaded boolean, batch_id bigint"
SOURCE = [T.StructField("source_file", T.StringType()), T.StructField("source_path", T.StringType())]
#: Batches of the stream count from 0, those of files written again from here.
REWRITTEN = 1 << 40


def cube_schema(dims: dict[str, str] | list[str]) -> T.StructType:
    """Schema of a cube file: dimensions (strings unless typed), then the count."""
    typed = dims if isinstance(dims, dict) else {d: "string" for d in dims}
    parts = [f"`{name}` {kind}" for name, kind in typed.items()]
    return T.StructType.fromDDL(", ".join([*parts, "cnt bigint"]))


def load_arriving_cubes(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    max_files: int = 1000,
) -> StreamingQuery:
    """Load every ``.csv`` file below ``source`` once into the Parquet table ``target``.

    Processes what has arrived and ends; run it again for later arrivals. The file log in
    the checkpoint remembers loaded files by path. A ledger beside the table knows their
    time and length as well: files that were written again since are loaded first, and
    readers see a path's newest load only. A batch writes its own folders with overwrite,
    so one that is repeated after a failure replaces itself.

    The stream carries file names only. Of each batch, at most ``max_files`` of them, the
    headers are read first: files with the schema's columns, in any order, are loaded, all
    others are listed in ``rejected_files`` and stop nothing. A file written again with
    another header leaves its earlier rows in place.
    """
    root = target.rstrip("/")
    arriving = _files(spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", max_files), source)

    def load(batch: DataFrame, batch_id: int) -> None:
        files = {_plain(r["path"]): r for r in batch.collect()}
        if files:
            _load(batch.sparkSession, files, root, schema, batch_id)

    _load_rewritten(spark, source, root, schema, max_files)
    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _files(reader, source: str) -> DataFrame:
    """(path, modified, length) of the cube files below ``source``; contents are not read."""
    found = reader.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(source)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


# Spark's sources write a path's scheme with one or with three slashes.
_SCHEME = r"^(\w+):/+"


def _plain(path: str) -> str:
    return re.sub(_SCHEME, r"\1:/", path)


def _load(spark: SparkSession, files: dict, root: str, schema: T.StructType, batch_id: int) -> None:
    """Load files (by path) as one batch and enter them in the ledger."""
    found = {_plain(r["path"]): r["header"] for r in headers(spark, [r["path"] for r in files.values()]).collect()}
    good: dict[str, list[str]] = {}
    entries = []
    for path, row in files.items():
        header = found.get(path)
        fits = sorted(_names(header)) == sorted(schema.fieldNames())
        if fits:
            good.setdefault(header, []).append(row["path"])
        entries.append((path, row["modified"], row["length"], header, fits, batch_id))
    loaded = spark.createDataFrame([], T.StructType([*schema.fields, *SOURCE]))
    place = [F.col("_metadata.file_name"), F.regexp_replace("_metadata.file_path", _SCHEME, "$1:/")]
    for header, paths in good.items():
        own = T.StructType([schema[name] for name in _names(header)])
        rows = spark.read.schema(own).option("header", True).csv(paths)
        loaded = loaded.unionByName(rows.withColumns({f.name: c for f, c in zip(SOURCE, place)}))
    loaded.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
    ledger = spark.createDataFrame(entries, LEDGER).drop("batch_id")
    ledger.coalesce(1).write.mode("overwrite").parquet(f"{root}-ledger/batch_id={batch_id}")


def _ledger(spark: SparkSession, target: str) -> DataFrame:
    return read_if_present(spark, f"{target.rstrip('/')}-ledger", T.StructType.fromDDL(LEDGER))


def _load_rewritten(spark: SparkSession, source: str, root: str, schema: T.StructType, max_files: int) -> None:
    """Load the files whose time or length is not that of their newest ledger entry, batch by batch."""
    while True:
        ledger = _ledger(spark, root)
        last = ledger.agg(F.max("batch_id")).first()[0]
        if last is None:
            return
        seen = F.max_by(F.struct("modified", "length"), "batch_id").alias("seen")
        listed = _files(spark.read.format("binaryFile"), source)
        changed = listed.withColumn("key", F.regexp_replace("path", _SCHEME, "$1:/")).join(
            ledger.groupBy(F.col("path").alias("key")).agg(seen), "key").where(F.col("seen") != F.struct("modified", "length"))
        rows = changed.limit(max_files).collect()
        if not rows:
            return
        _load(spark, {r["key"]: r for r in rows}, root, schema, max(last + 1, REWRITTEN))


def _names(header: str | None) -> list[str]:
    return [name.strip().strip('"') for name in (header or "").split(",")]


def rejected_files(spark: SparkSession, target: str) -> DataFrame:
    """(path, header, batch_id) of the files whose header, when last looked at, was not the cube's."""
    newest = _ledger(spark, target).groupBy("path").agg(F.max_by(F.struct("header", "loaded", "batch_id"), "batch_id").alias("e"))
    return newest.select("path", "e.*").where("NOT loaded AND header <> ''").drop("loaded")


def read_loaded_cubes(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Loaded rows with file, path and batch; of a file written again, the newest load's."""
    full = T.StructType([*schema.fields, *SOURCE, T.StructField("batch_id", T.LongType())])
    loads = _ledger(spark, target).where("loaded")
    newer = Window.partitionBy("path").orderBy(F.desc("batch_id"))
    replaced = loads.withColumn("load", F.row_number().over(newer)).where("load > 1").select(
        F.col("path").alias("source_path"), "batch_id")
    return spark.read.schema(full).parquet(target).join(replaced, ["source_path", "batch_id"], "left_anti").select(*full.fieldNames())
