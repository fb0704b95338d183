"""Line-based inputs: NDJSON with rejects, path routing, resource files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions import scalars
from cohortloom.sources.positions import POSITION, with_position

NDJSON, DATED_TEXT, UNRECOGNISED = "ndjson", "dated_text", "unrecognised"


def input_kind(file_name: str) -> str:
    """Route of a file by name: NDJSON, dated text with a UUID stem, or neither."""
    lower = f"lower({file_name})"
    stem = f"left({file_name}, greatest(length({file_name}) - 4, 0))"
    return (
        f"CASE WHEN {lower} LIKE '%ndjson' OR {lower} LIKE '%gz' THEN '{NDJSON}'"
        f" WHEN {lower} LIKE '%txt' AND {scalars.is_uuid(stem)} THEN '{DATED_TEXT}'"
        f" ELSE '{UNRECOGNISED}' END"
    )


def list_inputs(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, kind) of every file below ``path``; contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))
    return files.withColumn("kind", F.expr(input_kind("substring_index(path, '/', -1)")))


def read_lines(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """(value, position) of the lines of the files of one kind.

    The kind is a filter on file metadata, so other files are dropped before any byte is
    read. Compressed files are recognised by extension.
    """
    lines = spark.read.text(path)
    if kind is not None:
        lines = lines.where(f"{input_kind('_metadata.file_name')} = '{kind}'")
    return with_position(lines)


def parse_lines(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split lines into parsed rows and rejects.

    Rows keep their position. Rejects are (value, position) of lines that are not valid
    JSON for the schema. Both are filters of ``mark_lines``; to use both, write or aggregate
    that one frame, so that lines are scanned and parsed once.
    """
    marked = mark_lines(lines, schema)
    return (
        marked.where("reject IS NULL").select(*schema.fieldNames(), *POSITION),
        marked.where("reject IS NOT NULL").select(F.col("reject").alias("value"), *POSITION),
    )


def mark_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Parsed fields, ``reject`` (the line itself where it is not valid JSON for the schema), position."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = lines.withColumn("row", F.from_json(
        "value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    ))
    bad = F.col("row").isNull() | F.col("row._corrupt").isNotNull()
    keep = [F.col(f"row.{name}").alias(name) for name in schema.fieldNames()]
    return parsed.select(*keep, F.when(bad, F.col("value")).alias("reject"), *POSITION)


def read_ndjson(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Rows and rejects of NDJSON files, plain or gzip."""
    return parse_lines(read_lines(spark, path), schema)


def read_marked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows and rejects of NDJSON files as one frame, from one scan and one parse."""
    return mark_lines(read_lines(spark, path), schema)


def write_ndjson(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write resources as NDJSON; NULL fields are left out. A rerun replaces the output."""
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def write_resource_lines(lines: DataFrame, path: str) -> None:
    """Write (resourceType, value) JSON lines into one folder per resource type."""
    lines.select("resourceType", "value").write.mode("overwrite").partitionBy("resourceType").text(path)


def write_resources(
    resources: Mapping[str, DataFrame], path: str, compression: str | None = None
) -> None:
    """One NDJSON folder per resource type."""
    for name, df in resources.items():
        write_ndjson(df, f"{path.rstrip('/')}/resourceType={name}", compression)
