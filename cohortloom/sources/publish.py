"""Making finished data visible by a last write.

Data goes to a folder of its own name, and then one row that names the folder is appended
to the list beside it. A run that ends in between leaves no row, so a half-written folder
is never read; two writers append two rows and overwrite nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "name string, published_at timestamp"


def read_if_present(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of a Parquet folder; none if there is no such folder."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def publish(spark: SparkSession, path: str, name: str) -> None:
    now = dt.datetime.now(dt.timezone.utc)
    row = spark.createDataFrame([(name, now)], SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/published")


def _one(spark: SparkSession, path: str, *order) -> str | None:
    rows = read_if_present(spark, f"{path.rstrip('/')}/published", SCHEMA).orderBy(*order).limit(1).collect()
    return rows[0]["name"] if rows else None


def first_published(spark: SparkSession, path: str) -> str | None:
    return _one(spark, path, "published_at", "name")


def last_published(spark: SparkSession, path: str) -> str | None:
    return _one(spark, path, F.desc("published_at"), F.desc("name"))
