"""Stored tables in the session catalog: external tables with statistics, and bucketed facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Column types that the planner keeps statistics of.
COUNTED = (T.StringType, T.IntegerType, T.LongType, T.DoubleType, T.BooleanType, T.DateType, T.TimestampType)


def register_tables(spark: SparkSession, database: str, folders: Mapping[str, tuple[str, T.StructType]]) -> None:
    """Declare Parquet folders as external tables ``database.name``, with statistics for the planner.

    ``folders`` holds (folder, schema) by table. A table that exists is declared anew; its data are
    not touched. Sizes, row counts and the statistics of flat columns let the planner pick join
    sides and broadcasts, which it cannot see in the files of nested tables.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, (folder, schema) in folders.items():
        table = f"`{database}`.`{name}`"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(f"{database}.{name}", path=folder, source="parquet", schema=schema)
        flat = [f"`{f.name}`" for f in schema.fields if isinstance(f.dataType, COUNTED)]
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (f" FOR COLUMNS {', '.join(flat)}" if flat else ""))


def store_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` as table ``database.name``, bucketed by ``keys``, and read from there.

    Tables of the same keys and number of buckets join and aggregate by the keys without an
    exchange. Rows are exchanged once, here, so that every bucket is one file. A bucket is read by
    one task; take as many as keep one within an executor's memory.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{table.split('.')[0]}`")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).format("parquet").saveAsTable(table)
    return spark.table(table)
