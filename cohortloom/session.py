"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library is tuned for. All are runtime SQL settings.
#  - AQE picks broadcast joins from measured sizes, merges small partitions and splits
#    skewed join partitions, also where a later aggregation needs another exchange.
#  - UTC keeps date arithmetic independent of the machine.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared folder ``spark.checkpoint.dir``.

    Where that is unset, the session's warehouse, which Spark shares as well, holds the
    folder; nothing is ever written to a machine's own temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    return f"{root.rstrip('/')}/work-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
