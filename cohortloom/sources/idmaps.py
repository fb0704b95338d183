"""Maps from natural keys to pseudonymous ids."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import scalars
from cohortloom.sources.positions import POSITION, with_position
from cohortloom.sources.publish import first_published, publish
from cohortloom.sources.records import gather, with_starts

SCHEMA = "source_id string, uuid string"


def cohort_id_map(cohort: DataFrame, key: str, kind: str, salt: str) -> DataFrame:
    """(source_id, uuid) of the distinct keys of a cohort."""
    keys = cohort.select(F.col(key).alias("source_id")).where(F.col("source_id").isNotNull()).distinct()
    return keys.selectExpr("source_id", f"{scalars.pseudonym(kind, 'source_id', salt)} AS uuid")


def extend_id_map(existing: DataFrame, cohort: DataFrame, key: str, kind: str, salt: str) -> DataFrame:
    """The existing map plus ids for keys it does not hold; existing ids never change."""
    fresh = cohort_id_map(cohort, key, kind, salt).join(existing, "source_id", "left_anti")
    return existing.select("source_id", "uuid").unionByName(fresh)


def has_id_map(spark: SparkSession, path: str) -> bool:
    return first_published(spark, path) is not None


def save_id_map(id_map: DataFrame, path: str) -> bool:
    """Write the map unless one is published: a cohort is frozen once assigned.

    Of two writers the first to publish wins. Returns whether this map is the one in use.
    """
    spark = id_map.sparkSession
    if has_id_map(spark, path):
        return False
    name = f"map-{uuid.uuid4().hex}"
    id_map.write.parquet(f"{path.rstrip('/')}/{name}")
    publish(spark, path, name)
    return first_published(spark, path) == name


def load_id_map(spark: SparkSession, path: str) -> DataFrame:
    name = first_published(spark, path)
    if name is None:
        raise ValueError(f"no id map was published in {path}")
    return spark.read.schema(SCHEMA).parquet(f"{path.rstrip('/')}/{name}")


# Whether a piece has an odd number of quotes that no backslash precedes.
_ODD_QUOTES = r"(length(regexp_replace(value, '(?s)\\\\.|[^\"\\\\]+', '')) % 2 = 1)"


def import_json_id_map(spark: SparkSession, path: str) -> DataFrame:
    """One-off import of a map kept as one JSON object of keys and ids, or as a folder of them.

    The object is read in splits at its commas, so it may be of any size, and keys may hold
    commas, quotes and escapes: a comma inside a string is told by the quotes before it, which are
    composed over the pieces of a split and over the splits of a file. Of a repeated key the last
    id stays, as in any JSON reader. A piece that is not one entry is an error.
    """
    pieces = with_position(spark.read.option("lineSep", ",").text(path))
    entries = gather(with_starts(pieces, _ODD_QUOTES, f"NOT {_ODD_QUOTES}"), ",").withColumn(
        "value", F.expr(r"regexp_replace(value, '^\\s*\\{|\\}\\s*$', '')")).where(r"value NOT RLIKE '^\\s*$'")
    parsed = entries.withColumn("entry", F.from_json(F.concat(F.lit("{"), "value", F.lit("}")), "map<string, string>"))
    known = parsed.withColumn("entry", F.expr(
        "IF(coalesce(cardinality(entry) = 1, FALSE), entry, raise_error(concat('not an entry: ', value)))"))
    rows = known.selectExpr(*POSITION, "map_keys(entry)[0] AS source_id", "map_values(entry)[0] AS uuid")
    return rows.groupBy("source_id").agg(F.max_by("uuid", F.struct(*POSITION)).alias("uuid"))


#: Bits that a map's row filter takes for each of its rows, and at most.
FILTER_BITS, MOST_FILTER_BITS = 10, 1 << 29
FILTER_SETTINGS = ("enabled", "applicationSideScanSizeThreshold", "creationSideThreshold", "expectedNumItems",
                   "maxNumItems", "numBits", "maxNumBits")
#: True for every id. A condition on the map's side is what lets the planner filter the other side by it.
ANY_ID = "source_id >= ''"


def filter_rows_by_maps(spark: SparkSession, rows: int, least_scan: str = "10g") -> None:
    """Let joins with id maps of ``rows`` ids drop other rows before the exchange.

    Spark builds a Bloom filter of the map's ids and tests the scanned rows of the other side, of at
    least ``least_scan``, with it; the join after the exchange is exact. Ten bits an id let about one
    row in a hundred pass that is in no map. Beyond 64 MB the filter grows no more and lets more
    rows pass, never fewer.
    """
    bits = max(1 << 16, min(FILTER_BITS * rows, MOST_FILTER_BITS))
    settings = {
        "enabled": "true", "applicationSideScanSizeThreshold": least_scan, "creationSideThreshold": "64g",
        "expectedNumItems": max(rows, 1), "maxNumItems": max(rows, 1), "numBits": bits, "maxNumBits": bits,
    }
    for name, value in settings.items():
        spark.conf.set(f"spark.sql.optimizer.runtime.bloomFilter.{name}", str(value))


@contextmanager
def rows_filtered_by_maps(spark: SparkSession, rows: int, least_scan: str) -> Iterator[None]:
    """``filter_rows_by_maps`` for the jobs that run inside; the session's settings come back after them."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    before = {name: spark.conf.get(prefix + name) for name in FILTER_SETTINGS}
    filter_rows_by_maps(spark, rows, least_scan)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(prefix + name, value)


def attach(df: DataFrame, id_map: DataFrame, key: str, name: str, how: str = "inner") -> DataFrame:
    """Join the id of ``key`` as column ``name``.

    No broadcast hint: maps grow with the cohort. The planner broadcasts one it measures
    as small, else sorts and merges, and splits the partition of a hot key.
    """
    renamed = id_map.where(ANY_ID).select(F.col("source_id").alias(key), F.col("uuid").alias(name))
    return df.join(renamed, key, how)
