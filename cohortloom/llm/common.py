"""Shared folder, settled tables and column checks of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.session import shared_folder

# Fixed value: white space in the contracts of the text operators.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


#: What this Python worker keeps between tasks.
_STATE: dict[object, object] = {}


def worker_state(key: object, make: Callable[[], object]):
    """State that a Python worker keeps between tasks, of one operator at a time.

    Workers outlive a stage; the next operator to run in one releases what the last one kept.
    """
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = make()
    return _STATE[key]


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    return settled_at(df)[0]


def settled_at(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` settled, and the folder that holds it."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a settled table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sampled(rows: DataFrame, per_label: int) -> DataFrame:
    """(id, label) of at most ``per_label`` ids of each label, the first by hash.

    Hashes beyond twice the wanted share of a label's ids are left out and repeated ids are
    combined before ids are ranked, so a label's ranking takes about twice ``per_label``
    rows, however many it has. One row per label is broadcast.
    """
    sizes = rows.groupBy("label").agg(F.approx_count_distinct("id", 0.02).cast("double").alias("ids"))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    near = (
        rows.join(F.broadcast(sizes), "label").withColumn("place", place)
        .where(F.col("place") * F.col("ids") < 2.0 * per_label * (1 << 30)).select("id", "label", "place").distinct()
    )
    rank = F.row_number().over(Window.partitionBy("label").orderBy("place", "id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= per_label).select("id", "label")


def text_of(column: str = "text"):
    """The text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or that with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def rows_of_keepers(docs: DataFrame, keepers: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """One row of ``docs``, with its columns, per row of ``keepers`` (id, digest, rows).

    Id and digest name the row that stays; rows that repeat both are alike, and just these pass
    through an aggregation of whole rows. Rows travel as one struct, so that their columns may
    have any names.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("own_id"), digest.alias("own_digest"))
    met = packed.join(keepers, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_digest") == F.col("digest")))
    once, again = met.where("rows = 1"), met.where("rows > 1").dropDuplicates(["id", "digest"])
    return once.unionByName(again).select("row.*")
