"""First-seen deduplication and row caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.sources.positions import POSITION


#: Repeats of a row that are unfolded at a time.
NUMBERED = 1 << 16


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Keep the first row per key.

    The rank filter is pushed below the exchange (``WindowGroupLimit``), so every map task
    sends at most one row per key: a key holding a large share of all rows costs no more
    than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def distinct_by(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows, left partitioned by ``key`` for a join or window that follows.

    For rows of which a key has few distinct ones: they meet in one set.
    """
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.collect_set(F.struct(*others)).alias("_rows")).selectExpr(key, "inline(_rows)")


def number_equal_rows(df: DataFrame, name: str = "occurrence") -> DataFrame:
    """Number rows that are equal in every column from 1, so that each has a key of its own.

    Equal rows are interchangeable, so they are counted before the exchange and unfolded
    after it: a row that is repeated without end moves as one row per task.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_rows"))
    # Unfolded in two steps, so that no array is longer than NUMBERED however often a row repeats.
    firsts = F.explode(F.sequence(F.lit(1), F.col("_rows"), F.lit(NUMBERED))).alias("_first")
    stepped = counted.select(*df.columns, "_rows", firsts)
    last = F.least("_rows", F.col("_first") + NUMBERED - 1)
    return stepped.select(*df.columns, F.explode(F.sequence("_first", last)).alias(name))


def cap_rows(df: DataFrame, limit: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``limit`` rows in row order; 0 keeps all."""
    return df.orderBy(*order).limit(limit) if limit > 0 else df


def cap_in_source_order(df: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows in the order of their source files; 0 keeps all.

    Rows carry their source position. Rows are counted per split, a running sum over one row per
    split finds the split in which the limit is reached, and only that split is put in order: the
    rows stay distributed, and a large limit costs no sort.
    """
    if limit <= 0:
        return df
    split = POSITION[:2]
    order = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, 0)
    upto = df.groupBy(*split).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_upto", F.sum("_rows").over(order))
    open_splits = upto.where(F.col("_upto") - F.col("_rows") < limit)
    met = df.join(open_splits, split)
    place = F.row_number().over(Window.partitionBy(*split).orderBy(POSITION[2])) + F.col("_upto") - F.col("_rows")
    whole = met.where(F.col("_upto") <= limit)
    last = met.where(F.col("_upto") > limit).withColumn("_place", place).where(F.col("_place") <= limit)
    return whole.select(*df.columns).unionByName(last.select(*df.columns))


def value_counts(df: DataFrame, column: str | Column, name: str) -> DataFrame:
    """(name, n) of the non-NULL values of a column."""
    value = (F.col(column) if isinstance(column, str) else column).alias(name)
    return df.select(value).where(F.col(name).isNotNull()).groupBy(name).agg(
        F.count(F.lit(1)).alias("n")
    )
