"""Exact distinct-count cubes, and reading them back.

``GROUP BY CUBE`` over n dimensions with a distinct count copies every input row 2^n
times before its first exchange. ``distinct_cube`` gives the same rows with less work:

* Input is reduced to distinct (dimensions, entity) rows, combined before the exchange, so
  an entity holding a large share of all rows leaves each task as a bounded set.
* Per entity, only the dimensions in which its rows differ need the subset expansion: if
  an entity has one value in a dimension, dropping that dimension cannot merge or split
  its rows. Most entities vary in few dimensions.
* Per-cell counts are then additive over entities, and the constant dimensions are rolled
  up on those counts, whose number does not grow with the entities.

After the exchange by entity, expansion and per-entity deduplication need no further
exchange. Only cell counts are shuffled, partially summed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def with_subsets(df: DataFrame, bits: str, n: int, name: str) -> DataFrame:
    """A row for every bit set inside the bit set ``bits`` over n bits, as column ``name``.

    The k-th one takes the binary digits of k as its answers, one for each bit of ``bits``.
    """
    rank = lambda i: f"bit_count(_bits & {(1 << i) - 1}L)"
    chosen = " | ".join(
        f"IF(_bits & {1 << i}L <> 0 AND shiftright(_k, {rank(i)}) & 1 = 1, {1 << i}L, 0L)" for i in range(n)
    )
    numbered = df.selectExpr("*", f"{bits} AS _bits").selectExpr(
        "*", "explode(sequence(0L, shiftleft(1L, bit_count(_bits)) - 1)) AS _k")
    return numbered.withColumn(name, F.expr(chosen)).drop("_bits", "_k")


def _masked(dims: Sequence[str], dropped: str) -> list[str]:
    return [f"IF({dropped} & {1 << i}L = 0, `{d}`, NULL) AS `{d}`" for i, d in enumerate(dims)]


def _varying(dims: Sequence[str], entity: str) -> str:
    """Bit set of the dimensions with more than one value among an entity's rows."""
    own = f"OVER (PARTITION BY `{entity}`)"
    return " + ".join(
        f"IF(min(struct(`{d}`)) {own} <=> max(struct(`{d}`)) {own}, 0L, {1 << i}L)"
        for i, d in enumerate(dims)
    )


def distinct_cube(
    df: DataFrame,
    dims: Sequence[str],
    entity: str,
    count: str = "cnt",
    grouping_id: bool = False,
    compact: bool = True,
) -> DataFrame:
    """``CUBE(dims)`` with ``count(distinct entity)``, exact.

    Totals are NULL in their dimensions. Fill the dimensions beforehand, or ask for
    ``grouping_id`` (bit i set: dimension i is a total), to tell them from NULL data.
    ``compact=False`` skips the first reduction for input that has few repeated rows.
    """
    dims = list(dims)
    everything = (1 << len(dims)) - 1

    rows = df.select(*dims, entity)
    rows = (rows.distinct() if compact else rows).selectExpr(
        "*", f"{_varying(dims, entity)} AS _varying"
    )
    expanded = with_subsets(rows, "_varying", len(dims), "_dropped").selectExpr(
        *_masked(dims, "_dropped"), entity, "_varying", "_dropped"
    )
    # One row per entity and cell; the hash partitioning by entity still holds.
    once = expanded.groupBy(entity, *dims, "_varying", "_dropped").agg(
        F.expr(f"max(IF(`{entity}` IS NULL, 0, 1)) AS _one")
    )
    cells = once.groupBy(*dims, "_varying", "_dropped").agg(F.sum("_one").alias("_n"))
    rolled = with_subsets(cells, f"{everything}L ^ _varying", len(dims), "_rolled").selectExpr(
        *_masked(dims, "_rolled"), "_dropped | _rolled AS grouping_id", "_n"
    )
    totals = rolled.groupBy(*dims, "grouping_id").agg(F.sum("_n").alias(count))
    return totals if grouping_id else totals.drop("grouping_id")


def store_cube(cube: DataFrame, folder: str) -> None:
    """Write a cube with its ``grouping_id``: one folder per set of totals."""
    cube.repartition("grouping_id").write.mode("overwrite").partitionBy("grouping_id").parquet(folder)


def read_cube(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def slice_stored(
    cube: DataFrame,
    all_dims: Sequence[str],
    dims: Sequence[str],
    filters: Mapping[str, str | Sequence[str]] | None = None,
    count: str = "cnt",
) -> DataFrame:
    """As ``cube_slice`` for a stored cube: only the folder of the wanted totals is scanned."""
    used = set(dims) | set(filters or {})
    wanted = sum(1 << i for i, d in enumerate(all_dims) if d not in used)
    return cube_slice(cube.where(F.col("grouping_id") == wanted), all_dims, dims, filters, count)


def cube_meta(cube: DataFrame, dims: Sequence[str], name: str) -> DataFrame:
    """(cube, dim, levels, rows): per dimension, its distinct levels and detail rows."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("level")) for d in dims
    ]))
    per_level = cube.select(pairs.alias("p")).groupBy("p.dim", "p.level").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_level.groupBy("dim").agg(
        F.count("level").alias("levels"),
        F.coalesce(F.sum(F.when(F.col("level").isNotNull(), F.col("n"))), F.lit(0)).alias("rows"),
    ).select(F.lit(name).alias("cube"), "dim", "levels", "rows")


def cube_levels(cube: DataFrame, dims: Sequence[str], name: str) -> DataFrame:
    """(cube, dim, level): the distinct levels of every dimension, as rows."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("level")) for d in dims
    ]))
    return (
        cube.select(pairs.alias("p")).where(F.col("p.level").isNotNull())
        .select(F.lit(name).alias("cube"), "p.dim", "p.level").distinct()
    )


def cube_slice(
    cube: DataFrame,
    all_dims: Sequence[str],
    dims: Sequence[str],
    filters: Mapping[str, str | Sequence[str]] | None = None,
    count: str = "cnt",
) -> DataFrame:
    """Rows of a cube at the level of ``dims``: these set, all others totals.

    ``filters`` restrict listed dimensions to one value or several.
    """
    unknown = (set(dims) | set(filters or {})) - set(all_dims)
    if unknown:
        raise ValueError(f"not a dimension: {sorted(unknown)}")
    used = list(dims) + [d for d in filters or {} if d not in dims]
    rows = cube
    for d in all_dims:
        rows = rows.where(F.col(d).isNotNull() if d in used else F.col(d).isNull())
    for d, wanted in (filters or {}).items():
        values = [wanted] if isinstance(wanted, str) else list(wanted)
        rows = rows.where(F.col(d).cast("string").isin(values))
    return rows.select(*used, count)
