"""Records of several lines, put together from files that are read in splits.

A line break (or whatever separates the pieces of a file) may stand inside a quoted text, and only
what comes before it in the file tells. Every piece is therefore a function from the state it
begins in to the state it ends in, outside or inside a quoted text; such functions compose. Each
split's function is found from its own pieces, a running composition over one row per split gives
the state every split begins in, and a running composition within the split the state of each
piece. A file's splits are thus read by many tasks, however large it is.

``gather`` joins the pieces of a record in two levels: within the split first, and then, for just
the first and last record of a split, over neighbouring splits. Pieces move once, to the partition
of their split; no group holds more than one split's pieces, or one row per split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.codes import text

SPLIT = ["src_file", "src_block"]


def _before(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``df`` with ``flips`` and ``fixed``: what the rows before each row make of a state.

    Rows have ``from_out`` and ``from_in``, the state after the row when it begins outside and when
    it begins inside. A row whose two results are equal fixes the state, one that exchanges them
    flips it. The state before a row is the one last fixed, or else the one at the start of ``keys``,
    flipped by the flips since then.
    """
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    upto = so_far.rowsBetween(Window.unboundedPreceding, 0)
    counted = df.withColumn("flips_upto", F.sum(F.expr("CAST(from_out AND NOT from_in AS INT)")).over(upto))
    fixes = F.expr("IF(from_out = from_in, struct(from_out AS state, flips_upto AS flips), NULL)")
    marked = counted.withColumn("fixes", fixes)
    return marked.withColumn("fixed", F.last("fixes", ignorenulls=True).over(so_far)).withColumn(
        "flips", F.coalesce(F.lag("flips_upto").over(Window.partitionBy(*keys).orderBy(order)), F.lit(0)))


def _state(start: str) -> str:
    """SQL: the state before a row of ``_before`` whose keys begin in ``start``."""
    return f"(coalesce(fixed.state, {start}) <> ((flips - coalesce(fixed.flips, 0)) % 2 = 1))"


def _after(state: str) -> str:
    return f"IF({state}, from_in, from_out)"


def with_starts(pieces: DataFrame, from_out: str, from_in: str) -> DataFrame:
    """``pieces`` (value, position) with ``starts``: true where a piece begins outside a quoted text.

    ``from_out`` and ``from_in`` are SQL conditions on a piece: it ends inside a quoted text when it
    begins outside of one, or inside.
    """
    marked = pieces.withColumn("from_out", F.expr(from_out)).withColumn("from_in", F.expr(from_in))
    slim = _before(marked.drop("value"), SPLIT, "src_row").selectExpr(
        *SPLIT, "src_row", f"{_after(_state('FALSE'))} AS out", f"{_after(_state('TRUE'))} AS in")
    ends = slim.groupBy(*SPLIT).agg(F.max_by(F.struct("out", "in"), "src_row").alias("end")).selectExpr(
        *SPLIT, "end.out AS from_out", "end.in AS from_in")
    begins = _before(ends, ["src_file"], "src_block").selectExpr(*SPLIT, f"{_state('FALSE')} AS begins_in")
    rows = _before(marked.join(begins, SPLIT), SPLIT, "src_row")
    return rows.select(*pieces.columns, F.expr(f"NOT {_state('begins_in')}").alias("starts"))


def gather(pieces: DataFrame, separator: str, carry: Sequence[str] = ()) -> DataFrame:
    """Records (value, position, number) from pieces (value, position, starts), in each file.

    A record is a piece that starts one and all pieces up to the next that does; the position is the
    first piece's, the number counts the records that begin in its split. Pieces before a file's
    first start are a record as well, of number 0. ``carry`` names columns that all of a file's
    pieces agree in.
    """
    kept = [F.max(c).alias(c) for c in carry]
    in_split = Window.partitionBy(*SPLIT).orderBy("src_row").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("number", F.sum(F.col("starts").cast("int")).over(in_split))
    joined = f"array_join(transform(sort_array(collect_list(struct(%s, value))), p -> p.value), {text(separator)})"
    parts = numbered.groupBy(*SPLIT, "number").agg(F.min("src_row").alias("src_row"), F.expr(joined % "src_row").alias("value"), *kept)
    edge = (F.col("number") == 0) | (F.col("number") == F.max("number").over(Window.partitionBy(*SPLIT)))
    parts = parts.withColumn("edge", edge)
    over_splits = Window.partitionBy("src_file").orderBy("src_block", "number").rowsBetween(Window.unboundedPreceding, 0)
    chained = parts.where("edge").withColumn("chain", F.sum(F.expr("CAST(number > 0 AS INT)")).over(over_splits))
    across = chained.groupBy("src_file", "chain").agg(
        F.min(F.struct("src_block", "src_row", "number")).alias("first"), F.expr(joined % "src_block, number").alias("value"), *kept
    ).select("value", "src_file", "first.*", *carry)
    return parts.where("NOT edge").select(*across.columns).unionByName(across)
