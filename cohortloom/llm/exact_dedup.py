"""Exact dedup with a heavy-hitter split.

A Misra-Gries summary per task finds the digests that may hold more than a fixed share of all
rows. Their exact count and winning row are verified by an aggregation that combines before
its exchange; the few winners are broadcast, and rows of heavy digests never move. All other
digests are exchanged once by digest, and none of them holds more than that share.

Defined results: null text counts as empty; null ids sort after all others; of rows that
repeat both text and id exactly one stays; other columns are ignored, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import WHITE_SPACE, rows_of_keepers, settled, text_of

#: A digest is heavy if it holds at least one in so many rows.
HEAVY_ONE_IN = 256
#: Counters of a task's summary; its counts are short by at most one in COUNTERS + 1 rows.
COUNTERS = 1024


def text_digest(column: str = "text"):
    """SHA-256 of the text with each run of white space as one space."""
    return F.unhex(F.sha2(F.regexp_replace(text_of(column), WHITE_SPACE, " "), 256))


def summary(batches: Iterable[pa.RecordBatch], counters: int = COUNTERS) -> Iterator[pa.RecordBatch]:
    """Misra-Gries summary of a task's digests: at most ``counters`` rows."""
    counts: dict[bytes, int] = {}
    for batch in batches:
        for entry in pc.value_counts(batch.column(0)).to_pylist():
            counts[entry["values"]] = counts.get(entry["values"], 0) + entry["counts"]
        if len(counts) > counters:
            cut = sorted(counts.values(), reverse=True)[counters]
            counts = {digest: n - cut for digest, n in counts.items() if n > cut}
    yield pa.RecordBatch.from_pydict(
        {"digest": pa.array(list(counts), pa.binary()), "seen": pa.array(list(counts.values()), pa.int64())}
    )


def heavy_winners(rows: DataFrame, one_in: int = HEAVY_ONE_IN, counters: int = COUNTERS) -> DataFrame:
    """(digest, winner, group_size) of every digest with at least one in ``one_in`` rows.

    The candidates' summed counts exceed rows * (1/one_in - 1/(counters + 1)), so there are
    fewer than 2 * one_in of them, and the broadcasts below are bounded by that.
    """
    if counters < 2 * one_in:
        raise ValueError("counters must be at least twice one_in")
    total = rows.count()
    candidates = (
        rows.select("digest").mapInArrow(lambda batches: summary(batches, counters), "digest binary, seen long")
        .groupBy("digest").agg(F.sum("seen").alias("seen"))
        .where(F.col("seen") > total / one_in - total / (counters + 1)).select("digest")
    )
    return settled(
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest").agg(F.min("rank").alias("winner"), F.count("*").alias("group_size"))
        .where(F.col("group_size") >= total / one_in)
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    one_in: int = HEAVY_ONE_IN, counters: int = COUNTERS,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest (binary)."""
    rows = settled(docs.select(
        text_digest(text_col).alias("digest"),
        # Orders rows of a group: smallest id first, nulls last, then the position read.
        F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                 F.monotonically_increasing_id().alias("at")).alias("rank"),
    ))
    winners = heavy_winners(rows, one_in, counters)
    heavy = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = rows.join(F.broadcast(winners), "digest", "left_anti").select(
        "digest", "rank", F.min("rank").over(group).alias("winner"), F.count("*").over(group).alias("group_size"))
    return heavy.unionByName(rest).select(
        F.col("rank.id").alias(id_col), F.col("winner.id").alias("keep_id"), "group_size",
        (F.col("rank.at") == F.col("winner.at")).alias("kept"), "digest",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns, whatever these are called."""
    found = exact_duplicates(docs, id_col, text_col)
    keepers = settled(
        found.groupBy(F.col(id_col).alias("id"), "digest")
        .agg(F.max("kept").alias("stays"), F.count("*").alias("rows")).where("stays").drop("stays")
    )
    return rows_of_keepers(docs, keepers, id_col, text_digest(text_col))
