"""CSV extracts of the warehouse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions import fixed_values as fv
from cohortloom.functions.codes import one_of
from cohortloom.sources.positions import POSITION, with_position
from cohortloom.sources.records import gather, with_starts

def read_extract(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    *,
    position: bool = False,
    splittable: bool = False,
    na_tokens: Sequence[str] = fv.NA_TOKENS,
    uniform: bool = False,
) -> DataFrame:
    """Read the named columns of one or many CSV files as strings, blanks as NULL.

    Columns are found by header name and never inferred. Files may hold them in any order
    and beside others: files are grouped by header, each group is read with its own, and a
    header without a wanted column is an error rather than a silent shift. Finding the
    headers is one pass over the lines; ``uniform=True`` leaves it out for files known to
    share a header.

    Quoted line breaks are honoured and large files are read in splits all the same, by one
    more pass over the lines and one exchange of them (``quoted_records``). Pass
    ``splittable=True`` for extracts known to have no quoted line breaks: neither is needed.
    """
    paths = [path] if isinstance(path, str) else list(path)
    groups = [paths] if uniform else files_by_header(spark, paths)
    out = None
    for files in groups:
        raw = _plain_rows(spark, files) if splittable else _quoted_rows(spark, files)
        missing = [c for c in columns if c not in raw.columns]
        if missing:
            raise ValueError(f"extract has no column {missing}; found {raw.columns}")
        cleaned = [
            f"IF({one_of(f'`{c}`', na_tokens)}, NULL, `{c}`) AS `{c}`" if na_tokens else f"`{c}`"
            for c in columns
        ]
        rows = raw.selectExpr(*cleaned, *(POSITION if position else []))
        out = rows if out is None else out.unionByName(rows)
    return out


def _plain_rows(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Rows of files whose every line is a record."""
    return with_position(spark.read.options(header=True, inferSchema=False, enforceSchema=False, escape='"').csv(files))


def _quoted_rows(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Rows of files that share a header and may hold quoted line breaks."""
    names = spark.read.options(header=True, inferSchema=False, escape='"').csv(files).columns
    fields = ", ".join(f"c{k} string" for k in range(max(1, len(names))))
    rows = quoted_records(spark, files).where("NOT is_header").withColumn("row", F.from_csv("value", fields, {"escape": '"'}))
    return rows.select(*[F.col(f"row.c{k}").alias(name) for k, name in enumerate(names)], *POSITION)


# A line's pieces between quotes, each but the last with the quote after it. Inside a text a quote
# closes it (1 to 0). After that, or at the start of a line that begins outside, another quote at
# once opens a text again, as does one behind a comma; any other quote is an ordinary character.
_QUOTED = (
    "aggregate(slice(split(value, '\"'), 1, size(split(value, '\"')) - 1), {start},"
    " (s, p) -> CASE WHEN s = 1 THEN 0 WHEN (s = 0 AND p = '') OR endswith(p, ',') THEN 1 ELSE 2 END, s -> s = 1)"
)


def _ends_inside(start: int) -> str:
    return f"IF(contains(value, '\"'), {_QUOTED.format(start=start)}, {'TRUE' if start else 'FALSE'})"


def quoted_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value, position, is_header) of the records of CSV files whose quoted texts hold line breaks.

    Files are read in splits: whether a line break ends a record follows from the quotes before
    it, which are composed over the lines of a split and over the splits of a file. Blank records
    are left out, as is the carriage return of a line feed that ends a record; line breaks inside
    a text are kept as they are.
    """
    lines = with_position(spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path)))
    records = gather(with_starts(lines, _ends_inside(0), _ends_inside(1)), "\n")
    return records.selectExpr(
        r"IF(endswith(value, '\r'), left(value, length(value) - 1), value) AS value", *POSITION,
        "src_block = 0 AND number = 1 AS is_header").where("value <> ''")


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header) of each file: its first line."""
    lines = with_position(spark.read.text(list(paths)))
    return lines.groupBy(F.col("src_file").alias("path")).agg(
        F.min_by("value", F.struct("src_block", "src_row")).alias("header")
    )


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Files grouped by header; empty files are left out.

    When all files share one header, the given paths are returned as they are, so that only
    the names of differing headers reach the driver.
    """
    found = headers(spark, paths).where("header <> ''")
    kinds = [r["header"] for r in found.select("header").distinct().sort("header").collect()]
    if len(kinds) < 2:
        return [list(paths)]
    return [[r["path"] for r in found.where(F.col("header") == kind).sort("path").collect()] for kind in kinds]


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def write_csv(df: DataFrame, path: str, balanced: bool = False) -> None:
    """Write CSV with a header. ``balanced`` makes files of about equal size, as many as the bytes need.

    The rows are exchanged once more at the sink, where adaptive execution merges small and splits
    large partitions to its advisory size; the work upstream keeps its parallelism.
    """
    out = df.hint("rebalance") if balanced else df
    out.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
