"""Places of rows in their source files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POSITION = ["src_file", "src_block", "src_row"]


def with_position(df: DataFrame) -> DataFrame:
    """Add the place of each row in its source: file, split offset, row within the split.

    Ordering by these three columns is the order of the rows in the files. Splits are
    read independently, so a large file still spreads over many tasks.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_row"),
    )
