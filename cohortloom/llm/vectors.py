"""Integer vectors in chunk rows: what the two vector operators share.

A chunk row holds up to ``CHUNK_ROWS`` vectors as one block of integers of the smallest fitting
type, beside their ids and labels, so that a task works on matrices and a table of chunks is read
in few rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vectors in a chunk row.
CHUNK_ROWS = 2048
#: Components beyond this magnitude are an error: sums of squares of differences must fit a long.
MOST = 1 << 27


def whole(vector_col: str, width: int) -> Column:
    """True for vectors of ``width`` components, none of them null or non-finite."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector_col) == width) & fine, F.lit(False))


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, x as double."""
    out = np.floor(scale * vectors.astype(np.float64))
    if out.size and np.abs(out).max() > MOST:
        raise ValueError(f"a component times {scale} is beyond {MOST}")
    return out.astype(np.int64)


def block(values: np.ndarray) -> tuple[bytes, str]:
    """An integer matrix as bytes of the smallest type that holds it, and that type's name."""
    most = int(np.abs(values).max()) if values.size else 0
    kind = "<i1" if most < 1 << 7 else "<i2" if most < 1 << 15 else "<i4"
    return values.astype(kind).tobytes(), kind


def matrix(data: bytes, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, width).astype(np.int64)


def chunks(rows: DataFrame, width: int, scale: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(ids, labels, data, kind) from rows (id, label, vector) of whole vectors."""
    id_type, label_type = rows.schema["id"].dataType, rows.schema["label"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for at in range(0, batch.num_rows, chunk_rows):
                part = batch.slice(at, chunk_rows)
                data, kind = block(integers(values[at:at + chunk_rows], scale))
                ends = pa.array([0, part.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, part.column(c)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([data], pa.binary()), pa.array([kind])], ["ids", "labels", "data", "kind"])

    return rows.select("id", "label", "vector").mapInArrow(
        run, f"ids array<{id_type.simpleString()}>, labels array<{label_type.simpleString()}>, data binary, kind string")


def floor_means(sums: DataFrame, groups: int, width: int, before: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each group; a group without rows keeps its vector.

    ``sums`` has rows (g, n, s): partial counts and component sums of tasks. Groups and width are
    small plan input, so one row per group and component reaches the driver.
    """
    met = sums.select("g", "n", F.posexplode("s").alias("pos", "part")).groupBy("g", "pos").agg(
        F.sum("n").alias("n"), F.sum("part").alias("total")).collect()
    out = before.copy()
    for row in met:
        if row["n"]:
            out[row["g"], row["pos"]] = row["total"] // row["n"]
    return out


SUMS = "g int, n long, s array<long>"


def sum_rows(counts: np.ndarray, totals: np.ndarray) -> pa.RecordBatch:
    """Rows (g, n, s) of the groups that a task has met."""
    met = np.nonzero(counts)[0]
    ends = np.arange(len(met) + 1, dtype=np.int32) * totals.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(totals[met].ravel(), pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[met], pa.int64()), lists], ["g", "n", "s"])


def add_up(groups: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and component sums of a chunk's rows by group; exact, since doubles hold its sums exactly."""
    totals = np.stack([np.bincount(groups, column, n) for column in values.T], axis=1).astype(np.int64)
    return np.bincount(groups, minlength=n), totals
