"""Vector code compression: product quantisation with memoised grid cells.

Vectors of integers are cut into equal parts; every part position has a codebook, improved by
rounds of assignment and exact floor means. To assign a part, its coarse grid cell is hashed and
looked up in the worker's memo: the first part in a cell finds, by the least and greatest distance
from each entry to the cell's box, which entries no other one dominates across the whole box, and
the cell keeps these. Only they are evaluated, exactly in integers, for each part in the cell. An
entry is left out only if another one is strictly nearer to every point of the box, so the nearest
entry and ties to the lower index are those of a full search.

A memo holds up to ``MEMO_CELLS`` cells per part position and lasts for one round; parts in cells
beyond that, or whose hash meets another cell's, are compared with all entries.

A round's tasks return counts and sums per entry they have met, which are added up in Spark; the
codebooks, parts x entries of a few integers, are plan input of the next round. Vectors are
written once, as integers, and no row moves between tasks.

Defined results: rows whose vector is null, holds null or non-finite components or has another
width than ``width`` are dropped; null ids are kept and come last among the starting rows; of
repeated ids the smaller vector comes first; fewer rows than entries give fewer entries; an
empty table gives an empty result; a label column may be null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import vectors
from cohortloom.llm.common import settled, worker_state

WIDTH = 64
PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Cells across the spread of a codebook's entries in each component, and cells kept per part.
CELLS_ACROSS = 2
MEMO_CELLS = 1 << 16
SMALL = 1 << 24
#: Keeps entries whose distances to a box differ by no more than doubles round.
SLACK = 1 + 1e-12
#: Odd factor of the hash of a cell's coordinates.
MIX = np.uint64(0x9E3779B97F4A7C15)


class Memo:
    """Grid cells of one part position, each with the entries that can be nearest inside it."""

    def __init__(self, entries: np.ndarray, most: int = MEMO_CELLS, across: int = CELLS_ACROSS) -> None:
        self.entries, self.most = entries, most
        spread = int((entries.max(axis=0) - entries.min(axis=0)).max()) if len(entries) else 0
        self.shift = max(0, (spread // across).bit_length() - 1)  # cells are a power of two wide
        self.hashes = np.zeros(0, np.uint64)
        self.cells = np.zeros((0, entries.shape[1]), np.int64)
        self.open = np.zeros((0, len(entries)), bool)

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, the entries that none dominates across the cell's box."""
        low = (cells << self.shift).astype(np.float64)
        high = low + ((1 << self.shift) - 1)
        least, most = np.empty((len(self.entries), len(cells))), np.empty((len(self.entries), len(cells)))
        for k, entry in enumerate(self.entries.astype(np.float64)):
            below, above = low - entry, entry - high
            near = np.maximum(np.maximum(below, above), 0.0)
            far = np.maximum(-below, -above)
            least[k], most[k] = np.einsum("ij,ij->i", near, near), np.einsum("ij,ij->i", far, far)
        return (least <= most.min(axis=0) * SLACK).T

    def _learn(self, hashes: np.ndarray, cells: np.ndarray) -> None:
        """Keep the cells of hashes that are not known yet, while there is room."""
        fresh, first = np.unique(hashes, return_index=True)
        new = ~np.isin(fresh, self.hashes, assume_unique=True)
        first = first[new][: self.most - len(self.hashes)]
        if not len(first):
            return
        made = np.concatenate([self.candidates(cells[first[at:at + 1024]]) for at in range(0, len(first), 1024)])
        hashes, cells, found = (np.concatenate(x) for x in (
            (self.hashes, hashes[first]), (self.cells, cells[first]), (self.open, made)))
        order = np.argsort(hashes)
        self.hashes, self.cells, self.open = hashes[order], cells[order], found[order]

    def open_entries(self, points: np.ndarray) -> np.ndarray:
        """For each point, the entries to evaluate."""
        cells = points >> self.shift
        hashes = np.zeros(len(points), np.uint64)
        for column in cells.T:
            hashes = (hashes ^ column.astype(np.uint64)) * MIX
            hashes ^= hashes >> np.uint64(29)
        self._learn(hashes, cells)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        known = (self.cells[at] == cells).all(axis=1)
        return self.open[at] | ~known[:, None]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each point's nearest entry, ties to the lower one."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        code = np.zeros(len(points), np.int64)
        wanted = self.open_entries(points)
        own = np.einsum("ij,ij->i", points, points)
        # Products of integers below SMALL add up exactly in doubles, whose products are the fast ones.
        small = max(np.abs(points).max(initial=0), np.abs(self.entries).max(initial=0)) < SMALL
        factors = points.astype(np.float64) if small else points
        for k, entry in enumerate(self.entries):
            rows = np.nonzero(wanted[:, k])[0]
            product = (factors[rows] @ entry.astype(factors.dtype)).astype(np.int64)
            far = own[rows] - 2 * product + int(entry @ entry)
            nearer = far < best[rows]
            rows = rows[nearer]
            best[rows], code[rows] = far[nearer], k
        return code, best


def assign(values: np.ndarray, memos: list[Memo]) -> tuple[np.ndarray, np.ndarray]:
    """Codes [rows, parts] and squared distances summed over the parts."""
    span = values.shape[1] // len(memos)
    found = [memo.nearest(values[:, p * span:(p + 1) * span]) for p, memo in enumerate(memos)]
    return np.stack([code for code, _ in found], axis=1), np.sum([far for _, far in found], axis=0)


def _memos(books: np.ndarray) -> list[Memo]:
    """The worker's memos for these codebooks."""
    return worker_state(("code_compression", books.shape, books.tobytes()), lambda: [Memo(book) for book in books])


def _starting_rows(rows: DataFrame, n: int, width: int, scale: int) -> np.ndarray:
    first = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(n).collect()
    return vectors.integers(np.array([r["vector"] for r in first], np.float64).reshape(-1, width), scale)


def fit(packed: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks [parts, entries, span] after ``rounds`` of assignment and floor means."""
    parts, entries, span = books.shape

    for _ in range(rounds):
        def run(batches: Iterable[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            counts, totals = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, span), np.int64)
            for batch in batches:
                for data, kind in zip(batch.column(0), batch.column(1)):
                    values = vectors.matrix(data.as_py(), kind.as_py(), parts * span)
                    codes, _ = assign(values, _memos(books))
                    groups = (codes + entries * np.arange(parts)).ravel()
                    n, s = vectors.add_up(groups, values.reshape(-1, span), parts * entries)
                    counts, totals = counts + n, totals + s
            yield vectors.sum_rows(counts, totals)

        sums = packed.select("data", "kind").mapInArrow(run, vectors.SUMS)
        books = vectors.floor_means(sums, parts * entries, span, books.reshape(-1, span)).reshape(books.shape)
    return books


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    rows: DataFrame, width: int = WIDTH, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) per kept row and the final codebooks; codes are two hex digits a part."""
    if width % parts or entries > 256:
        raise ValueError("the width must be a multiple of the parts, with at most 256 entries")
    slim = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("vector"))
    slim = slim.where(vectors.whole("vector", width))
    books = _starting_rows(slim, entries, width, scale)
    books = np.ascontiguousarray(books.reshape(len(books), parts, width // parts).swapaxes(0, 1))
    packed = settled(vectors.chunks(slim, width, scale))
    if books.size:
        books = fit(packed, books, rounds)
    id_type, label_type = slim.schema["id"].dataType, slim.schema["label"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes, far = assign(vectors.matrix(batch.column(2)[k].as_py(), batch.column(3)[k].as_py(), width), _memos(books))
                text = codes.astype(np.uint8).tobytes().hex()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[k].values, batch.column(1)[k].values,
                    pa.array([text[at:at + 2 * parts] for at in range(0, len(text), 2 * parts)]), pa.array(far)],
                    ["id", "label", "code", "error"])

    coded = packed.mapInArrow(run, f"id {id_type.simpleString()}, label {label_type.simpleString()}, code string, error long")
    return coded, books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the errors summed over equal labels, nulls together.

    The sums are one row per label; adaptive execution broadcasts them if they are few and splits
    the partition of a frequent label if they are many.
    """
    rows = settled(coded)
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    return rows.join(sums, rows["label"].eqNullSafe(sums["of_label"])).drop("of_label")
