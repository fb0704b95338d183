"""Exact k-means on integer vectors with Shallot search.

Every vector keeps its centroid, the centroid that was second nearest when it was last searched, an
upper bound of the distance to the first and a lower bound of the distance to all others. A round
moves the bounds by the centroids' movements and leaves vectors alone whose upper bound is below
the lower one, or below half the way from their centroid to the next one. All others start from
the closer of their two remembered centroids and scan that one's neighbours in order of distance.
The scan ends where neighbours are outside the ball that can hold one of the two nearest
centroids; its radius, the distances to the start and to the second nearest so far added up,
shrinks as nearer ones are found. Neighbours inside the ball are compared by exact squared
distances in integers, ties to the smaller number.

Bounds are doubles, rounded outwards at every step, and decide only by strict comparison, so the
assignment is that of a full search. A round is one pass of Arrow tasks over chunks of vectors,
which are written with their new bounds and with sums per centroid; the sums alone are read to
move the centroids, k rows of a few integers that are plan input of the next round. No row moves
between tasks, and a round's table replaces the one before.

Defined results: vectors that are null, of another width, or hold null or non-finite components
are dropped; null ids are kept but start no centroid unless others are too few; of repeated ids the
smaller vector comes first; fewer vectors than k give fewer centroids; centroids without vectors
stay where they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import vectors
from cohortloom.llm.common import removed, settled_at

WIDTH = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = "2"
#: Relative slack of a bound, far above the rounding of the few operations between two bounds.
OUT, IN = 1 + 1e-12, 1 - 1e-12


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    return ((points - others) ** 2).sum(axis=1)


class Centroids:
    """Centroids with their distances to each other and each one's neighbours in order of distance."""

    def __init__(self, places: np.ndarray, moved: np.ndarray) -> None:
        self.places, k = places, len(places)
        gaps = np.stack([squared(places, place) for place in places])
        self.gaps = np.sqrt(gaps.astype(np.float64)) * IN
        self.near = np.stack([[j for j in np.argsort(row, kind="stable") if j != c] for c, row in enumerate(gaps)]).reshape(k, k - 1)
        self.half = self.gaps[np.arange(k), self.near[:, 0]] / 2 * IN if k > 1 else np.full(1, np.inf)
        # How far each centroid moved at most, and the most that any other one moved.
        self.moved = np.sqrt(moved.astype(np.float64)) * OUT
        top = np.argsort(self.moved)
        self.others_moved = np.where(np.arange(k) == top[-1], self.moved[top[-2]] if k > 1 else 0.0, self.moved[top[-1]])

    def assign(self, points: np.ndarray, state: State | None) -> State:
        """The points' new state; without an earlier one, the first two centroids start every scan."""
        n, k = len(points), len(self.places)
        if state is None:
            state = State(np.zeros(n, np.int64), np.full(n, min(1, k - 1)), np.full(n, np.inf), np.zeros(n))
        first, second = state.first.copy(), state.second.copy()
        upper = (state.upper + self.moved[first]) * OUT
        lower = np.maximum(state.lower - self.others_moved[first], 0) * IN
        if k == 1:
            return State(first, second, upper, lower)
        safe = np.maximum(lower, self.half[first])
        rows = np.nonzero(upper >= safe)[0]
        upper[rows] = np.sqrt(squared(points[rows], self.places[first[rows]]).astype(np.float64)) * OUT
        rows = rows[upper[rows] >= safe[rows]]
        if len(rows):
            first[rows], second[rows], upper[rows], lower[rows] = self.search(points[rows], first[rows], second[rows])
        return State(first, second, upper, lower)

    def search(self, points: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
        """Nearest and second nearest centroid of each point, with bounds, from two centroids to start at."""
        a, b = squared(points, self.places[one]), squared(points, self.places[two])
        swap = (b < a) | ((b == a) & (two < one))
        best, next_ = np.where(swap, two, one), np.where(swap, one, two)
        near, far = np.where(swap, b, a), np.where(swap, a, b)
        start, other = best.copy(), next_.copy()
        reach = np.sqrt(near.astype(np.float64)) * OUT  # from the point to the centre of the ball
        open_rows = np.arange(len(points))
        for rank in range(self.near.shape[1]):
            met = self.near[start[open_rows], rank]
            ball = (reach[open_rows] + np.sqrt(far[open_rows].astype(np.float64)) * OUT) * OUT
            inside = self.gaps[start[open_rows], met] <= ball
            open_rows, met = open_rows[inside], met[inside]
            if not len(open_rows):
                break
            new = met != other[open_rows]  # the other remembered centroid is measured already
            rows, met = open_rows[new], met[new]
            d = squared(points[rows], self.places[met])
            wins = (d < near[rows]) | ((d == near[rows]) & (met < best[rows]))
            r = rows[wins]
            next_[r], far[r] = best[r], near[r]
            best[r], near[r] = met[wins], d[wins]
            comes_second = ~wins & ((d < far[rows]) | ((d == far[rows]) & (met < next_[rows])))
            r = rows[comes_second]
            next_[r], far[r] = met[comes_second], d[comes_second]
        return best, next_, np.sqrt(near.astype(np.float64)) * OUT, np.sqrt(far.astype(np.float64)) * IN


class State:
    """Nearest and second centroid of each vector, and the bounds of both distances."""

    def __init__(self, first: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        self.first, self.second, self.upper, self.lower = first, second, upper, lower

    def pack(self) -> bytes:
        return b"".join(x.astype(kind).tobytes() for x, kind in ((self.first, "<i4"), (self.second, "<i4"), (self.upper, "<f8"), (self.lower, "<f8")))

    @staticmethod
    def unpack(data: bytes) -> State:
        n = len(data) // 24
        ids = np.frombuffer(data, "<i4", 2 * n).astype(np.int64)
        bounds = np.frombuffer(data, "<f8", 2 * n, 8 * n)
        return State(ids[:n], ids[n:], bounds[:n], bounds[n:])


def starting_centroids(rows: DataFrame, k: int, width: int, scale: int, seed: str) -> np.ndarray:
    """The vectors of the ``k`` smallest SHA-256 digests of ``seed:id``, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.select(digest.alias("digest"), "vector").orderBy(F.col("digest").asc_nulls_last(), "vector").limit(k).collect()
    return vectors.integers(np.array([r["vector"] for r in first], np.float64).reshape(-1, width), scale)


def one_round(packed: DataFrame, places: np.ndarray, moved: np.ndarray) -> DataFrame:
    """Chunks with the state after one assignment, and the chunk's sums per centroid."""
    width, k, has_state = places.shape[1], len(places), "state" in packed.columns
    names = ["ids", "data", "kind", *(["state"] if has_state else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(places, moved)
        for batch in batches:
            for row in range(batch.num_rows):
                values = vectors.matrix(batch.column(1)[row].as_py(), batch.column(2)[row].as_py(), width)
                state = centroids.assign(values, State.unpack(batch.column(3)[row].as_py()) if has_state else None)
                counts, totals = vectors.add_up(state.first, values, k)
                part = batch.slice(row, 1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([state.pack()], pa.binary()),
                     pa.array([counts.astype("<i8").tobytes()], pa.binary()), pa.array([totals.astype("<i8").tobytes()], pa.binary())],
                    ["ids", "data", "kind", "state", "counts", "totals"])

    ids = packed.schema["ids"].dataType.simpleString()
    return packed.select(*names).mapInArrow(
        run, f"ids {ids}, data binary, kind string, state binary, counts binary, totals binary")


def task_sums(assigned: DataFrame, k: int, width: int) -> DataFrame:
    """(g, n, s): counts and sums per centroid, one row per task and centroid."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            for n, s in zip(batch.column(0), batch.column(1)):
                counts += np.frombuffer(n.as_py(), "<i8")
                totals += np.frombuffer(s.as_py(), "<i8").reshape(k, width)
        yield vectors.sum_rows(counts, totals)

    return assigned.select("counts", "totals").mapInArrow(run, vectors.SUMS)


def centroid_digest(place: np.ndarray) -> str:
    """SHA-256 of a centroid's components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, place.tolist())).encode()).hexdigest()


def cluster(
    rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: str = SEED,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) per kept vector, and the final centroids; distances are squared."""
    slim = rows.select(F.col(f"`{id_col}`").alias("id"), F.lit(None).cast("int").alias("label"), F.col(f"`{vector_col}`").alias("vector"))
    slim = slim.where(vectors.whole("vector", width))
    places = starting_centroids(slim, k, width, scale, seed)
    k = len(places)
    moved = np.zeros(k, np.int64)
    packed, folder = settled_at(vectors.chunks(slim, width, scale).drop("labels"))
    for turn in range((rounds + 1) * bool(k)):
        assigned, written = settled_at(one_round(packed, places, moved))
        removed(rows.sparkSession, folder)
        packed, folder = assigned, written
        if turn < rounds:
            means = vectors.floor_means(task_sums(assigned, k, width), k, width, places)
            places, moved = means, squared(means, places)
    id_type = slim.schema["id"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                values = vectors.matrix(batch.column(1)[row].as_py(), batch.column(2)[row].as_py(), width)
                first = State.unpack(batch.column(3)[row].as_py()).first
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[row].values, pa.array(first.astype(np.int32)), pa.array(squared(values, places[first]))],
                    ["id", "cluster", "distance"])

    if not k:
        return slim.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), places
    found = packed.select("ids", "data", "kind", "state").mapInArrow(run, f"id {id_type.simpleString()}, cluster int, distance long")
    return found, places


def with_inertia(found: DataFrame, places: np.ndarray) -> DataFrame:
    """``found`` with its clusters' and the whole inertia and the digest of each final centroid.

    The sums are one row per centroid, so they join by a broadcast of at most k rows.
    """
    rows, _ = settled_at(found)
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    total = sum(r["cluster_inertia"] for r in sums)
    known = rows.sparkSession.createDataFrame(
        [(r["cluster"], r["cluster_inertia"], total, centroid_digest(places[r["cluster"]])) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(known), "cluster")
