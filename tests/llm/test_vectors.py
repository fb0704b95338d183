import hashlib

import duckdb
import numpy as np
import pytest

from cohortloom.llm import centroid_clustering as clustering
from cohortloom.llm import code_compression as compression
from cohortloom.llm import vectors
from cohortloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def table_of(spark):
    """Vectors from (vec_id, vector, label) rows, with columns whose names the operators also use."""

    def make(rows):
        df = spark.createDataFrame(rows, SCHEMA)
        for name in ("id", "vector", "ids", "data", "state", "cluster", "distance", "code", "error", "g", "n", "s", "kind"):
            df = df.selectExpr("*", f"'{name}' AS {name}")
        return df

    return make


def random_rows(n, width, seed, spread=4):
    """Rows with few distinct components, so that ties, copies and repeated ids occur."""
    rng = np.random.default_rng(seed)
    made = rng.integers(-spread, spread + 1, (n, width)) / 2 + rng.choice([0.0, 0.0, 0.1], (n, 1))
    made[n // 2: n // 2 + n // 8] = made[0]
    return [(k if k % 11 else k // 2, v.astype(np.float32).tolist(), k % 3 or None) for k, v in enumerate(made)]


def slow_clusters(rows, k, rounds, scale, seed="2"):
    rows = sorted(rows, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    values = np.floor(scale * np.array([r[1] for r in rows], np.float32).astype(np.float64)).astype(np.int64)
    places = values[:k].copy()
    for turn in range(rounds + 1):
        far = ((values[:, None] - places[None]) ** 2).sum(axis=2)
        own = far.argmin(axis=1)
        if turn < rounds:
            for c in set(own.tolist()):
                places[c] = values[own == c].sum(axis=0) // (own == c).sum()
    return sorted((r[0], int(c), int(d[c])) for r, c, d in zip(rows, own, far)), places


def slow_codes(rows, width, parts, entries, rounds, scale):
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    values = np.floor(scale * np.array([r[1] for r in rows], np.float32).astype(np.float64)).astype(np.int64)
    span, codes, error, books = width // parts, [""] * len(rows), np.zeros(len(rows), np.int64), []
    for p in range(parts):
        points = values[:, p * span:(p + 1) * span]
        book = points[:entries].copy()
        for turn in range(rounds + 1):
            far = ((points[:, None] - book[None]) ** 2).sum(axis=2)
            own = far.argmin(axis=1)
            if turn < rounds:
                for e in set(own.tolist()):
                    book[e] = points[own == e].sum(axis=0) // (own == e).sum()
        codes = [c + f"{e:02x}" for c, e in zip(codes, own)]
        error += far.min(axis=1)
        books.append(book)
    return sorted(zip([r[0] for r in rows], codes, error.tolist())), np.array(books)


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_code_compression"])
def test_queries_against_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    found = db.sql(SQL[name])
    columns = sorted(found.columns)
    assert sorted(frame.columns) == columns
    expected = db.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(tuple, frame.select(*columns).collect())) == sorted(expected)


@pytest.mark.parametrize(("n", "width", "k", "seed"), [(300, 8, 12, 1), (500, 3, 40, 2), (30, 4, 40, 3), (50, 2, 1, 4), (200, 5, 2, 5)])
def test_clusters_against_brute_force(table_of, n, width, k, seed):
    rows = random_rows(n, width, seed)
    found, places = clustering.cluster(table_of(rows), k=k, width=width, scale=10)
    expected, of = slow_clusters(rows, k, clustering.ROUNDS, 10)
    assert sorted(map(tuple, found.collect())) == expected
    assert (places == of).all()


def test_bounds_spare_searches():
    rng = np.random.default_rng(8)
    centres = rng.integers(-10_000, 10_000, (20, 16))
    points = centres[rng.integers(0, 20, 4000)] + rng.integers(-200, 201, (4000, 16))
    places, moved, state, searched = centres + 5, np.zeros(20, np.int64), None, []
    for _ in range(4):
        step = clustering.Centroids(places, moved)
        search = step.search
        step.search = lambda p, *a: searched.append(len(p)) or search(p, *a)
        state = step.assign(points, state)
        assert (state.first == ((points[:, None] - places[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
        n, s = vectors.add_up(state.first, points, 20)
        means = np.where(n[:, None] > 0, s // np.maximum(n, 1)[:, None], places)
        places, moved = means, clustering.squared(means, places)
    assert searched == [4000] or sum(searched[1:]) < 400


@pytest.mark.parametrize(("n", "width", "parts", "entries", "seed"), [(300, 8, 4, 6, 1), (400, 16, 8, 16, 2), (10, 4, 2, 16, 3), (200, 6, 2, 1, 4)])
def test_codes_against_brute_force(table_of, n, width, parts, entries, seed):
    rows = random_rows(n, width, seed)
    coded, books = compression.compress(table_of(rows), width=width, parts=parts, entries=entries, scale=10)
    expected, of = slow_codes(rows, width, parts, entries, compression.ROUNDS, 10)
    assert sorted((r["id"], r["code"], r["error"]) for r in coded.collect()) == expected
    assert (books == of).all()


@pytest.mark.parametrize("most", [1, 7, 1 << 16])
@pytest.mark.parametrize("across", [1, 4, 40])
def test_memo_finds_the_nearest(most, across):
    rng = np.random.default_rng(most + across)
    entries, points = rng.integers(-60, 60, (16, 4)), rng.integers(-90, 90, (3000, 4))
    entries[9] = entries[3]
    memo = compression.Memo(entries, most, across)
    far = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    for at in range(0, 3000, 500):
        code, best = memo.nearest(points[at:at + 500])
        assert (code == far[at:at + 500].argmin(axis=1)).all() and (best == far[at:at + 500].min(axis=1)).all()
    assert len(memo.hashes) <= most


def test_memo_tells_cells_of_one_hash_apart(monkeypatch):
    monkeypatch.setattr(compression, "MIX", np.uint64(0))  # every cell has the same hash
    rng = np.random.default_rng(3)
    entries, points = rng.integers(-60, 60, (16, 4)), rng.integers(-90, 90, (500, 4))
    code, _ = compression.Memo(entries).nearest(points)
    assert (code == ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_memo_leaves_entries_out():
    rng = np.random.default_rng(4)
    memo = compression.Memo(rng.integers(-100, 100, (16, 2)))
    assert memo.open_entries(rng.integers(-100, 100, (5000, 2))).mean() < 0.6


ODD = [
    (1, None, 1), (2, [], 2), (3, [1.0, 2.0], 1), (4, [1.0, None, 0.0, 0.0], 1), (5, [float("nan"), 0.0, 0.0, 0.0], None),
    (6, [float("inf"), 0.0, 0.0, 0.0], 1), (None, [1.0, 1.0, 1.0, 1.0], None), (7, [1.0, 1.0, 1.0, 1.0], None),
    (7, [0.5, 0.5, 0.5, 0.5], 2), (7, [0.5, 0.5, 0.5, 0.5], 2), (8, [-0.0, 0.26, -0.26, 1000.0], 2),
]


def test_odd_vectors(table_of):
    found, places = clustering.cluster(table_of(ODD), k=3, width=4, scale=4)
    rows = clustering.with_inertia(found, places).collect()
    assert sorted((r["id"] or 0) for r in rows) == [0, 7, 7, 7, 8]
    assert len(places) == 3 and {r["inertia"] for r in rows} == {sum(r["distance"] for r in rows)}
    coded, books = compression.compress(table_of(ODD), width=4, parts=2, entries=16, scale=4)
    rows = compression.with_label_error(coded).collect()
    assert sorted((r["id"] or 0) for r in rows) == [0, 7, 7, 7, 8]
    assert books.shape == (2, 5, 2) and all(len(r["code"]) == 4 for r in rows)
    for r in rows:
        assert r["label_error"] == sum(o["error"] for o in rows if o["label"] == r["label"])


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_no_vector(table_of, rows):
    found, places = clustering.cluster(table_of(rows))
    assert clustering.with_inertia(found, places).collect() == []
    coded, books = compression.compress(table_of(rows))
    assert compression.with_label_error(coded).collect() == []


def test_components_beyond_the_range_are_an_error(table_of):
    with pytest.raises(Exception, match="beyond"):
        clustering.cluster(table_of([(1, [1e30] * 4, 1)]), width=4)


def test_vectors_meet_no_exchange(spark):
    docs = spark.read.parquet(f"{SF}/embeddings.parquet")
    coded, _ = compression.compress(docs, rounds=1)
    assert "Exchange" not in coded._jdf.queryExecution().executedPlan().toString()
