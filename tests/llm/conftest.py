import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators also use."""

    def make(pairs, extra=True):
        df = spark.createDataFrame([(i, t, None, "s", 0) for i, t in pairs], SCHEMA)
        if extra:
            for name in ("id", "digest", "rank", "kept", "keep_id", "print", "component", "shard", "size", "score", "data", "w", "_x", "_id", "_digest", "_rows", "_own",
                         "_slot", "_shard", "row", "own_id", "own_digest", "rows"):
                df = df.selectExpr("*", f"'{name}' AS {name}")
        return df

    return make


ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one two  three"), (5, "one\ttwo three"), (6, "One two three"), (7, "é" * 50_000),
    (8, "word " * 30_000), (None, "one two three"), (None, "alone without an id"), (4, "one two  three"), (9, "a b ퟿"), (10, "!?"),
]
