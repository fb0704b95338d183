import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm import exact_dedup as x
from tests.llm.conftest import ODD


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(normal(t), []).append(i)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return sorted(
        (repr(i), repr(least(groups[normal(t)])), len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in pairs)


def found(df):
    rows = df.collect()
    return rows, sorted((repr(r["doc_id"]), repr(r["keep_id"]), r["group_size"], bytes(r["digest"]).hex()) for r in rows)


@pytest.mark.parametrize("one_in,counters", [(256, 1024), (3, 8)])
def test_against_brute_force(docs_of, one_in, counters):
    pairs = ODD + [(100 + k, "a hot text") for k in range(60)] + [(200 + k, f"text {k % 30}") for k in range(60)]
    rows, got = found(x.exact_duplicates(docs_of(pairs), one_in=one_in, counters=counters))
    assert got == expected(pairs)
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len({normal(t) for _, t in pairs})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_heavy_winners_are_found(docs_of):
    pairs = [(k, "hot" if k % 3 == 0 else f"cold {k}") for k in range(300)]
    rows = docs_of(pairs).select(x.text_digest().alias("digest"), x.F.struct(x.F.lit(False).alias("n"), x.F.col("doc_id").alias("id")).alias("rank"))
    won = x.heavy_winners(rows, 4, 8).collect()
    assert [(r["group_size"], r["winner"]["id"]) for r in won] == [(100, 0)]


def test_empty_table(docs_of):
    assert x.exact_duplicates(docs_of([])).count() == 0
    assert x.drop_exact_duplicates(docs_of([])).count() == 0


def test_drop_keeps_columns_and_one_row_each(docs_of):
    docs = docs_of(ODD)
    kept = x.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(normal(t) for _, t in rows) == sorted({normal(t) for _, t in ODD})
    assert (4, "one two  three") in rows and (None, "alone without an id") in rows


@settings(deadline=None, max_examples=30)
@given(st.lists(st.integers(0, 12), max_size=200), st.integers(1, 6))
def test_summary_bounds(values, counters):
    digests = [bytes([v]) for v in values]
    batches = [pa.RecordBatch.from_pydict({"digest": pa.array(digests[k:k + 17], pa.binary())}) for k in range(0, len(digests), 17)]
    (out,) = x.summary(batches, counters)
    counts = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
    assert len(counts) <= counters
    for v in range(13):
        true = digests.count(bytes([v]))
        assert true - len(digests) / (counters + 1) <= counts.get(bytes([v]), 0) <= true


def test_rows_of_heavy_digests_are_not_exchanged(docs_of):
    plan = x.exact_duplicates(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
