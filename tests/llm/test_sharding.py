import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm import sharding as s
from cohortloom.session import shared_folder
from tests.llm.conftest import ODD


def test_records_and_places(docs_of):
    pairs = ODD + [(1000 + k, "x" * (k % 97)) for k in range(400)]
    rows = s.shard_records(docs_of(pairs), shards=7, slots=64).collect()
    want = sorted((repr(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["place"])
    assert all(sorted(p) == list(range(len(p))) for p in by.values())
    assert len({(r["v_slot"], r["shard"]) for r in rows}) == len({r["v_slot"] for r in rows})


def test_bytes_are_near_equal(docs_of):
    rows = s.shard_records(docs_of([(k, "x" * (k * 37 % 500)) for k in range(3000)]), shards=10, slots=1024).collect()
    used = [sum(r["size"] for r in rows if r["shard"] == k) for k in range(10)]
    assert max(used) - min(used) <= 516


def test_versions(spark):
    folder = shared_folder(spark)
    load = {slot: 10 + slot % 5 for slot in range(64)}
    s.publish_map(spark, folder, 1, s.first_map(load, 64, 4), load)
    grown = {r["slot"]: r["shard"] for r in s.rebalance(spark, folder, 1, load, 5).collect()}
    first = {r["slot"]: r["shard"] for r in s.read_map(spark, folder, 1).collect()}
    moved = [slot for slot in grown if grown[slot] != first[slot]]
    assert set(grown.values()) == set(range(5)) and len(moved) <= 20 and sum(grown[m] == 4 for m in moved) >= 8


@settings(deadline=None, max_examples=50)
@given(st.dictionaries(st.integers(0, 63), st.integers(1, 1000)), st.integers(1, 9), st.integers(1, 9))
def test_edited_map(load, before, after):
    held = s.first_map(load, 64, before)
    new = s.edited_map(held, load, after)
    assert set(new) == set(range(64)) and all(0 <= shard < after for shard in new.values())
    used = [sum(load.get(slot, 0) for slot in new if new[slot] == k) for k in range(after)]
    assert max(used) - min(used) <= max(load.values(), default=0)


def test_empty_table(docs_of):
    assert s.shard_records(docs_of([])).count() == 0


def test_files(docs_of, spark):
    folder = shared_folder(spark)
    load = {k: 1 for k in range(16)}
    s.publish_map(spark, folder, 1, s.first_map(load, 16, 3), load)
    docs = docs_of(ODD)
    s.write_shards(docs, s.read_map(spark, folder, 1), f"{folder}/files", 16)
    back = spark.read.parquet(f"{folder}/files")
    assert sorted(repr(r["doc_id"]) for r in back.collect()) == sorted(repr(i) for i, _ in ODD)
