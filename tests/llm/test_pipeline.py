import hashlib
import re

from pyspark.sql import functions as F

import corpus_pipeline
from cohortloom.llm import simhash_dedup, toxicity
from cohortloom.llm.common import documents
from cohortloom.llm.queries import toxicity_model
from tests.llm.conftest import SCHEMA
from tests.llm.test_simhash_dedup import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_against_brute_force(spark):
    docs = documents(spark, SF)
    model = toxicity_model(spark, docs, SF)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    rows = [(i, t) for i, t in rows if model.score(t) < toxicity.THRESHOLD]
    first = {}
    for i, t in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    rows = sorted(first.values())
    label = slow_components([slow_fingerprint(t) for _, t in rows])
    rows = [row for k, row in enumerate(rows) if label[k] == k or label.index(label[k]) == k]
    items = [r["text"] for r in documents(spark, SF, "benchmark").collect()]
    rows = [(i, t) for i, t in rows if not any(item in t for item in items)]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == [i for i, _ in rows]
    texts = dict(rows)
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in got)
    assert 0 < len(got) < docs.count()


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 1), (None, "a text", None, None, None), (3, "", "en", "s", 0)], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= table.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 3


def test_stages_and_numbers():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]


def test_near_copies_of_a_hot_group_leave_one(spark):
    base = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join([*base[:k], "edit", *base[k:]]), "en", "s", 1) for k in range(120)]
    out = simhash_dedup.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA), block_rows=32)
    assert out.agg(F.min("doc_id")).first()[0] == 0 and out.count() == len(set(slow_components([slow_fingerprint(r[1]) for r in rows])))
