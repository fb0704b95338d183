import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import language_id as g
from cohortloom.llm.common import documents
from tests.llm.conftest import ODD, SCHEMA

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fitted(spark):
    docs = documents(spark, SF)
    held_out = g.fold("doc_id", 3) == 1
    return docs, held_out, g.fit(docs, ~held_out)


def test_fold(spark):
    rows = spark.range(50).select("id", g.fold("id", 3).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in rows)


def test_held_out_accuracy_and_rejection(fitted):
    docs, held_out, model = fitted
    rows = g.identify(docs, model).join(docs.where(held_out).select("doc_id", "lang"), "doc_id").collect()
    right = [r["lang"] == r["lang_pred"] for r in rows]
    assert len(rows) > 200 and sum(right) / len(rows) >= 0.97
    accepted = [ok for r, ok in zip(rows, right) if r["accepted"]]
    assert len(accepted) > 0.8 * len(rows) and sum(accepted) / len(accepted) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_other_columns_are_no_input(fitted):
    docs, _, model = fitted
    some = docs.limit(30)
    changed = some.withColumn("lang", F.lit("de")).withColumn("source", F.lit("x")).withColumn("doc_id", F.col("doc_id") + 10**6)
    a = sorted((r["lang_pred"], r["score"]) for r in g.identify(some, model).collect())
    assert a == sorted((r["lang_pred"], r["score"]) for r in g.identify(changed, model).collect())


def test_odd_texts(fitted, docs_of):
    model = fitted[2]
    rows = g.identify(docs_of(ODD), model).collect()
    assert len(rows) == len(ODD)
    und = {i for i, t in ODD if i is not None and not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == und
    assert all(r["score"] == 0 and not r["accepted"] for r in rows if r["lang_pred"] == "und")
    assert g.identify(docs_of([]), model).count() == 0


def test_without_labels(docs_of):
    docs = docs_of(ODD)
    model = g.fit(docs, F.lit(True))
    assert {r["lang_pred"] for r in g.identify(docs, model).collect()} == {"und"}


def test_sample_is_bounded_and_repeated_ids_count_once(spark):
    rows = [(7, "gleicher Text immer wieder", "de", "s", 1)] * 200 + [(k, f"some english text {k}", "en", "s", 1) for k in range(100, 160)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = g.fit(docs, F.lit(True), per_label=20)
    assert model.labels == ["de", "en"] and model.predict("some english text")[0] == "en"


def test_chunks_of_long_texts_are_all_counted():
    text = "ab " * (g.CHUNK_CHARS // 2)
    assert g.counts_of(text).sum() == pytest.approx(g.NGRAMS * len(text), rel=1e-3)


def test_training_is_repeatable():
    rng = np.random.default_rng(0)
    sample = [(label, np.arange(k, k + 40), np.ones(40, np.int64)) for label, k in (("a", 0), ("b", 100)) for _ in range(20)]
    one, two = g.train(sample), g.train(sample)
    assert (one.weights == two.weights).all() and one.accept == two.accept and rng is not None
