import numpy as np
from pyspark.sql import functions as F

from cohortloom.llm import language_id, toxicity as x
from cohortloom.llm.common import documents
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(4)
    y = rng.random(4000) < 0.3
    hit = [0.9, 0.8, 0.7, 0.6, 0.6]
    false = [0.02, 0.05, 0.1, 0.3, 0.3]
    votes = np.array([np.where(rng.random(4000) < np.where(y, h, f), x.TOXIC, x.ABSTAIN) for h, f in zip(hit, false)]).T
    votes[:, 4] = votes[:, 3]  # a copy errs with its original
    model = x.fit_label_model(votes, np.where(votes[:, 0] == x.TOXIC, 0.8, 0.2), 0.3)
    assert np.abs(model.table[:3, x.TOXIC, 1] - hit[:3]).max() < 0.1
    assert np.abs(model.table[:3, x.TOXIC, 0] - false[:3]).max() < 0.1
    assert max(model.share[3:]) < 0.6 and model.share[:3].min() > max(model.share[3:]) + 0.1
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.9


def test_calibration():
    rng = np.random.default_rng(1)
    logit = rng.normal(0, 3, 5000)
    label = (rng.random(5000) < 1 / (1 + np.exp(-(0.5 * logit - 1)))).astype(float)
    a, b = x.calibrated(logit, label, np.ones(5000))
    assert abs(a - 0.5) < 0.06 and abs(b + 1) < 0.15


def scored(spark, docs, labels):
    return x.fit(docs, labels, F.coalesce(language_id.fold("doc_id", 4) != 2, F.lit(False)))


def test_held_out_labels(spark):
    docs, labels = documents(spark, SF), documents(spark, SF, "labels")
    model = scored(spark, docs, labels)
    rows = x.score_texts(docs, model).join(labels, "doc_id").where(language_id.fold("doc_id", 4) == 2).collect()
    said = [(r["score"] >= x.THRESHOLD, r["toxic"] == 1) for r in rows]
    true = sum(a and b for a, b in said)
    assert true >= 0.6 * sum(b for _, b in said) and true >= 0.8 * sum(a for a, _ in said)
    kept = x.drop_toxic(docs, model)
    assert kept.schema == docs.schema
    assert kept.count() == x.score_texts(docs, model).where(F.col("score") < x.THRESHOLD).count()


def test_planted_words(spark, docs_of):
    words = [f"w{k}" for k in range(400)]
    rng = np.random.default_rng(3)
    text = lambda toxic: " ".join([*rng.choice(words, 60), *(["vileterm"] * 2 if toxic else [])])
    pairs = [(k, text(k % 5 == 0)) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(400)], "doc_id long, toxic int").selectExpr("*", "1 AS id", "'x' AS text")
    model = scored(spark, docs_of(pairs), labels)
    rows = x.score_texts(docs_of([(1001, text(True)), (1002, text(False)), *ODD]), model).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[1001] >= 0.5 and score[1002] < x.THRESHOLD and len(rows) == 2 + len(ODD)
    assert all(0 <= s <= 1 for s in score.values())


def test_missing_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    clean = spark.createDataFrame([(1, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    for labels in (none, clean):
        rows = x.score_texts(docs_of(ODD), scored(spark, docs_of(ODD), labels)).collect()
        assert len(rows) == len(ODD) and all(r["score"] < 0.01 for r in rows)
    assert x.score_texts(docs_of([]), scored(spark, docs_of([]), clean)).count() == 0
