"""A key that holds a large share of all rows."""

import pytest

from cohortloom.operators import resources
from cohortloom.operators.cube import distinct_cube
from cohortloom.plans import facts

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture
def small_partitions(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, setting in SMALL.items():
        spark.conf.set(key, setting)
    yield spark
    for key, setting in before.items():
        spark.conf.unset(key) if setting is None else spark.conf.set(key, setting)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def maps(spark):
    ids = spark.range(2000).selectExpr("CAST(id AS STRING) AS source_id", "concat('u', id) AS uuid")
    return ids, ids


def rows(spark):
    """40% of the rows belong to patient 0 and encounter 0."""
    return spark.range(0, 60000, 1, 8).selectExpr(
        "CAST(IF(id % 5 < 2, 0, id % 1500) AS STRING) AS PATIENT_NUM",
        "CAST(IF(id % 5 < 2, 0, id % 1999) AS STRING) AS ENCOUNTER_NUM",
        "concat('ICD10:', id % 50) AS CONCEPT_CD", "concat('2020-01-01 ', id) AS START_DATE",
        "'LAB:1043473617' AS LAB", "'Positive' AS TVAL_CHAR")


def test_id_joins_split_the_hot_partition(small_partitions):
    spark = small_partitions
    labs = rows(spark).drop("CONCEPT_CD").withColumnRenamed("LAB", "CONCEPT_CD")
    out = resources.map_lab_observation(labs, *maps(spark), "s", ["START_DATE"])
    assert "skew=true" in final_plan(out)
    assert out.count() == 60000 and out.select("id").distinct().count() == 60000


def test_condition_dedup_behind_a_split_join(small_partitions):
    spark = small_partitions
    df = rows(spark)
    out = resources.map_condition(df, *maps(spark), "s")
    assert "skew=true" in final_plan(out)
    assert out.count() == df.select("ENCOUNTER_NUM", "CONCEPT_CD").distinct().count()


def test_evidence_of_a_hot_encounter_is_one_row(spark):
    snomed = "http://snomed.info/sct"
    url = "http://fhir-registry.smarthealthit.org/StructureDefinition/nlp-polarity"
    obs = spark.range(0, 50000, 1, 8).selectExpr(
        "named_struct('reference_id_aa', IF(id % 3 = 0, 'hot', CAST(id AS STRING))) AS encounter",
        f"named_struct('coding', array(named_struct('system', '{snomed}', 'code', '49727002'))) AS code",
        f"array(named_struct('url', '{url}', 'valueInteger', IF(id % 6 = 0, 0, -1), 'valueString', '')) AS modifierExtension",
        "CAST(NULL AS STRUCT<coding: ARRAY<STRUCT<system: STRING, code: STRING>>>) AS valueCodeableConcept",
        "CAST(NULL AS ARRAY<STRUCT<coding: ARRAY<STRUCT<code: STRING>>>>) AS category")
    out = facts.encounter_evidence(
        obs, {"49727002": "Cough"}, majority=False, default_symptom="x", lab=("P", "N"), classifier=("P", "N"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan
    assert [r.symptoms for r in out.where("encounter_id = 'hot'").collect()] == [["Cough"]]


def test_cube_with_a_hot_entity(spark):
    df = spark.range(0, 60000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id % 5000 AS STRING)) AS k", "id % 7 AS a", "id % 4 AS b", "IF(id % 3 = 0, 1, id % 2) AS c")
    native = df.cube("a", "b", "c").agg({"k": "approx_count_distinct"})
    ours = distinct_cube(df, ["a", "b", "c"], "k")
    assert ours.count() == native.count()
    exact = df.groupBy("a").agg({"k": "count"}).count()
    assert ours.where("a IS NOT NULL AND b IS NULL AND c IS NULL").count() == exact
    top = ours.where("a IS NULL AND b IS NULL AND c IS NULL").first()["cnt"]
    assert top == df.select("k").distinct().count()


def test_cap_in_source_order(spark, tmp_path):
    from cohortloom.operators.dedup import cap_in_source_order
    from cohortloom.sources.positions import with_position

    for name, rows in (("a", range(0, 700)), ("b", range(700, 720)), ("c", range(720, 2000))):
        (tmp_path / f"{name}.txt").write_text("".join(f"{k}\n" for k in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        lines = with_position(spark.read.text(str(tmp_path))).where("CAST(value AS INT) % 3 = 0").repartition(5, "value")
        assert lines.select("src_file", "src_block").distinct().count() > 10
        for limit in (1, 100, 234, 235, 600, 5000):
            got = cap_in_source_order(lines, limit).collect()
            assert sorted(int(r["value"]) for r in got) == list(range(0, 2000, 3))[:limit]
        assert cap_in_source_order(lines, 0) is lines
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_equal_rows_are_numbered_in_bounded_steps(spark, monkeypatch):
    from cohortloom.operators import dedup

    monkeypatch.setattr(dedup, "NUMBERED", 7)
    rows = spark.range(100).selectExpr("IF(id < 60, 'hot', concat('k', id % 20)) AS k")
    got = sorted((r["k"], r["occurrence"]) for r in dedup.number_equal_rows(rows).collect())
    assert got == sorted([("hot", n) for n in range(1, 61)] + [(f"k{k}", n) for k in range(20) for n in (1, 2)])
