"""Plans over catalog tables, bucketed facts and filtered id joins."""

import pytest
from pyspark.sql import types as T

from cohortloom.plans import reports
from cohortloom.sources import idmaps
from cohortloom.sources.catalog import register_tables, store_bucketed


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plain_plans(spark):
    """Plans as first made, with sort-merge joins."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def results(spark, label, n, seed):
    return spark.range(n).selectExpr(
        f"concat('e', pmod(hash(id, {seed}), 40)) AS encounter_id", f"concat('p', pmod(hash(id, {seed}), 40) % 7) AS subject_id",
        "concat('2021-01-0', 1 + id % 5) AS enct_date", f"element_at(array('Positive', 'Negative', 'Unknown'), 1 + CAST(id % 3 AS INT)) AS {label}")


def test_bucketed_reports_need_no_exchange(spark, plain_plans):
    lab, classifier = results(spark, "covid_lab_test", 90, 1), results(spark, "covid_classifier", 60, 2)
    keys = ["encounter_id", "subject_id"]
    stored = [store_bucketed(df, f"plan_facts.{name}", keys, 4) for df, name in ((lab, "lab"), (classifier, "classifier"))]
    joined = reports.lab_classifier(*stored)
    assert "Exchange" not in physical(joined)
    assert "Exchange" in physical(reports.lab_classifier(lab, classifier))
    for how in ("inner", "left", "full"):
        assert "Exchange" not in physical(stored[0].join(stored[1], keys, how))
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(joined) == rows(reports.lab_classifier(lab, classifier))


def test_registered_tables_have_schema_and_statistics(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, n long, code struct<text: string>, later date")
    spark.range(50).selectExpr("CAST(id AS STRING) AS id", "id % 3 AS n", "named_struct('text', 'x') AS code").write.parquet(str(tmp_path / "t"))
    for _ in range(2):  # declared anew
        register_tables(spark, "plan_catalog", {"t": (str(tmp_path / "t"), schema)})
    assert spark.table("plan_catalog.t").schema == schema
    assert spark.sql("SELECT count(*) AS n FROM plan_catalog.t WHERE n = 1 AND later IS NULL").first()["n"] == 17
    details = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED plan_catalog.t").collect()}
    assert "50 rows" in details["Statistics"] and details["Type"] == "EXTERNAL"
    assert {r["info_name"]: r["info_value"] for r in spark.sql("DESCRIBE EXTENDED plan_catalog.t n").collect()}["distinct_count"] == "3"


def written_rows(df):
    """Rows that each exchange of the executed plan wrote, largest first."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "ShuffleExchange" in node.getClass().getSimpleName():
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return sorted(found, reverse=True)


def test_rows_of_no_map_are_dropped_before_the_exchange(spark, tmp_path, plain_plans):
    names = ["enabled", "applicationSideScanSizeThreshold", "creationSideThreshold", "expectedNumItems", "maxNumItems", "numBits", "maxNumBits"]
    spark.range(2000).selectExpr("CAST(id * 50 AS STRING) AS source_id", "uuid() AS uuid").write.parquet(str(tmp_path / "map"))
    spark.range(100_000).selectExpr("CAST(id AS STRING) AS PATIENT_NUM", "id AS n").write.parquet(str(tmp_path / "rows"))
    id_map, rows = spark.read.parquet(str(tmp_path / "map")), spark.read.parquet(str(tmp_path / "rows"))
    before = written_rows(idmaps.attach(rows, id_map, "PATIENT_NUM", "patient_uuid"))
    assert before[0] == 100_000
    try:
        idmaps.filter_rows_by_maps(spark, id_map.count(), least_scan="0")
        joined = idmaps.attach(rows, id_map, "PATIENT_NUM", "patient_uuid")
        assert "might_contain" in physical(joined)
        assert written_rows(joined)[0] <= 2000 + 0.03 * 98_000
        assert joined.count() == 2000 and joined.where("n % 50 <> 0").count() == 0
    finally:
        for name in names:
            spark.conf.unset(f"spark.sql.optimizer.runtime.bloomFilter.{name}")
