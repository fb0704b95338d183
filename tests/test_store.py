"""What the store's build moves: texts once, mentions ranked once, rows of no cohort dropped."""

from pyspark.sql import functions as F

from cohortloom import session
from cohortloom.plans import pipeline
from cohortloom.sources import idmaps
from workload import queries
from workload.queries import QUERIES
from workload.shapes import SHAPES, Warehouse

DATA = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_store_moves_texts_once_and_filters_by_maps(spark, monkeypatch):
    seen = {}
    setting = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"

    def write(frames, *rest):
        seen.update(frames, scan=spark.conf.get(setting))

    before = spark.conf.get(setting)
    w = Warehouse(spark, DATA)
    w.id_maps
    monkeypatch.setattr(pipeline, "write_tables", write)
    w.build(w.folder, w.annotated(), own_maps=True)
    assert seen["scan"] == pipeline.LEAST_SCAN and spark.conf.get(setting) == before
    assert "source_id" not in plan_of(seen["documentreference"])
    # The mentions are read as ranked, the other windows are those of the classifiers.
    assert "cui" not in "".join(line for line in plan_of(seen["observation"]).splitlines() if "Window" in line)


def test_map_filter_holds_inside_only(spark):
    names = [f"spark.sql.optimizer.runtime.bloomFilter.{n}" for n in idmaps.FILTER_SETTINGS]
    before = [spark.conf.get(n) for n in names]
    try:
        with idmaps.rows_filtered_by_maps(spark, 7, "0"):
            assert spark.conf.get(names[1]) == "0"
            raise KeyError
    except KeyError:
        pass
    assert [spark.conf.get(n) for n in names] == before


def test_texts_of_repeated_rows_in_files(spark, tmp_path, monkeypatch):
    """Rows of one id meet each other, and texts are neither joined on ids nor mapped again for each use."""
    settled = []
    monkeypatch.setattr(queries, "settled", lambda df: settled.append(df) or session.settled(df))
    for name in ("customer", "nation", "orders", "labels", "events", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{DATA}/{name}.parquet")
    documents = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id IN (4, 9, 22)")
    documents.unionByName(documents.where("doc_id = 4")).write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["note_text_from_files"](spark, str(tmp_path))
    assert ["content" in df.columns for df in settled] == [False, True]
    assert "DocumentReference|" not in "".join(line for line in plan_of(settled[1]).splitlines() if "Join" in line)
    assert "OBSERVATION_BLOB" not in plan_of(out) and "decode" not in plan_of(settled[1])
    assert {r["kind"]: r["n"] for r in out.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        "data": 5, "file": 1}


def test_notes_meet_only_their_own_orders(spark, tmp_path):
    """The right rows with a partner, repeats included, and rows of the plain join."""
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    few = orders.where("o_orderkey IN (4, 8, 22, 1001)")
    few.unionByName(few.where("o_orderkey = 8")).write.parquet(str(tmp_path / "orders.parquet"))
    documents = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id IN (4, 9, 22, 7)")
    nulls = documents.where("doc_id = 7").withColumn("doc_id", F.expr("CAST(NULL AS BIGINT)"))
    documents.unionByName(documents.where("doc_id = 4")).unionByName(nulls).write.parquet(str(tmp_path / "documents.parquet"))
    w = Warehouse(spark, str(tmp_path))
    assert sorted(r["o_orderkey"] for r in w.matched("note_cohort").collect()) == [4, 8, 8, 22]
    found = w.extract("note_cohort")
    assert sorted(r["row_id"] for r in found.select("row_id").collect()) == [4, 4, 9, 9, 22]
    left, right, on, columns = SHAPES["note_cohort"]
    plain = w.table(left).join(w.table(right), F.expr(on)).selectExpr(*columns)
    assert found.columns == plain.columns and not found.exceptAll(plain).count() and not plain.exceptAll(found).count()
    assert len(found.inputFiles()) > 0 and not any("/orders.parquet/" in f for f in found.inputFiles())
