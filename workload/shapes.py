"""The given tables shaped as warehouse extracts.

One definition serves both engines: Spark builds DataFrames from it, the comparison SQL
uses it as common table expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import fixed_values as fv
from cohortloom.operators import mentions as m
from cohortloom.operators import resources as r
from cohortloom.operators.cube import store_cube
from cohortloom.plans import reports
from cohortloom.plans.pipeline import assign_ids, build_store, load_ids, read_tables
from cohortloom.session import configure, shared_folder

SALT = "workload"
AS_OF = "2002-01-01"

DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"


def _later(days: str) -> str:
    return f"CAST(CAST(o_orderdate AS DATE) + CAST({days} AS INT) AS STRING)"


_PROP = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 9"

# name: (left table, right table, join condition, projected expressions)
SHAPES = {
    "patient_dimension": ("customer", "nation", "c_nationkey = n_nationkey", [
        "CAST(c_custkey AS STRING) AS PATIENT_NUM",
        "CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'U' END AS SEX_CD",
        "CASE c_nationkey % 6 WHEN 0 THEN 'White' WHEN 1 THEN 'Black or African American'"
        " WHEN 2 THEN 'Asian' WHEN 3 THEN 'Hispanic or Latino' WHEN 4 THEN 'Declined' END AS RACE_CD",
        "concat(CAST(1910 + c_custkey % 90 AS STRING), '-06-15 00:00:00') AS BIRTH_DATE",
        "lpad(CAST(c_custkey % 1000 AS STRING), 5, '0') AS ZIP_CD",
        "n_name AS STATE_CD",
    ]),
    "visit_dimension": ("orders", None, None, [
        "CAST(o_orderkey AS STRING) AS ENCOUNTER_NUM",
        "CAST(o_custkey AS STRING) AS PATIENT_NUM",
        "CASE o_orderstatus WHEN 'F' THEN 'Inpatient' WHEN 'O' THEN 'Outpatient' END AS INOUT_CD",
        f"concat({DAY}, ' 08:00:00') AS START_DATE",
        f"concat({_later('o_orderkey % 5')}, ' 17:00:00') AS END_DATE",
    ]),
    "diagnosis": ("lineitem", "orders", "l_orderkey = o_orderkey", [
        "CAST(l_orderkey AS STRING) AS ENCOUNTER_NUM",
        "CAST(o_custkey AS STRING) AS PATIENT_NUM",
        "CASE l_partkey % 8 WHEN 0 THEN 'ICD10:U07.1' WHEN 1 THEN 'ICD10:E66.9'"
        " WHEN 2 THEN 'ICD9:079.89' WHEN 3 THEN 'LOCAL:X1' WHEN 4 THEN 'UNCODED'"
        " ELSE concat('ICD10:J', CAST(l_partkey % 8 AS STRING)) END AS CONCEPT_CD",
        f"concat({_later('l_partkey % 6')}, ' 09:00:00') AS START_DATE",
    ]),
    "lab_cohort": ("lineitem", "orders", "l_orderkey = o_orderkey", [
        "CAST(l_orderkey AS STRING) AS ENCOUNTER_NUM",
        "CAST(o_custkey AS STRING) AS PATIENT_NUM",
        "CASE l_suppkey % 6 WHEN 0 THEN 'LAB:1043473617' WHEN 1 THEN 'LAB:1044804335'"
        " WHEN 2 THEN 'LAB:1134792565' WHEN 3 THEN 'LAB:467288722' WHEN 4 THEN 'LAB:13815125'"
        " ELSE 'LAB:0' END AS CONCEPT_CD",
        f"concat({_later('l_suppkey % 4')}, ' 10:00:00') AS START_DATE",
        "CASE WHEN l_returnflag = 'R' THEN 'Positive' WHEN l_returnflag = 'A' THEN 'Negative'"
        " WHEN l_linestatus = 'O' THEN 'POSITIVE' END AS TVAL_CHAR",
    ]),
    "note_cohort": ("documents", "orders", "o_orderkey = doc_id - doc_id % 2", [
        "doc_id AS row_id",
        "CAST(o_orderkey AS STRING) AS ENCOUNTER_NUM",
        "CAST(o_custkey AS STRING) AS PATIENT_NUM",
        "concat('NOTE:', source) AS CONCEPT_CD",
        f"concat({_later('doc_id % 3')}, ' 11:00:00') AS START_DATE",
        "text AS OBSERVATION_BLOB",
    ]),
    "nlp_mention": ("events", "orders", "o_orderkey = user_id * 2", [
        "event_id AS row_id",
        "CAST(o_orderkey AS STRING) AS ENCOUNTER_NUM",
        "CAST(o_custkey AS STRING) AS PATIENT_NUM",
        f"concat({DAY}, ' 11:00:00') AS START_DATE",
        "event_id AS begin_pos",
        "event_id + 5 AS end_pos",
        "event_type AS mention_text",
        "CASE WHEN event_type IN ('error', 'view') THEN -1 ELSE 0 END AS polarity",
        "split_part('49727002,11833005,62315008,84229001,43724002,25064002,386661006,44169009,"
        f"999999', ',', {_PROP} + 1) AS snomed_code",
        "split_part('C0010200,C0850149,C0011991,C0015672,C0085593,C0018681,C0015967,C2364111,"
        f"C9999999', ',', {_PROP} + 1) AS cui",
        "CASE event_id % 5 WHEN 0 THEN 'MedicationMention' WHEN 1 THEN 'ProcedureMention'"
        " WHEN 2 THEN 'DiseaseDisorderMention' ELSE 'SignSymptomMention' END AS sem_type",
    ]),
    "classifier_prediction": ("labels", None, None, [
        "doc_id AS row_id",
        "CAST(doc_id - doc_id % 2 AS STRING) AS ENCOUNTER_NUM",
        "CASE quality WHEN 1 THEN 'positive' ELSE 'Negative' END AS PREDICTION",
        "CASE WHEN doc_id % 7 = 0 THEN 'Not classified' WHEN quality = 1 THEN 'Positive'"
        " ELSE 'Negative' END AS V1_PREDICTION",
    ]),
}


# Columns of the right table in shapes whose left rows are wide or meet few of its rows.
MATCHED = {name: ["o_orderkey", "o_custkey", "o_orderdate"] for name in ("note_cohort", "nlp_mention")}


def shape_sql(name: str) -> str:
    """The shape as a query on the given tables."""
    left, right, on, columns = SHAPES[name]
    source = f"{left} JOIN {right} ON {on}" if right else left
    return f"SELECT {', '.join(columns)} FROM {source}"


_STORES: dict[tuple, str] = {}
_MAPPED: set[str] = set()
_BUILT: set[str] = set()


class Warehouse:
    """Extracts, id maps and resources over one folder of the given tables.

    Id maps, stored tables and the orders that notes and mentions meet are written once per application to the shared folder.
    Everything else is lazy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = configure(spark), sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def extract(self, name: str) -> DataFrame:
        left, right, on, columns = SHAPES[name]
        df = self.table(left)
        if right:
            df = df.join(self.matched(name) if name in MATCHED else self.table(right), F.expr(on))
        return df.selectExpr(*columns)

    def matched(self, name: str) -> DataFrame:
        """Rows of a shape's right table that have a partner, written once per application.

        The planner measures them: while they are small, it broadcasts them and the left rows stay in place.
        """
        left, right, on, _ = SHAPES[name]
        folder = f"{self.folder}-{right}-of-{name}"
        rows = self.table(right).select(*MATCHED[name])
        if folder not in _BUILT:
            key, expression = on.split(" = ")
            partners = self.table(left).select(F.expr(expression).alias("partner")).distinct()
            rows.join(partners, F.expr(f"{key} = partner"), "left_semi").write.parquet(folder)
            _BUILT.add(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    @cached_property
    def folder(self) -> str:
        """Folder of this data's id maps and tables in this application."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _STORES:
            _STORES[key] = shared_folder(self.spark)
        return _STORES[key]

    @cached_property
    def id_maps(self) -> tuple[DataFrame, DataFrame]:
        if self.folder not in _MAPPED:
            assign_ids(self.extract("note_cohort"), self.folder, SALT)
            _MAPPED.add(self.folder)
        return load_ids(self.spark, self.folder)

    @property
    def patients(self) -> DataFrame:
        return self.id_maps[0]

    @property
    def encounters(self) -> DataFrame:
        return self.id_maps[1]

    # --- resources ---

    def patient(self) -> DataFrame:
        return r.map_patient(self.extract("patient_dimension"), self.patients)

    def condition(self) -> DataFrame:
        return r.map_condition(self.extract("diagnosis"), self.patients, self.encounters, SALT)

    def lab(self, case_sensitive: bool = False) -> DataFrame:
        return r.map_lab_observation(
            self.extract("lab_cohort"), self.patients, self.encounters, SALT,
            case_sensitive=case_sensitive,
        )

    def document(self, keep: Sequence[str] = ()) -> DataFrame:
        return r.map_document_reference(self.extract("note_cohort"), SALT, ["row_id"], keep=keep)

    def encounter(self) -> DataFrame:
        return r.map_encounter(self.extract("visit_dimension"), self.patients, self.encounters, SALT)

    def classifier(self, tag: str = fv.CLASSIFIER_202204) -> DataFrame:
        column = "V1_PREDICTION" if tag == fv.CLASSIFIER_V1 else "PREDICTION"
        results = self.extract("classifier_prediction").select(
            "row_id", "ENCOUNTER_NUM", F.col(column).alias("PREDICTION")
        )
        return r.map_classifier(
            self.extract("note_cohort"), r.first_predictions(results, ["row_id"]),
            self.patients, self.encounters, SALT, order=["row_id"], tag=tag,
        )

    def annotated(self, symptom_only: bool = True, uncoded: int = 0) -> DataFrame:
        """Mentions as annotated notes: one record per mention, two coded concepts each.

        Every ``uncoded``-th mention has no concept.
        """
        sem_type = "'SignSymptomMention'" if symptom_only else "sem_type"
        record = (
            "named_struct('begin', begin_pos, 'end', end_pos, 'text', mention_text,"
            f" 'polarity', polarity, 'conceptAttributes', IF({f'row_id % {uncoded} = 0' if uncoded else 'false'}, array(), array("
            "named_struct('code', snomed_code, 'cui', cui, 'tui', 'T184', 'scheme', 'SNOMEDCT_US'),"
            "named_struct('code', concat('RX', snomed_code), 'cui', cui, 'tui', 'T121', 'scheme', 'RXNORM'))))"
        )
        blob = f"CAST(map({sem_type}, array({record})) AS {schemas.ANNOTATIONS.simpleString()})"
        raw = self.extract("nlp_mention").selectExpr(
            "row_id", "PATIENT_NUM", "ENCOUNTER_NUM", "START_DATE", f"{blob} AS OBSERVATION_BLOB"
        )
        return r.with_ids(raw, self.patients, self.encounters).selectExpr(
            "row_id", "patient_uuid AS PATIENT_NUM", "encounter_uuid AS ENCOUNTER_NUM",
            "START_DATE", "OBSERVATION_BLOB",
        )

    def mention(self, kind: str = "Observation", symptom_only: bool = True) -> DataFrame:
        types = fv.DEFAULT_MENTION_TYPES if symptom_only else fv.ALL_MENTION_TYPES
        return m.mention_resources(self.annotated(symptom_only), kind, SALT, ["row_id"], types)

    # --- stored tables ---

    @cached_property
    def full_folder(self) -> str:
        """Tables of all mention types, every eleventh mention without a code, and rejects."""
        folder = self.folder + "-all"
        if folder not in _BUILT:
            _, unmapped = self.annotated_by_labels("nlp_mention")
            self.build(folder, self.annotated(False, 11), types=fv.ALL_MENTION_TYPES, rejects={"note_ids": unmapped})
            _BUILT.add(folder)
        return folder

    def annotated_by_labels(self, notes: str) -> tuple[DataFrame, DataFrame]:
        """Rows of an extract as notes with the labels as annotations, and those without ids."""
        mention = (
            "named_struct('begin', 0, 'end', 1, 'text', 'label', 'polarity', -toxic, 'conceptAttributes',"
            " array(named_struct('code', '49727002', 'cui', 'C0010200', 'tui', 'T184', 'scheme', 'SNOMEDCT_US')))"
        )
        blob = f"CAST(map('SignSymptomMention', array({mention})) AS {schemas.ANNOTATIONS.simpleString()})"
        annotations = self.table("labels").selectExpr("doc_id AS row_id", f"{blob} AS OBSERVATION_BLOB")
        return m.annotate_notes(self.extract(notes), annotations, "row_id", self.patients, self.encounters)

    @cached_property
    def cube_folder(self) -> str:
        """The symptom cube as a stored table."""
        folder = self.folder + "-cube"
        if folder not in _BUILT:
            store_cube(reports.symptom_cube_v81(self.tables, AS_OF, 1996, grouping_id=True), folder)
            _BUILT.add(folder)
        return folder

    def build(self, folder: str, annotated: DataFrame, **more) -> None:
        results = self.extract("classifier_prediction")
        build_store(
            {name: self.extract(name) for name in SHAPES if name != "classifier_prediction"},
            annotated, folder, SALT,
            order={
                "note_cohort": ["row_id"], "diagnosis": ["START_DATE"],
                "classifier_results": ["row_id"], "annotated": ["row_id"],
            },
            classifiers={
                fv.CLASSIFIER_202204: results,
                fv.CLASSIFIER_V1: results.withColumn("PREDICTION", F.col("V1_PREDICTION")),
            },
            **more,
        )

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        if self.folder not in _BUILT:
            self.build(self.folder, self.annotated(), own_maps=True)
            _BUILT.add(self.folder)
        return read_tables(self.spark, self.folder)
