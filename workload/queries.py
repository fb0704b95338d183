"""Registered queries: each with its Spark form and, where SQL can say it, its comparison."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import fixed_values as fv
from cohortloom.functions import scalars
from cohortloom.operators import annotate, deidentify, mentions, resources
from cohortloom.operators.cube import cube_levels, cube_meta, read_cube, slice_stored
from cohortloom.operators.dedup import cap_rows, value_counts
from cohortloom.plans import facts, reports
from cohortloom.plans.pipeline import TABLES, read_rejects, read_tables, register_store
from cohortloom.session import settled, shared_folder
from cohortloom.sources import extracts, idmaps, ndjson, notes, snapshots
from cohortloom.sources.catalog import store_bucketed
from cohortloom.sources.named_files import write_named
from cohortloom.streaming.arrivals import cube_schema, load_arriving_cubes, read_loaded_cubes
from workload import sql as q
from workload.shapes import AS_OF, SALT, Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(comparison: str | None = None, name: str | None = None):
    def keep(build: Callable[[Warehouse], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, sf_dir: build(Warehouse(spark, sf_dir))
        if comparison is not None:
            SQL[key] = comparison
        return build

    return keep


# --- resource mappers ------------------------------------------------------------------


@register(q.query(
    f"SELECT {q.patient('p')} AS id, p AS patient_num, gender, CAST(birth AS VARCHAR) AS birth_year,"
    " zip AS postal_code, 'US' AS country,"
    f" '{fv.RACE_EXTENSION}' AS ext_url, {q.cases('RACE_CD', fv.RACE_TO_CODE)} AS race_code,"
    " RACE_CD AS race_display FROM pat"
))
def patient_resource(w: Warehouse) -> DataFrame:
    return w.patient().selectExpr(
        "id", "identifier[0].value AS patient_num", "gender", "birthDate AS birth_year",
        "address[0].postalCode AS postal_code", "address[0].country AS country",
        "extension[0].url AS ext_url",
        "extension[0].extension[0].valueCoding.code AS race_code",
        "extension[0].extension[0].valueCoding.display AS race_display",
    )


@register(q.query(
    f"SELECT {q.patient()} AS id, PATIENT_NUM AS patient_num FROM visit_dimension"
    " WHERE PATIENT_NUM IN (SELECT PATIENT_NUM FROM cohort_p)"
))
def cohort_visits(w: Warehouse) -> DataFrame:
    kept = resources.in_cohort(w.extract("visit_dimension"), w.patients)
    return kept.selectExpr(
        f"{scalars.pseudonym('Patient', 'PATIENT_NUM', SALT)} AS id", "PATIENT_NUM AS patient_num"
    )


@register(q.query(
    f"SELECT {q.uuid('Condition', q.row_key('ENCOUNTER_NUM', 'CONCEPT_CD'))} AS id,"
    " CASE split_part(CONCEPT_CD, ':', 1) WHEN 'ICD9' THEN 'ICD-9' WHEN 'ICD10' THEN 'ICD-10'"
    " ELSE 'Not Found' END AS code_system, nullif(split_part(CONCEPT_CD, ':', 2), '') AS code,"
    f" 'Patient/' || {q.patient()} AS subject, 'Encounter/' || {q.encounter()} AS encounter,"
    " substr(START_DATE, 1, 10) AS onset, 'encounter-diagnosis' AS category FROM cond"
))
def condition_resource(w: Warehouse) -> DataFrame:
    return w.condition().selectExpr(
        "id", "code.coding[0].system AS code_system", "code.coding[0].code AS code",
        "subject.reference AS subject", "encounter.reference AS encounter",
        "onsetDateTime AS onset", "category[0].coding[0].code AS category",
    )


def _lab_sql(value: str) -> str:
    values = "PATIENT_NUM, ENCOUNTER_NUM, CONCEPT_CD, START_DATE, TVAL_CHAR"
    key = q.row_key(*values.split(", "), "occurrence")
    return q.query(
        f"SELECT {q.uuid('Observation', key)} AS id,"
        f" {q.cases('CONCEPT_CD', fv.LAB_TO_LOINC)} AS loinc,"
        f" 'Patient/' || {q.patient()} AS subject, 'Encounter/' || {q.encounter()} AS encounter,"
        f" substr(START_DATE, 1, 10) AS effective, {value} AS value_code, TVAL_CHAR AS value_text"
        f" FROM (SELECT *, row_number() OVER (PARTITION BY {values}) AS occurrence FROM lab_cohort)"
        f" WHERE CONCEPT_CD <> 'LAB:0' AND {q.IN_COHORT}"
    )


def _lab_columns(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "id", "code.coding[0].code AS loinc", "subject.reference AS subject",
        "encounter.reference AS encounter", "effectiveDateTime AS effective",
        "valueCodeableConcept.coding[0].code AS value_code",
        "valueCodeableConcept.coding[0].display AS value_text",
    )


@register(_lab_sql(
    "CASE lower(TVAL_CHAR) WHEN 'positive' THEN '10828004' WHEN 'negative' THEN '260385009'"
    " ELSE '272519000' END"
))
def lab_observation(w: Warehouse) -> DataFrame:
    return _lab_columns(w.lab())


@register(_lab_sql(
    "CASE TVAL_CHAR WHEN 'Positive' THEN '10828004' WHEN 'Negative' THEN '260385009'"
    " ELSE '272519000' END"
))
def lab_observation_exact_case(w: Warehouse) -> DataFrame:
    return _lab_columns(w.lab(case_sensitive=True))


@register(q.query(
    f"SELECT {q.uuid('DocumentReference', q.row_key('row_id'))} AS id,"
    f" 'Patient/' || {q.patient()} AS subject, 'Encounter/' || {q.encounter()} AS encounter,"
    " CONCEPT_CD AS type_text, substr(START_DATE, 1, 10) || 'T00:00:00Z' AS date,"
    " to_base64(encode(OBSERVATION_BLOB)) AS data FROM note_cohort"
))
def document_reference(w: Warehouse) -> DataFrame:
    return w.document().selectExpr(
        "id", "subject.reference AS subject", "context.encounter[0].reference AS encounter",
        "type.text AS type_text", "date", "content[0].attachment.data AS data",
    )


@register(q.query(
    f"SELECT {q.encounter()} AS id, ENCOUNTER_NUM AS encounter_num,"
    " CASE INOUT_CD WHEN 'Inpatient' THEN 'IMP' ELSE 'EMER' END AS class,"
    f" 'Patient/' || {q.patient()} AS subject, START_DATE AS start_time, END_DATE AS end_time"
    " FROM visit_dimension WHERE PATIENT_NUM IN (SELECT PATIENT_NUM FROM cohort_p)"
))
def encounter_resource(w: Warehouse) -> DataFrame:
    return w.encounter().selectExpr(
        "id", "identifier[0].value AS encounter_num", "class.code AS class",
        "subject.reference AS subject", "period.start AS start_time", "period.end AS end_time",
    )


def _classifier_columns(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "id", "subject.reference AS subject", "encounter.reference AS encounter",
        "effectiveDateTime AS effective", "valueCodeableConcept.coding[0].display AS prediction",
        "valueCodeableConcept.coding[0].code AS value_code",
        "modifierExtension[0].valueString AS tag", "modifierExtension[0].valueInteger AS number",
    )


def _classifier_sql(source: str, prediction: str, tag: str, number: str) -> str:
    return q.query(
        f"SELECT {q.uuid('Observation', q.row_key(quoted(tag), 'e'))} AS id,"
        f" 'Patient/' || {q.patient('p')} AS subject, 'Encounter/' || {q.encounter('e')} AS encounter,"
        f" d AS effective, {prediction} AS prediction,"
        " CASE r WHEN 'Positive' THEN '10828004' ELSE '260385009' END AS value_code,"
        f" '{tag}' AS tag, CAST({number} AS INTEGER) AS number FROM {source}"
    )


def quoted(value: str) -> str:
    return f"'{value}'"


@register(_classifier_sql("cl", "PREDICTION", fv.CLASSIFIER_202204, "NULL"))
def classifier_observation(w: Warehouse) -> DataFrame:
    return _classifier_columns(w.classifier())


@register(_classifier_sql("cl1", "V1_PREDICTION", fv.CLASSIFIER_V1, "1"))
def classifier_observation_v1(w: Warehouse) -> DataFrame:
    return _classifier_columns(w.classifier(fv.CLASSIFIER_V1))


@register(q.query(
    f"SELECT 'Patient' AS kind, PATIENT_NUM AS source_id, {q.patient()} AS uuid FROM cohort_p"
    f" UNION ALL SELECT 'Encounter', ENCOUNTER_NUM, {q.encounter()} FROM cohort_e"
))
def cohort_id_map(w: Warehouse) -> DataFrame:
    named = [
        m.select(F.lit(kind).alias("kind"), "source_id", "uuid")
        for kind, m in (("Patient", w.patients), ("Encounter", w.encounters))
    ]
    return named[0].unionByName(named[1])


@register(q.query(
    f"SELECT PATIENT_NUM AS source_id, {q.patient()} AS uuid FROM"
    " (SELECT PATIENT_NUM FROM cohort_p UNION SELECT PATIENT_NUM FROM visit_dimension)"
))
def id_map_extension(w: Warehouse) -> DataFrame:
    return idmaps.extend_id_map(
        w.patients, w.extract("visit_dimension"), "PATIENT_NUM", "Patient", SALT
    )


# --- annotations -----------------------------------------------------------------------

_CODING = "'http://snomed.info/sct|' || snomed_code || '|' || mention_text || ';'" \
    " || 'http://www.nlm.nih.gov/research/umls/rxnorm|RX' || snomed_code || '|' || mention_text || ';'" \
    " || 'urn:oid:2.16.840.1.113883.6.86|' || cui || '|cui;'" \
    f" || '{fv.TUI_SYSTEM}|T184|tui'"


def _mention_sql(kind: str, types: dict[str, str]) -> str:
    kept = q.listed(types)
    first = (
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ENCOUNTER_NUM, cui ORDER BY row_id) k"
        f" FROM nlp_mention WHERE {q.IN_COHORT} AND sem_type IN ({kept})) WHERE k = 1"
        f" AND {q.cases('sem_type', types)} = '{kind}'"
    )
    enc = f"'Encounter/' || {q.encounter()}" if kind == "Observation" else "CAST(NULL AS VARCHAR)"
    key = q.row_key(q.encounter(), "cui")
    return q.query(
        f"SELECT {q.uuid(kind, key)} AS id, 'Patient/' || {q.patient()} AS subject, {enc} AS encounter,"
        " CAST(begin_pos AS INTEGER) AS begin_pos, CAST(end_pos AS INTEGER) AS end_pos,"
        " substr(START_DATE, 1, 10) AS note_date, CAST(polarity AS INTEGER) AS polarity,"
        f" {_CODING} AS codings FROM picked",
        picked=first,
    )


def _mention_columns(df: DataFrame, kind: str) -> DataFrame:
    coded = "medicationCodeableConcept" if kind == "MedicationStatement" else "code"
    enc = "encounter.reference" if kind == "Observation" else "CAST(NULL AS STRING)"
    return df.selectExpr(
        "id", "subject.reference AS subject", f"{enc} AS encounter",
        "extension[0].extension[0].valueInteger AS begin_pos",
        "extension[0].extension[1].valueInteger AS end_pos",
        "modifierExtension[0].extension[0].valueDate AS note_date",
        "modifierExtension[1].valueInteger AS polarity",
        f"array_join(transform({coded}.coding, c -> concat_ws('|', c.system, c.code, c.display)), ';')"
        " AS codings",
    )


def _register_mentions(name: str, kind: str, types: dict[str, str]) -> None:
    @register(_mention_sql(kind, types), name)
    def build(w: Warehouse) -> DataFrame:
        annotated = w.annotated(symptom_only=False)
        df = mentions.mention_resources(annotated, kind, SALT, ["row_id"], types)
        return _mention_columns(df, kind)


_register_mentions("nlp_observation", "Observation", fv.DEFAULT_MENTION_TYPES)
_register_mentions("nlp_condition", "Condition", fv.ALL_MENTION_TYPES)
_register_mentions("nlp_medication", "MedicationStatement", fv.ALL_MENTION_TYPES)
_register_mentions("nlp_procedure", "Procedure", fv.ALL_MENTION_TYPES)


@register(q.query(
    "SELECT resource_type AS \"resourceType\", count(*) AS n, count(DISTINCT ENCOUNTER_NUM) AS subjects_seen"
    f" FROM (SELECT *, {q.cases('sem_type', fv.ALL_MENTION_TYPES)} AS resource_type,"
    " row_number() OVER (PARTITION BY ENCOUNTER_NUM, cui ORDER BY row_id) k"
    f" FROM nlp_mention WHERE {q.IN_COHORT}) WHERE k = 1 GROUP BY resource_type"
).replace("count(DISTINCT ENCOUNTER_NUM) AS subjects_seen", "count(DISTINCT PATIENT_NUM) AS subjects"))
def mention_files(w: Warehouse) -> DataFrame:
    """Mention resources written as JSON lines per type and read back."""
    usable, _ = mentions.usable_mentions(mentions.explode_mentions(
        w.annotated(symptom_only=False), fv.ALL_MENTION_TYPES, ["row_id"]
    ))
    folder = shared_folder(w.spark)
    lines = mentions.mention_lines(mentions.first_mentions(usable, ["row_id"]), SALT)
    ndjson.write_resource_lines(lines, folder)
    back = w.spark.read.schema("value string, resourceType string").text(folder)
    subject = F.get_json_object("value", "$.subject.reference")
    return back.groupBy("resourceType").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(subject).alias("subjects")
    )


@register(q.query(
    f"SELECT {q.patient('p')} AS id, p AS patient_num, gender, CAST(birth AS VARCHAR) AS birth_year,"
    " RACE_CD AS race_display, zip AS postal_code FROM pat"
))
def resource_files(w: Warehouse) -> DataFrame:
    """Resources written as gzip NDJSON, fields without value left out, and read back."""
    folder = shared_folder(w.spark)
    ndjson.write_resources({"Patient": w.patient()}, folder, compression="gzip")
    rows, _ = ndjson.read_ndjson(w.spark, f"{folder}/resourceType=Patient", schemas.RESOURCES["Patient"])
    return rows.selectExpr(
        "id", "identifier[0].value AS patient_num", "gender", "birthDate AS birth_year",
        "extension[0].extension[0].valueCoding.display AS race_display",
        "address[0].postalCode AS postal_code",
    )


@register(q.query(
    f"SELECT n.row_id, {q.patient()} AS patient_uuid, {q.encounter()} AS encounter_uuid, START_DATE AS start_date,"
    " CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS types, CAST(-l.toxic AS INTEGER) AS polarity"
    " FROM note_cohort n LEFT JOIN labels l ON n.row_id = l.doc_id"
))
def annotated_notes(w: Warehouse) -> DataFrame:
    annotated, _ = w.annotated_by_labels("note_cohort")
    return annotated.selectExpr(
        "row_id", "PATIENT_NUM AS patient_uuid", "ENCOUNTER_NUM AS encounter_uuid",
        "START_DATE AS start_date", "cardinality(OBSERVATION_BLOB) AS types",
        "get(try_element_at(OBSERVATION_BLOB, 'SignSymptomMention'), 0).polarity AS polarity",
    )


@register(q.query(
    f"SELECT 'Encounter/' || {q.encounter()} AS encounter, {q.patient()} AS patient_uuid,"
    " substr(START_DATE, 1, 10) AS note_date, 0 AS attachment_pos, OBSERVATION_BLOB AS text FROM note_cohort"
    " WHERE substr(START_DATE, 1, 10) BETWEEN '1996-01-01' AND '2000-12-31'"
))
def note_text_from_documents(w: Warehouse) -> DataFrame:
    dated = w.document().where("substring(date, 1, 10) BETWEEN '1996-01-01' AND '2000-12-31'")
    return notes.document_notes(dated, w.spark.createDataFrame([], notes.NO_FILES))


_LEN = "length(OBSERVATION_BLOB)"


@register(q.query(
    f"SELECT 'note' AS status, 'Encounter/' || {q.encounter()} AS encounter, md5(OBSERVATION_BLOB) AS text_md5"
    f" FROM note_cohort WHERE {_LEN} % 5 <> 0 AND {_LEN} % 4 <> 2 AND NOT ({_LEN} % 4 = 1 AND {_LEN} % 3 = 0)"
    f" UNION ALL SELECT 'reject', 'Encounter/' || {q.encounter()}, NULL FROM note_cohort"
    f" WHERE {_LEN} % 5 <> 0 AND {_LEN} % 4 = 1 AND {_LEN} % 3 = 0"
))
def note_text_linked(w: Warehouse) -> DataFrame:
    """Documents of other categories and content types, and texts by url, some without a file."""
    text = scalars.decode_note("content[0].attachment.data")
    documents = w.document().selectExpr("*", f"length({text}) AS n", "concat('/notes/', id) AS path")
    files = documents.where("n % 4 = 1 AND n % 3 <> 0").selectExpr("path", f"{text} AS text")
    attachment = (
        "named_struct('contentType', IF(n % 4 = 2, 'application/pdf', a.attachment.contentType),"
        " 'data', IF(n % 4 = 1, NULL, a.attachment.data), 'url', IF(n % 4 = 1, path, NULL))"
    )
    coding = "named_struct('system', c.system, 'code', IF(n % 5 = 0, 'radiology', c.code), 'display', c.display)"
    mixed = documents.withColumn("content", F.expr(f"transform(content, a -> named_struct('attachment', {attachment}))"))
    mixed = mixed.withColumn("category", F.expr(
        f"transform(category, k -> named_struct('coding', transform(k.coding, c -> {coding}), 'text', k.text))"))
    found = notes.document_notes(mixed, files).selectExpr("'note' AS status", "encounter", "md5(text) AS text_md5")
    rejected = notes.document_note_rejects(mixed, files)
    return found.unionByName(rejected.selectExpr("'reject' AS status", "encounter", "CAST(NULL AS STRING) AS text_md5"))


@register(q.query(
    f"SELECT 'data' AS kind, 'Encounter/' || {q.encounter()} AS encounter, md5(OBSERVATION_BLOB) AS text_md5"
    " FROM note_cohort WHERE row_id % 3 <> 0"
    f" UNION ALL SELECT 'file', 'Encounter/' || {q.encounter()}, md5(text) FROM note_cohort JOIN files ON row_id % 24 = g AND row_id % 3 = 0 AND g < 18"
    f" UNION ALL SELECT 'reject', 'Encounter/' || {q.encounter()}, NULL FROM note_cohort WHERE row_id % 3 = 0 AND row_id % 24 >= 18",
    files="SELECT row_id % 24 AS g, string_agg(CAST(row_id AS VARCHAR) || chr(10), '' ORDER BY row_id) AS text FROM note_cohort GROUP BY g",
))
def note_text_from_files(w: Warehouse) -> DataFrame:
    """Texts in files that attachments name, some named by path and some relative, some missing, some never named."""
    root = shared_folder(w.spark)
    numbered = w.extract("note_cohort").selectExpr("row_id", "concat('group-', row_id % 24) AS file").where("row_id % 24 < 18")
    lines = numbered.repartition("file").sortWithinPartitions("file", "row_id")
    write_named(lines.select("file", F.col("row_id").cast("string").alias("line")), "file", ".txt", root)
    name = f"concat(IF(row_id % 2 = 0, '{root}/', ''), 'group-', row_id % 24, '.txt')"
    attachment = (
        "named_struct('contentType', a.attachment.contentType, 'data', IF(row_id % 3 = 0, NULL, a.attachment.data),"
        f" 'url', IF(row_id % 3 = 0, {name}, NULL))"
    )
    # Rows of one id meet each other; few repeat, so that their numbers are joined without moving the texts.
    repeats = settled(w.extract("note_cohort").groupBy("row_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    met = w.document(["row_id"]).join(repeats, "row_id", "left").withColumn("time", F.expr("explode(sequence(1, coalesce(times, 1)))"))
    # Written once for all four uses.
    documents = settled(met.withColumn("content", F.expr(f"transform(content, a -> named_struct('attachment', {attachment}))")))
    files = notes.linked_texts(documents, root, max_files=8)
    inline = notes.document_notes(documents.where("row_id % 3 <> 0"), files).selectExpr("'data' AS kind", "encounter", "md5(text) AS text_md5")
    linked = notes.document_notes(documents.where("row_id % 3 = 0"), files).selectExpr("'file' AS kind", "encounter", "md5(text) AS text_md5")
    rejected = notes.document_note_rejects(documents, files).selectExpr("'reject' AS kind", "encounter", "CAST(NULL AS STRING) AS text_md5")
    return inline.unionByName(linked).unionByName(rejected)


# --- line and file sources -------------------------------------------------------------

_HEADER = "turn > 0 AND turn % 2 = 0"


@register(
    r"WITH t AS (SELECT conv_id, turn, CASE WHEN turn > 0 AND turn % 2 = 0 THEN 1 ELSE 0 END h,"
    r" '2020-01-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0') || ' visit' AS header,"
    r" list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\s\p{Z}]+$', '')) AS lines"
    r" FROM conversations),"
    r" s AS (SELECT *, sum(h) OVER (PARTITION BY conv_id ORDER BY turn) AS seg FROM t),"
    r" g AS (SELECT conv_id, seg, max(CASE WHEN h = 1 THEN header END) AS header,"
    r" string_agg(chr(10) || array_to_string(lines, chr(10)), '' ORDER BY turn) AS text FROM s GROUP BY ALL)"
    f" SELECT {q.uuid('Patient', 'CAST(conv_id AS VARCHAR)')} AS patient_uuid,"
    " coalesce(header, '1900-01-01') AS note_date, text FROM g WHERE length(text) > 1"
)
def dated_note_segments(w: Warehouse) -> DataFrame:
    """Conversations as dated note files: every second turn starts with a date line."""
    header = (
        f"CASE WHEN {_HEADER} THEN array(concat('2020-01-', lpad(CAST(turn % 28 + 1 AS STRING), 2, '0'),"
        " ' visit  ')) ELSE array() END"
    )
    lines = w.table("conversations").selectExpr(
        f"{scalars.pseudonym('Patient', 'CAST(conv_id AS STRING)', SALT)} AS patient_uuid",
        "CAST(conv_id AS STRING) AS src_file", "turn AS src_block",
        rf"posexplode(concat({header}, split(text, '\n'))) AS (src_row, line)",
    )
    return notes.segment_notes(lines).select("patient_uuid", "note_date", "text")


@register(
    "SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN 'dated_text' WHEN 1 THEN 'ndjson' WHEN 2 THEN 'ndjson'"
    " WHEN 3 THEN 'unrecognised' ELSE 'unrecognised' END AS kind FROM conversations"
)
def input_routing(w: Warehouse) -> DataFrame:
    stem = scalars.pseudonym("File", "CAST(conv_id AS STRING)", SALT)
    name = (
        f"CASE turn % 5 WHEN 0 THEN concat({stem}, '.txt') WHEN 1 THEN concat({stem}, '.NDJSON')"
        f" WHEN 2 THEN 'notes.json.gz' WHEN 3 THEN concat('visit-', conv_id, '.txt') ELSE concat({stem}, '.csv') END"
    )
    named = w.table("conversations").selectExpr("conv_id", "turn", f"{name} AS file_name")
    return named.selectExpr("conv_id", "turn", f"{ndjson.input_kind('file_name')} AS kind")


@register(
    "SELECT 'ndjson' AS kind, count(*) AS lines FROM conversations"
    " UNION ALL SELECT 'dated_text', count(*) FILTER (WHERE turn % 2 = 1) FROM conversations"
    " UNION ALL SELECT 'unrecognised', count(*) + count(*) FILTER (WHERE turn % 2 = 0) FROM conversations"
)
def routed_lines(w: Warehouse) -> DataFrame:
    """Lines of a folder of gzip, text and CSV files, read by the kind of their names."""
    root, turns = shared_folder(w.spark), w.table("conversations")
    turns.select(F.to_json(F.struct("conv_id", "turn")).alias("value")).write.option("compression", "gzip").text(f"{root}/json")
    turns.where("turn % 2 = 0").select(F.col("role").alias("value")).write.text(f"{root}/text")
    stem = scalars.pseudonym("File", "CAST(turn % 8 AS STRING)", SALT)
    dated = turns.where("turn % 2 = 1").select(F.expr(stem).alias("file"), F.col("role").alias("value"))
    write_named(dated.repartition("file"), "file", ".txt", f"{root}/dated")
    turns.select("conv_id", "turn").write.csv(f"{root}/csv")
    kinds = ndjson.list_inputs(w.spark, f"{root}/*").select("kind").distinct()
    out = None
    for kind in (ndjson.NDJSON, ndjson.DATED_TEXT, ndjson.UNRECOGNISED):
        lines = ndjson.read_lines(w.spark, f"{root}/*", kind).groupBy(F.lit(kind).alias("kind")).agg(F.count(F.lit(1)).alias("lines"))
        out = lines if out is None else out.unionByName(lines)
    return out.join(kinds, "kind")


_FILE = "concat('notes-', conv_id % 16)"


@register(
    r"WITH t AS (SELECT *, CASE WHEN turn > 0 AND turn % 2 = 0 THEN 1 ELSE 0 END h,"
    r" '2020-01-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0') || ' visit' AS header,"
    r" list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\s\p{Z}]+$', '')) AS lines,"
    rf" {_FILE} AS file FROM conversations),"
    r" s AS (SELECT *, sum(h) OVER (PARTITION BY file ORDER BY conv_id, turn) AS seg FROM t),"
    r" g AS (SELECT file, seg, max(CASE WHEN h = 1 THEN header END) AS header,"
    r" string_agg(chr(10) || array_to_string(lines, chr(10)), '' ORDER BY conv_id, turn) AS text FROM s GROUP BY ALL)"
    f" SELECT {q.uuid('File', 'file')} AS patient_uuid,"
    " coalesce(header, '1900-01-01') AS note_date, text FROM g WHERE length(text) > 1"
)
def dated_note_files(w: Warehouse) -> DataFrame:
    """Conversations as note files of many patients, found in a folder by name and cut at their date lines."""
    root = shared_folder(w.spark)
    header = (
        f"CASE WHEN {_HEADER} THEN array(concat('2020-01-', lpad(CAST(turn % 28 + 1 AS STRING), 2, '0'),"
        " ' visit  ')) ELSE array() END"
    )
    lines = w.table("conversations").selectExpr(
        f"{scalars.pseudonym('File', _FILE, SALT)} AS file", "conv_id", "turn",
        rf"posexplode(concat({header}, split(text, '\n'))) AS (pos, line)")
    order = ["file", "conv_id", "turn", "pos"]
    write_named(lines.repartition("file").sortWithinPartitions(*order).select("file", "line"), "file", ".txt", root)
    return notes.segment_notes(notes.read_note_lines(w.spark, root)).select("patient_uuid", "note_date", "text")


@register(q.query(
    "SELECT 'row' AS status, substr(START_DATE, 1, 10) AS note_date, count(*) AS n,"
    " CAST(sum(polarity) AS BIGINT) AS polarity"
    f" FROM nlp_mention WHERE row_id % 10 <> 0 AND {q.IN_COHORT} GROUP BY ALL"
    f" UNION ALL SELECT 'reject', NULL, count(*), NULL FROM nlp_mention WHERE row_id % 10 = 0 AND {q.IN_COHORT}"
))
def ndjson_rejects(w: Warehouse) -> DataFrame:
    """Annotated notes written as gzip NDJSON with every tenth line cut short, and read."""
    whole = F.to_json(F.struct("PATIENT_NUM", "ENCOUNTER_NUM", "START_DATE", "OBSERVATION_BLOB"))
    lines = w.annotated().select("row_id", whole.alias("value")).selectExpr(
        "IF(row_id % 10 = 0, left(value, length(value) - 5), value) AS value"
    )
    folder = shared_folder(w.spark)
    lines.write.mode("overwrite").option("compression", "gzip").text(folder)
    return _read_back(w, folder)


def _read_back(w: Warehouse, folder: str) -> DataFrame:
    """Rows by day and rejects, from one scan and one parse."""
    return ndjson.read_marked(w.spark, folder, schemas.ANNOTATED_NOTE).selectExpr(
        "IF(reject IS NULL, 'row', 'reject') AS status",
        f"IF(reject IS NULL, {scalars.day('START_DATE')}, NULL) AS note_date",
        "IF(reject IS NULL, get(OBSERVATION_BLOB['SignSymptomMention'], 0).polarity, NULL) AS p",
    ).groupBy("status", "note_date").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("polarity"))


@register(q.query(
    "SELECT 'row' AS status, substr(START_DATE, 1, 10) AS note_date, count(*) AS n,"
    " CAST(sum(polarity) AS BIGINT) AS polarity"
    f" FROM nlp_mention WHERE {q.IN_COHORT} GROUP BY ALL"
    f" UNION ALL SELECT 'reject', NULL, count(*), NULL FROM nlp_mention WHERE row_id % 3 = 0 AND {q.IN_COHORT}"
))
def ndjson_plain(w: Warehouse) -> DataFrame:
    """Annotated notes as plain NDJSON, with lines of other text between them."""
    whole = F.to_json(F.struct("PATIENT_NUM", "ENCOUNTER_NUM", "START_DATE", "OBSERVATION_BLOB"))
    lines = w.annotated().select("row_id", whole.alias("value")).selectExpr(
        "explode(IF(row_id % 3 = 0, array(value, concat('-- ', row_id)), array(value))) AS value")
    folder = shared_folder(w.spark)
    lines.write.text(folder)
    return _read_back(w, folder)


@register(q.query(
    "SELECT ENCOUNTER_NUM, PATIENT_NUM, CONCEPT_CD, START_DATE, TVAL_CHAR FROM lab_cohort"
))
def csv_extract_roundtrip(w: Warehouse) -> DataFrame:
    columns = ["ENCOUNTER_NUM", "PATIENT_NUM", "CONCEPT_CD", "START_DATE", "TVAL_CHAR"]
    folder = shared_folder(w.spark)
    extracts.write_csv(w.extract("lab_cohort").select(*columns), folder)
    return extracts.read_extract(w.spark, f"{folder}/*.csv", columns, splittable=True)


@register(q.query(
    "SELECT ENCOUNTER_NUM, PATIENT_NUM, TVAL_CHAR FROM lab_cohort"
))
def csv_mixed_headers(w: Warehouse) -> DataFrame:
    """Files with the columns in another order and beside others, read by name."""
    root, rows = shared_folder(w.spark), w.extract("lab_cohort")
    positive = F.coalesce(F.col("TVAL_CHAR") == "Positive", F.lit(False))
    extracts.write_csv(rows.where(positive).select("TVAL_CHAR", "PATIENT_NUM", "ENCOUNTER_NUM"), f"{root}/a")
    extracts.write_csv(rows.where(~positive).select("ENCOUNTER_NUM", "CONCEPT_CD", "TVAL_CHAR", "PATIENT_NUM"), f"{root}/b")
    return extracts.read_extract(
        w.spark, [f"{root}/a", f"{root}/b"], ["ENCOUNTER_NUM", "PATIENT_NUM", "TVAL_CHAR"], splittable=True)


@register(q.query(
    f"SELECT PATIENT_NUM AS source_id, {q.patient()} AS uuid FROM cohort_p"
    f" UNION ALL SELECT PATIENT_NUM || ', \"ward\" ' || chr(92) || ' 1' || chr(10), {q.patient()} FROM cohort_p"
))
def id_map_json_import(w: Warehouse) -> DataFrame:
    """The patient map, also under keys with commas, quotes and escapes, as JSON in many files, imported in splits."""
    folder = shared_folder(w.spark)
    odd = F.concat("source_id", F.lit(', "ward" \\ 1\n'))
    keys = w.patients.unionByName(w.patients.select(odd.alias("source_id"), "uuid"))
    entry = F.to_json(F.create_map("source_id", "uuid"))
    keys.repartitionByRange("source_id").select(F.regexp_replace(entry, r"^\{|\}$", "").alias("value")).write.option("lineSep", ",").text(folder)
    return idmaps.import_json_id_map(w.spark, folder)


@register(q.query(
    "SELECT CAST(row_id AS VARCHAR) AS row_id, md5(OBSERVATION_BLOB) AS text_md5,"
    " length(OBSERVATION_BLOB) AS n_chars FROM note_cohort"
))
def csv_note_roundtrip(w: Warehouse) -> DataFrame:
    folder = shared_folder(w.spark)
    extracts.write_csv(w.extract("note_cohort"), folder)
    back = extracts.read_extract(w.spark, folder, ["row_id", "OBSERVATION_BLOB"])
    return back.selectExpr(
        "row_id", "md5(OBSERVATION_BLOB) AS text_md5",
        "CAST(length(OBSERVATION_BLOB) AS BIGINT) AS n_chars",
    )


@register(q.query(
    "SELECT ENCOUNTER_NUM, CASE min(row_id * 2 + CASE PREDICTION WHEN 'positive' THEN 0 ELSE 1 END) % 2"
    " WHEN 0 THEN 'positive' ELSE 'Negative' END AS PREDICTION FROM classifier_prediction GROUP BY ENCOUNTER_NUM"
))
def first_predictions(w: Warehouse) -> DataFrame:
    """Classifier results written in row order as CSV; first row per encounter read back."""
    folder = shared_folder(w.spark)
    ordered = w.extract("classifier_prediction").repartitionByRange("row_id").sortWithinPartitions("row_id")
    extracts.write_csv(ordered.select("ENCOUNTER_NUM", "PREDICTION"), folder)
    back = extracts.read_extract(
        w.spark, folder, schemas.EXTRACT_COLUMNS["classifier_results"], position=True, splittable=True
    )
    return resources.first_predictions(back, extracts.POSITION)


# --- stored tables ---------------------------------------------------------------------

_CODED = "row_id % 11 <> 0"
_PICKED = (
    f"SELECT {q.cases('sem_type', fv.ALL_MENTION_TYPES)} AS kind FROM (SELECT *, row_number() OVER"
    f" (PARTITION BY ENCOUNTER_NUM, cui ORDER BY row_id) k FROM nlp_mention WHERE {_CODED} AND {q.IN_COHORT}) WHERE k = 1"
)
_NLP_TABLES = ("condition", "observation", "medicationstatement", "procedure")


@register(q.query("SELECT kind, count(*) AS n FROM picked GROUP BY kind", picked=_PICKED))
def stored_mentions_by_type(w: Warehouse) -> DataFrame:
    """Mentions of every mapped type in the stored tables."""
    out = None
    for name, df in read_tables(w.spark, w.full_folder, _NLP_TABLES).items():
        noted = df.where(f"exists(modifierExtension.url, u -> u = '{fv.POLARITY_URL}')").groupBy(
            F.lit(TABLES[name]).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
        out = noted if out is None else out.unionByName(noted)
    return out


@register(q.query(
    "SELECT 'mentions' AS stage, count(*) AS taken, count(*) FILTER (WHERE coded) AS kept,"
    f" count(*) FILTER (WHERE NOT coded) AS rejected FROM (SELECT {_CODED} AS coded FROM nlp_mention WHERE {q.IN_COHORT})"
    " UNION ALL SELECT 'note_ids', count(*), count(*) FILTER (WHERE known), count(*) FILTER (WHERE NOT known)"
    f" FROM (SELECT {q.IN_COHORT} AS known FROM nlp_mention)"
))
def stage_rejects(w: Warehouse) -> DataFrame:
    """What went into a stage, what it mapped, and what the store holds as its rejects."""
    exploded = mentions.explode_mentions(w.annotated(False, 11), fv.ALL_MENTION_TYPES, ["row_id"])
    usable, _ = mentions.usable_mentions(exploded)
    mapped, _ = w.annotated_by_labels("nlp_mention")
    parts = (
        ("mentions", "taken", exploded), ("mentions", "kept", usable),
        ("mentions", "rejected", read_rejects(w.spark, w.full_folder, "mentions")),
        ("note_ids", "taken", w.extract("nlp_mention")), ("note_ids", "kept", mapped),
        ("note_ids", "rejected", read_rejects(w.spark, w.full_folder, "note_ids")),
    )
    out = None
    for stage, name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    sums = [F.sum(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in ("taken", "kept", "rejected")]
    return out.groupBy("stage").agg(*sums)


@register(q.query(
    f"SELECT {q.uuid('DocumentReference', q.row_key('row_id'))} AS id, md5(OBSERVATION_BLOB) AS text_md5 FROM note_cohort"
))
def stored_document_content(w: Warehouse) -> DataFrame:
    data = scalars.decode_note("content[0].attachment.data")
    return w.tables["documentreference"].selectExpr("id", f"md5({data}) AS text_md5")


def _rows_of(name: str, *counted: str) -> str:
    """Expected rows of a table: the sum of counts over (relation and condition)."""
    return f"SELECT '{name}' AS name, {' + '.join(f'(SELECT count(*) FROM {c})' for c in counted)} AS rows, CAST(0 AS BIGINT) AS duplicates"


@register(q.query(" UNION ALL ".join((
    _rows_of("patient", "pat"),
    _rows_of("condition", "cond", "picked WHERE kind = 'Condition'"),
    _rows_of("observation", f"lab_cohort WHERE CONCEPT_CD <> 'LAB:0' AND {q.IN_COHORT}", "cl", "cl1", "picked WHERE kind = 'Observation'"),
    _rows_of("documentreference", "note_cohort"),
    _rows_of("encounter", "visit_dimension WHERE PATIENT_NUM IN (SELECT PATIENT_NUM FROM cohort_p)"),
    _rows_of("medicationstatement", "picked WHERE kind = 'MedicationStatement'"),
    _rows_of("procedure", "picked WHERE kind = 'Procedure'"),
)), picked=_PICKED))
def resource_id_uniqueness(w: Warehouse) -> DataFrame:
    """Rows of each stored table, and rows whose id is not the first of its kind."""
    out = None
    for name, df in read_tables(w.spark, w.full_folder, tuple(TABLES)).items():
        one = df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        ).select(F.lit(name).alias("name"), "rows", "duplicates")
        out = one if out is None else out.unionByName(one)
    return out


@register(q.query(
    f"SELECT 'Patient/' || {q.patient()} AS reference, {q.patient()} AS reference_id_aa,"
    " substr(START_DATE, 1, 10) AS onset FROM cond"
))
def reference_annotation(w: Warehouse) -> DataFrame:
    return w.tables["condition"].selectExpr(
        "subject.reference AS reference", "subject.reference_id_aa AS reference_id_aa",
        "onsetDateTime AS onset",
    )


@register(q.query(
    "SELECT substr(START_DATE, 1, 10) AS raw, substr(START_DATE, 1, 10) AS start_day,"
    " substr(START_DATE, 1, 10) AS end_day FROM cond"
    " UNION ALL SELECT CAST(birth AS VARCHAR), CAST(birth AS VARCHAR) || '-01-01',"
    " CAST(birth AS VARCHAR) || '-12-31' FROM pat"
    " UNION ALL SELECT substr(START_DATE, 1, 7), substr(START_DATE, 1, 7) || '-01',"
    " CAST(last_day(CAST(substr(START_DATE, 1, 10) AS DATE)) AS VARCHAR) FROM visit_dimension"
))
def date_annotation(w: Warehouse) -> DataFrame:
    """Day, year and month precision."""
    days = w.tables["condition"].selectExpr(
        "onsetDateTime AS raw", "onsetDateTime_aa.start AS start_day", "onsetDateTime_aa.end AS end_day"
    )
    years = w.tables["patient"].selectExpr("birthDate", "birthDate_aa.start", "birthDate_aa.end")
    months = w.extract("visit_dimension").selectExpr("substring(START_DATE, 1, 7) AS raw")
    months = months.withColumn("r", F.expr(annotate.date_range("raw"))).select("raw", "r.start", "r.end")
    return days.union(years).union(months)


@register(q.query(
    f"SELECT {q.patient('p')} AS id, RACE_CD AS display, RACE_CD AS display_aa FROM pat"
))
def display_annotation(w: Warehouse) -> DataFrame:
    return w.tables["patient"].selectExpr("id", "inline(extension.valueCoding)").select(
        "id", "display", "display_aa"
    )


@register(
    r"WITH p AS (SELECT event_id, 'Patient' || repeat('.extension', CAST(event_id % 4 AS INT))"
    r" || CASE WHEN event_id % 3 = 0 THEN '.modifierExtension' ELSE '' END"
    r" || CASE WHEN event_id % 5 = 0 THEN '.' || event_type || '.extension.extension' ELSE '' END"
    r" || '.url' AS path FROM events)"
    r" SELECT event_id, path, regexp_replace(path, '(modifierExtension|extension)(\.(modifierExtension|extension))+',"
    r" '\1', 'g') AS trimmed FROM p"
)
def extension_path_trim(w: Warehouse) -> DataFrame:
    paths = w.table("events").selectExpr(
        "event_id",
        "concat('Patient', repeat('.extension', CAST(event_id % 4 AS INT)),"
        " IF(event_id % 3 = 0, '.modifierExtension', ''),"
        " IF(event_id % 5 = 0, concat('.', event_type, '.extension.extension'), ''), '.url') AS path",
    )
    return paths.selectExpr("event_id", "path", f"{annotate.trim_extension_path('path')} AS trimmed")


_FIRST_KEY = q.row_key(q.encounter(), "cui")


@register(q.query(
    f"SELECT id, 0 AS pos, 'dateofauthorship' AS url, '{fv.ALGORITHM_URL}' AS parent,"
    " CAST(NULL AS INTEGER) AS value_integer, substr(START_DATE, 1, 10) AS value_date FROM picked"
    f" UNION ALL SELECT id, 1, '{fv.POLARITY_URL}', NULL, CAST(polarity AS INTEGER), NULL FROM picked",
    picked=f"SELECT {q.uuid('Observation', _FIRST_KEY)} AS id, START_DATE, polarity FROM m1 WHERE rn = 1",
))
def extension_flatten(w: Warehouse) -> DataFrame:
    noted = w.tables["observation"].where(
        f"exists(modifierExtension.url, u -> u = '{fv.POLARITY_URL}')"
    )
    return noted.selectExpr("id", "posexplode(modifierExtension) AS (pos, m)").selectExpr(
        "id", "pos", "m.url AS url", "m.parent AS parent", "m.valueInteger AS value_integer",
        "m.valueDate AS value_date",
    )


@register(q.query(
    f"SELECT {q.patient('p')} AS id, CAST(birth AS VARCHAR) AS birth_year, '{fv.RACE_EXTENSION}' AS ext_url,"
    f" 'ombCategory' AS inner_url, {q.cases('RACE_CD', fv.RACE_TO_CODE)} AS race_code,"
    " RACE_CD AS race_display, 'id,extension,birthDate' AS kept FROM pat"
))
def allowlist_projection(w: Warehouse) -> DataFrame:
    kept = deidentify.project_allowed(w.patient(), "Patient")
    return kept.selectExpr(
        "id", "birthDate AS birth_year", "extension[0].url AS ext_url",
        "extension[0].extension[0].url AS inner_url",
        "extension[0].extension[0].valueCoding.code AS race_code",
        "extension[0].extension[0].valueCoding.display AS race_display",
        f"'{','.join(kept.columns)}' AS kept",
    )


# A site's base rules, which the shipped rules extend: codes and ids stay.
_BASE_RULES = [
    ("nodesByType('Coding').system", "keep", "codes"), ("nodesByType('Coding').code", "keep", "codes"),
    *((f"{kind}.id", "keep", "ids") for kind in mentions.KINDS),
]
_KEPT = {
    "Observation": "id,category,code,subject,encounter,effectiveDateTime,valueCodeableConcept,extension,modifierExtension",
    "Condition": "id,clinicalStatus,verificationStatus,category,code,subject,encounter,onsetDateTime,onsetAge,extension,modifierExtension",
    "MedicationStatement": "id,medicationCodeableConcept,subject,extension,modifierExtension",
    "Procedure": "id,code,subject,extension,modifierExtension",
}


def _register_allowlist(name: str, kind: str) -> None:
    @register(
        f"SELECT id, subject, note_date, polarity, codings, CAST(NULL AS INTEGER) AS begin_pos, '{_KEPT[kind]}' AS kept"
        f" FROM ({_mention_sql(kind, fv.ALL_MENTION_TYPES)})", name)
    def build(w: Warehouse) -> DataFrame:
        """Mentions under the rules: codes, references, polarity and note date stay, text positions go."""
        kept = deidentify.project_allowed(w.mention(kind, symptom_only=False), kind, base=_BASE_RULES)
        coded = "medicationCodeableConcept" if kind == "MedicationStatement" else "code"
        position = next(f for f in kept.schema["extension"].dataType.elementType.fields if f.name == "extension")
        inner = position.dataType.elementType.fieldNames()
        begin = "extension[0].extension[0].valueInteger" if "valueInteger" in inner else "CAST(NULL AS INT)"
        return kept.selectExpr(
            "id", "subject.reference AS subject", "modifierExtension[0].extension[0].valueDate AS note_date",
            "modifierExtension[1].valueInteger AS polarity",
            f"array_join(transform({coded}.coding, c -> concat_ws('|', c.system, c.code, c.display)), ';') AS codings",
            f"{begin} AS begin_pos", f"'{','.join(kept.columns)}' AS kept",
        )


for _kind, _name in (("Observation", "observation"), ("Condition", "condition"),
                     ("MedicationStatement", "medication"), ("Procedure", "procedure")):
    _register_allowlist(f"allowlist_{_name}", _kind)


# --- facts -----------------------------------------------------------------------------


@register(q.query(f"SELECT {q.encounter('e')} AS encounter_id, {q.patient('p')} AS subject_id, d AS enct_date FROM enc"))
def encounter_dates(w: Warehouse) -> DataFrame:
    return facts.note_encounters(w.tables["documentreference"])


@register(q.query(
    "SELECT gender, CAST(CAST(birth AS VARCHAR) || '-01-01' AS DATE) AS dob, age, race, zip AS postalcode,"
    f" {q.patient('p')} AS subject_id FROM pat"
))
def patient_demographics(w: Warehouse) -> DataFrame:
    return facts.patient_demographics(w.tables["patient"], AS_OF)


@register(q.query(
    f"SELECT {q.patient('p')} AS subject_id, {q.encounter('e')} AS encounter_id, d AS enct_date,"
    " coalesce(r, 'Unknown') AS covid_lab_test FROM lab"
))
def lab_results(w: Warehouse) -> DataFrame:
    return facts.lab_results(w.tables["observation"], default="Unknown")


@register(q.query(
    f"SELECT {q.patient('p')} AS subject_id, {q.encounter('e')} AS encounter_id, d AS enct_date,"
    " r AS covid_classifier FROM cl"
))
def classifier_results(w: Warehouse) -> DataFrame:
    return facts.classifier_results(w.tables["observation"])


@register(q.query(
    f"SELECT {q.encounter('e')} AS encounter_id, {q.patient('p')} AS subject_id, d AS enct_date,"
    " 'dx U07.1' AS test_method, 'Unavailable' AS covid_result FROM dx"
))
def covid_diagnoses(w: Warehouse) -> DataFrame:
    return facts.diagnoses(w.tables["condition"])


@register(q.query(f"SELECT {q.encounter('e')} AS encounter_id, s AS symptoms FROM majority"))
def symptom_majority(w: Warehouse) -> DataFrame:
    return facts.symptom_majority(w.tables["observation"])


@register(q.query(
    f"SELECT {q.encounter()} AS encounter_id, {q.cases('cui', fv.SYMPTOMS_CUI)} AS symptoms FROM m1"
    f" WHERE rn = 1 AND cui IN ({q.listed(fv.SYMPTOMS_CUI)}) GROUP BY 1, 2"
    " HAVING sum(CASE polarity WHEN 0 THEN 1 WHEN -1 THEN -1 END) > 0"
))
def symptom_majority_cui(w: Warehouse) -> DataFrame:
    return facts.symptom_majority(w.tables["observation"], fv.SYMPTOMS_CUI, system=None)


@register(q.query(
    f"SELECT {q.encounter()} AS encounter_id, {q.cases('cui', fv.SYMPTOMS_CUI)} AS symptoms, min(substr(START_DATE, 1, 10)) AS first_date,"
    " max(substr(START_DATE, 1, 10)) AS last_date, count(*) AS mentions"
    f" FROM m1 WHERE rn = 1 AND cui IN ({q.listed(fv.SYMPTOMS_CUI)}) GROUP BY 1, 2"
))
def symptom_dates(w: Warehouse) -> DataFrame:
    return facts.symptom_dates(w.tables["observation"])


@register(q.query(
    f"SELECT {q.encounter()} AS encounter_id, {q.cases('snomed_code', fv.SYMPTOMS_B)} AS symptoms FROM m1"
    f" WHERE snomed_code IN ({q.listed(fv.SYMPTOMS_B)}) GROUP BY 1, 2"
    " HAVING sum(CASE polarity WHEN 0 THEN 1 WHEN -1 THEN -1 END) > 0"
))
def symptom_majority_all_mentions(w: Warehouse) -> DataFrame:
    """Majority over every mention instead of the first per concept."""
    every = mentions.mention_resources(w.annotated(), "Observation", SALT, ["row_id"], dedup=False)
    return facts.symptom_majority(annotate.to_stored(every, "Observation"))


@register(q.query(
    f"SELECT DISTINCT {q.patient()} AS subject_id, {q.encounter()} AS encounter_id, snomed_code AS symptom_code"
    f" FROM m1 WHERE rn = 1 AND polarity = 0 AND snomed_code IN ({q.listed(fv.SYMPTOMS_A)})"
))
def asserted_symptoms(w: Warehouse) -> DataFrame:
    return facts.asserted_symptoms(w.tables["observation"], fv.SYMPTOMS_A)


# Method and result by lab and classifier label; a side without a row is '-'.
_OUTCOMES = (
    "(VALUES ('Positive', '-', 'Lab_test', 'Positive'), ('Positive', 'Positive', 'Lab_test', 'Positive'),"
    " ('Positive', 'Negative', 'Lab_test', 'Positive'), ('Negative', '-', 'Lab_test', 'Negative'),"
    " ('Negative', 'Positive', 'Lab_test', 'Negative'), ('Negative', 'Negative', 'Lab_test', 'Negative'),"
    " ('Unknown', '-', 'Unknown', 'Unavailable'), ('Unknown', 'Positive', 'covid_classifier', 'Positive'),"
    " ('Unknown', 'Negative', 'covid_classifier', 'Negative'), ('-', 'Positive', 'Unknown', 'Unavailable'),"
    " ('-', 'Negative', 'Unknown', 'Unavailable')) o(lab_label, cls_label, m, r)"
)
_KEYS = (
    "(SELECT e, p FROM lab UNION SELECT e, p FROM cl1) k"
    " LEFT JOIN (SELECT e, p, d AS lab_day, coalesce(r, 'Unknown') AS lab_found FROM lab) USING (e, p)"
    " LEFT JOIN (SELECT e, p, d AS cls_day, r AS cls_found FROM cl1) USING (e, p)"
)
_JOINED = (
    "SELECT e, p, coalesce(lab_day, cls_day) AS d, m, o.r AS r FROM"
    f" (SELECT *, coalesce(lab_found, '-') AS lab_label, coalesce(cls_found, '-') AS cls_label FROM {_KEYS})"
    f" JOIN {_OUTCOMES} USING (lab_label, cls_label)"
)


@register(q.query(
    f"SELECT {q.encounter('e')} AS encounter_id, {q.patient('p')} AS subject_id, d AS enct_date,"
    f" m AS test_method, r AS covid_result FROM ({_JOINED})"
))
def lab_classifier_full_join(w: Warehouse) -> DataFrame:
    observation = w.tables["observation"]
    return reports.lab_classifier(
        facts.lab_results(observation, default="Unknown"), facts.classifier_results(observation, 1)
    )


@register(SQL["lab_classifier_full_join"])
def lab_classifier_bucketed(w: Warehouse) -> DataFrame:
    """The same join on fact tables stored in buckets of encounter and patient."""
    observation, keys = w.tables["observation"], ["encounter_id", "subject_id"]
    database = _database(w, "facts")
    lab = store_bucketed(facts.lab_results(observation, default="Unknown"), f"{database}.lab", keys, 16)
    classifier = store_bucketed(facts.classifier_results(observation, 1), f"{database}.classifier", keys, 16)
    return reports.lab_classifier(lab, classifier)


def _database(w: Warehouse, name: str) -> str:
    """A database of its own for each application and data folder."""
    return f"{name}_{hashlib.md5(w.folder.encode()).hexdigest()[:12]}"


@register(q.query(
    "SELECT nullif(split_part(CONCEPT_CD, ':', 2), '') AS code, gender, count(*) AS conditions, count(DISTINCT PATIENT_NUM) AS patients"
    " FROM cond JOIN (SELECT p AS PATIENT_NUM, gender FROM pat) USING (PATIENT_NUM) GROUP BY ALL"
))
def code_report_sql(w: Warehouse) -> DataFrame:
    """A report in SQL over the stored tables by their qualified names in the catalog."""
    database = _database(w, "clinic")
    w.tables  # stored
    register_store(w.spark, w.folder, database)
    return w.spark.sql(
        "SELECT c.code.coding[0].code AS code, p.gender, count(*) AS conditions, count(DISTINCT p.id) AS patients"
        f" FROM {database}.condition c JOIN {database}.patient p ON c.subject.reference = concat('Patient/', p.id)"
        " GROUP BY ALL")


# --- reports ---------------------------------------------------------------------------

YEAR = 1997
_D6 = "enct_date, test_method, covid_result, gender, age_group, race"
_S6 = "enct_date, symptoms, gender, age_group, race, covid_diagnosis"
_S8 = _S6 + ", covid_lab_test, covid_classifier"


def _result_cube_sql(dx_keys: str) -> str:
    combine = (
        "SELECT DISTINCT j.e, CAST(date_trunc('week', CAST(d AS DATE)) AS DATE) AS enct_date,"
        " m AS test_method, r AS covid_result, coalesce(gender, 'Unavailable') AS gender,"
        f" {q.age_band('?')} AS age_group, coalesce(race, 'Unavailable') AS race"
        f" FROM (SELECT e, p, d, m, r FROM ({_JOINED}) UNION ALL"
        f" SELECT {dx_keys}, d, 'dx U07.1', 'Unavailable' FROM dx) j LEFT JOIN pat ON j.p = pat.p"
    )
    return q.query(
        f"SELECT {_D6}, count(DISTINCT e) AS cnt FROM combine WHERE year(enct_date) = {YEAR}"
        f" GROUP BY CUBE({_D6})", combine=combine,
    )


@register(_result_cube_sql("e, p"))
def covid_result_cube(w: Warehouse) -> DataFrame:
    return reports.covid_result_cube(w.tables, AS_OF, YEAR)


@register(_result_cube_sql(
    f"CASE WHEN true THEN 'x' || {q.patient('p')} END, {q.encounter('e')}"
))
def covid_result_cube_positional(w: Warehouse) -> DataFrame:
    """The union by position: diagnosis rows count patients and match no profile."""
    return reports.covid_result_cube(w.tables, AS_OF, YEAR, positional_union=True)


_V6 = q.symptom_cube(
    q.asserted(fv.SYMPTOMS_A, fv.SYMPTOMS_A), fv.OTHER_SYMPTOMS, "presumably positive", "Negative",
    "", "cl1", "", f"year(enct_date) = {YEAR}", _S6, "e",
)


@register(q.query("SELECT * FROM cube_rows", **_V6))
def symptom_cube_v6(w: Warehouse) -> DataFrame:
    return reports.symptom_cube_v6(w.tables, AS_OF, YEAR)


@register(q.query("SELECT * FROM cube_rows", **q.symptom_cube(
    q.asserted(fv.SYMPTOMS_A, fv.SYMPTOMS_B), fv.OTHER_SYMPTOMS, "Positive", "No covid diagnosis",
    "", "cl1", "", "year(enct_date) BETWEEN 1996 AND 2001", _S8, "p",
)))
def symptom_cube_v7(w: Warehouse) -> DataFrame:
    return reports.symptom_cube_v7(w.tables, AS_OF, 1996, 2001)


_RECENT = f"year(enct_date) >= 1996 AND enct_date <= DATE '{AS_OF}'"


@register(q.query("SELECT * FROM cube_rows", **q.symptom_cube(
    q.asserted(fv.SYMPTOMS_B, fv.SYMPTOMS_B), fv.OTHER_SYMPTOMS, "DX Positive", "No covid diagnosis",
    "PCR ", "cl1", "NLP ", _RECENT, _S8, "p",
)))
def symptom_cube_v72(w: Warehouse) -> DataFrame:
    return reports.symptom_cube_v72(w.tables, AS_OF, 1996)


_V81 = q.symptom_cube(
    "SELECT * FROM majority", fv.NO_SYMPTOMS, "DX Positive", "No covid diagnosis",
    "PCR ", "cl", "", _RECENT, _S8, "p",
)


@register(q.query("SELECT * FROM cube_rows", **_V81))
def symptom_cube_v81(w: Warehouse) -> DataFrame:
    return reports.symptom_cube_v81(w.tables, AS_OF, 1996)


_DELAYS = {
    "pairs": (
        "SELECT DISTINCT enc.e, date_diff('day', CAST(enc.d AS DATE), CAST(dx.d AS DATE)) AS x,"
        " date_diff('day', CAST(enc.d AS DATE), CAST(lab.d AS DATE)) AS l"
        " FROM enc LEFT JOIN dx ON enc.e = dx.e LEFT JOIN lab ON enc.e = lab.e"
        " WHERE dx.d IS NOT NULL OR lab.d IS NOT NULL"
    ),
    "delays": (
        f"SELECT {q.encounter('e')} AS encounter_id, CAST(min(x) AS INTEGER) AS min_dx_delay,"
        " CAST(max(x) AS INTEGER) AS max_dx_delay, CAST(max(x) - min(x) AS INTEGER) AS multi_dx_gap,"
        " CAST(min(l) AS INTEGER) AS min_lab_delay, CAST(max(l) AS INTEGER) AS max_lab_delay,"
        " CAST(max(l) - min(l) AS INTEGER) AS multi_lab_gap FROM pairs GROUP BY e"
    ),
}


@register(q.query("SELECT * FROM delays", **_DELAYS))
def encounter_delays(w: Warehouse) -> DataFrame:
    return reports.encounter_delays(w.tables)


@register(q.query(
    "SELECT min_lab_delay, count(DISTINCT encounter_id) AS cnt FROM delays GROUP BY min_lab_delay"
    " ORDER BY min_lab_delay NULLS LAST", **_DELAYS,
))
def lab_delay_histogram(w: Warehouse) -> DataFrame:
    return reports.lab_delay_histogram(w.tables)


@register(q.query(
    "SELECT STATE_CD AS state FROM patient_dimension WHERE PATIENT_NUM IN (SELECT PATIENT_NUM FROM cohort_p)"
))
def patient_states(w: Warehouse) -> DataFrame:
    return reports.patient_states(w.tables["patient"])


@register(q.query(
    "SELECT split_part(CONCEPT_CD, ':', 2) AS code, count(*) AS n FROM diagnosis WHERE CONCEPT_CD LIKE '%:%' GROUP BY 1"
))
def code_frequency(w: Warehouse) -> DataFrame:
    return value_counts(w.extract("diagnosis"), F.get(F.split("CONCEPT_CD", ":", 2), F.lit(1)), "code")


@register(q.query(
    "SELECT row_id, cui, polarity FROM nlp_mention ORDER BY row_id LIMIT 100"
))
def row_cap(w: Warehouse) -> DataFrame:
    """Row cap of the mappers: the first rows in source order."""
    return cap_rows(w.extract("nlp_mention"), 100, ["row_id"]).select("row_id", "cui", "polarity")


@register(q.query(
    f"SELECT {q.uuid('Observation', q.row_key(*resources.LAB_VALUES))} AS id FROM lab_cohort"
    f" WHERE CONCEPT_CD <> 'LAB:0' AND {q.IN_COHORT}"
    f" ORDER BY {', '.join(f'{c} NULLS FIRST' for c in resources.LAB_VALUES)} LIMIT 100"
))
def mapper_row_cap(w: Warehouse) -> DataFrame:
    """The first mapped resources in the order of the source files."""
    folder = shared_folder(w.spark)
    ordered = w.extract("lab_cohort").repartitionByRange(*resources.LAB_VALUES).sortWithinPartitions(*resources.LAB_VALUES)
    extracts.write_csv(ordered.select(*resources.LAB_VALUES), folder)
    rows = extracts.read_extract(w.spark, folder, resources.LAB_VALUES, position=True, splittable=True)
    return resources.map_lab_observation(rows, w.patients, w.encounters, SALT, resources.LAB_VALUES, limit=100).select("id")


# --- snapshots -------------------------------------------------------------------------


def _day(n: int) -> dt.datetime:
    return dt.datetime(2022, 5, n, tzinfo=dt.timezone.utc)


def _snapshots(w: Warehouse, balanced: bool = False) -> str:
    """Three commits of the condition table: all, one code, all but that code."""
    path = shared_folder(w.spark)
    rows = w.tables["condition"].selectExpr("id", "code.coding[0].code AS code", "onsetDateTime AS onset")
    for n, part in enumerate((rows, rows.where("code = 'U07.1'"), rows.where("code <> 'U07.1'"))):
        snapshots.write_snapshot(part, path, _day(10 + 5 * n), balanced)
    return path


_SNAP = (
    f"SELECT {q.uuid('Condition', q.row_key('ENCOUNTER_NUM', 'CONCEPT_CD'))} AS id,"
    " nullif(split_part(CONCEPT_CD, ':', 2), '') AS code, substr(START_DATE, 1, 10) AS onset FROM cond"
)


@register(q.query(_SNAP))
def snapshot_restore_version(w: Warehouse) -> DataFrame:
    path = _snapshots(w)
    snapshots.restore_version(w.spark, path, 0, _day(26))
    return snapshots.read_snapshot(w.spark, path)


@register(q.query(_SNAP + " WHERE CONCEPT_CD = 'ICD10:U07.1'"))
def snapshot_restore_timestamp(w: Warehouse) -> DataFrame:
    path = _snapshots(w)
    snapshots.restore_timestamp(w.spark, path, "2022-05-17", _day(26))
    return snapshots.read_snapshot(w.spark, path)


@register(q.query(
    "SELECT CAST(v AS BIGINT) AS version, o AS operation, CAST(s AS BIGINT) AS source_version,"
    " CASE s WHEN 0 THEN a ELSE CASE s WHEN 1 THEN u ELSE a - u - plain END END AS rows FROM"
    " (SELECT count(*) AS a, count(*) FILTER (WHERE CONCEPT_CD = 'ICD10:U07.1') AS u,"
    " count(*) FILTER (WHERE CONCEPT_CD NOT LIKE '%:%') AS plain FROM cond),"
    " (VALUES (0, 'write', 0), (1, 'write', 1), (2, 'write', 2), (3, 'restore', 0)) t(v, o, s)"
))
def snapshot_history(w: Warehouse) -> DataFrame:
    path = _snapshots(w)
    snapshots.restore_version(w.spark, path, 0, _day(26))
    return snapshots.snapshot_history(w.spark, path).select(
        "version", "operation", "source_version", "rows"
    )


@register(q.query(
    "SELECT CAST(1 AS BIGINT) AS files, 'version=2' AS folder, count(*) AS rows FROM cond"
    " WHERE CONCEPT_CD LIKE '%:%' AND CONCEPT_CD <> 'ICD10:U07.1'"
))
def manifest(w: Warehouse) -> DataFrame:
    """The manifest of the newest version as a text file, and the rows of the files it lists."""
    path = _snapshots(w, balanced=True)
    target = shared_folder(w.spark)
    snapshots.write_manifest(w.spark, path, target)
    listed = w.spark.read.text(target).selectExpr("value AS file", "regexp_extract(value, '/(version=[0-9]+)/', 1) AS folder")
    rows = w.spark.read.parquet(*[r["file"] for r in listed.collect()]).agg(F.count(F.lit(1)).alias("rows"))
    kinds = listed.groupBy("folder").agg(F.count(F.lit(1)).alias("files"))
    return kinds.withColumn("one", F.lit(1)).join(rows.withColumn("one", F.lit(1)), "one").select("files", "folder", "rows")


# --- sharing ---------------------------------------------------------------------------


@register(q.query("SELECT * FROM cube_rows", **_V6))
def cube_stream_load(w: Warehouse) -> DataFrame:
    """A cube dropped as CSV files and loaded by the stream; a second run loads what was written again."""
    root = shared_folder(w.spark)
    schema = cube_schema({"enct_date": "date", **{d: "string" for d in reports.SYMPTOM_DIMS_6[1:]}})
    cube = reports.symptom_cube_v6(w.tables, AS_OF, YEAR).select(*schema.fieldNames())
    half = F.coalesce(F.col("gender") == "female", F.lit(False))
    extracts.write_csv(cube.where(~half), f"{root}/drop/others", balanced=True)
    head = w.spark.createDataFrame([(0, ",".join(schema.fieldNames()))], "pos int, line string")
    for women in (cube.where(half).withColumn("cnt", F.col("cnt") + 1), cube.where(half)):
        lines = head.unionByName(women.select(F.lit(1).alias("pos"), F.to_csv(F.struct(*schema.fieldNames())).alias("line")))
        named = lines.withColumn("file", F.lit("women")).repartition("file").sortWithinPartitions("pos")
        write_named(named.select("file", "line"), "file", ".csv", f"{root}/drop")
        load_arriving_cubes(w.spark, f"{root}/drop", f"{root}/loaded", f"{root}/log", schema).awaitTermination()
    return read_loaded_cubes(w.spark, f"{root}/loaded", schema).select(*schema.fieldNames())


_DIMS8 = _S8.split(", ")


@register(q.query(" UNION ALL ".join(
    f"SELECT 'symptoms' AS cube, '{d}' AS dim, count(DISTINCT {d}) AS levels, count({d}) AS rows FROM cube_rows"
    for d in _DIMS8
), **_V81), name="cube_meta")
def _cube_meta(w: Warehouse) -> DataFrame:
    return cube_meta(read_cube(w.spark, w.cube_folder), _DIMS8, "symptoms")


@register(q.query(" UNION ALL ".join(
    f"SELECT DISTINCT 'symptoms' AS cube, '{d}' AS dim, CAST({d} AS VARCHAR) AS level FROM cube_rows"
    f" WHERE {d} IS NOT NULL" for d in _DIMS8
), **_V81), name="cube_levels")
def _cube_levels(w: Warehouse) -> DataFrame:
    return cube_levels(read_cube(w.spark, w.cube_folder), _DIMS8, "symptoms")


@register(q.query(
    "SELECT symptoms, age_group, gender, count(DISTINCT p) AS cnt FROM combine"
    f" WHERE {_RECENT} AND gender = 'female' GROUP BY ALL", **_V81,
), name="cube_slice")
def _cube_slice(w: Warehouse) -> DataFrame:
    cube = read_cube(w.spark, w.cube_folder)
    return slice_stored(cube, _DIMS8, ["symptoms", "age_group"], {"gender": "female"})
