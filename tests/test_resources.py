import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions import fixed_values as fv
from cohortloom.operators import annotate, deidentify, mentions, resources
from cohortloom.sources import ndjson

SALT = "t"


@pytest.fixture(scope="module")
def maps(spark):
    make = lambda rows: spark.createDataFrame(rows, "source_id string, uuid string")
    return make([("1", "pu1"), ("2", "pu2")]), make([("10", "eu10"), ("20", "eu20")])


def bare(kind):
    """A type without metadata and nullability."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, bare(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(bare(kind.elementType))
    return kind


def test_patient_quirks(spark, maps):
    df = spark.createDataFrame(
        [("1", None, None, "1950-06-15 00:00", "02115"), ("3", "White", "F", "1990-01-01", "1")],
        "PATIENT_NUM string, RACE_CD string, SEX_CD string, BIRTH_DATE string, ZIP_CD string")
    out = resources.map_patient(df, maps[0])
    row = out.collect()
    assert len(row) == 1
    row = row[0]
    assert (row.id, row.gender, row.birthDate) == ("pu1", "unknown", "1950")
    assert row.extension[0].extension[0].valueCoding.code is None
    assert bare(out.schema) == bare(schemas.RESOURCES["Patient"])
    assert bare(annotate.to_stored(out, "Patient").schema) == bare(schemas.stored("Patient"))


def diagnosis(spark, rows):
    return spark.createDataFrame(
        rows, "PATIENT_NUM string, ENCOUNTER_NUM string, CONCEPT_CD string, START_DATE string, n int")


def test_condition_keeps_first_cohort_row_per_encounter_and_code(spark, maps):
    rows = [
        ("3", "10", "ICD10:A", "2020-01-01", 0),   # patient outside the cohort comes first
        ("2", "10", "ICD10:A", "2020-01-02", 1),
        ("1", "10", "ICD10:A", "2020-01-03", 2),
        ("1", "10", "ICD10:B", "2020-01-04", 3),
        ("1", "99", "ICD10:A", "2020-01-05", 4),   # encounter outside the cohort
        ("1", "20", "plain", "2020-01-06", 5),
    ]
    df = resources.map_condition(diagnosis(spark, rows), *maps, SALT, ["n"])
    got = sorted((r.encounter.reference, r.code.coding[0].code, r.subject.reference, r.onsetDateTime)
                 for r in df.where("code.coding[0].code IS NOT NULL").collect())
    assert got == [("Encounter/eu10", "A", "Patient/pu2", "2020-01-02"),
                   ("Encounter/eu10", "B", "Patient/pu1", "2020-01-04")]
    assert df.count() == 3
    shuffled = resources.map_condition(diagnosis(spark, rows[::-1]).repartition(4), *maps, SALT, ["n"])
    key = lambda d: sorted(r.id for r in d.collect())
    assert key(df) == key(shuffled)
    assert bare(df.schema) == bare(schemas.RESOURCES["Condition"])


def test_lab_has_no_modifier_extension(spark, maps):
    df = spark.createDataFrame(
        [("1", "10", "LAB:1043473617", "2020-01-01 10:00", None), ("1", "10", "LAB:0", "2020-01-01", "Positive")],
        "PATIENT_NUM string, ENCOUNTER_NUM string, CONCEPT_CD string, START_DATE string, TVAL_CHAR string")
    out = resources.map_lab_observation(df, *maps, SALT)
    row = out.collect()
    assert len(row) == 1 and row[0].modifierExtension is None
    assert row[0].valueCodeableConcept.coding[0].code == fv.INCONCLUSIVE_CODE
    stored = annotate.to_stored(out, "Observation").first()
    assert stored.modifierExtension is None and stored.subject.reference_id_aa == "pu1"


def test_encounter_outside_the_map_gets_a_stable_id(spark, maps):
    df = spark.createDataFrame(
        [("1", "10", "Inpatient", "s", "e"), ("1", "77", None, "s", "e"), ("9", "10", None, "s", "e")],
        "PATIENT_NUM string, ENCOUNTER_NUM string, INOUT_CD string, START_DATE string, END_DATE string")
    rows = {r.identifier[0].value: r for r in resources.map_encounter(df, *maps, SALT).collect()}
    assert rows["10"].id == "eu10" and rows["10"]["class"].code == "IMP"
    assert len(rows["77"].id) == 36 and rows["77"]["class"].code == "EMER"
    assert len(rows) == 2


def test_classifier_versions(spark, maps):
    notes = spark.createDataFrame(
        [("1", "10", "2020-01-02", 1), ("1", "10", "2020-01-01", 0), ("2", "20", "2020-02-01", 2)],
        "PATIENT_NUM string, ENCOUNTER_NUM string, START_DATE string, n int")
    results = spark.createDataFrame(
        [("10", "positive", 0), ("10", "Negative", 1), ("20", "Not classified", 2), ("30", "Positive", 3)],
        "ENCOUNTER_NUM string, PREDICTION string, n int")
    first = resources.first_predictions(results, ["n"])
    new = resources.map_classifier(notes, first, *maps, SALT, ["n"]).collect()
    old = resources.map_classifier(notes, first, *maps, SALT, ["n"], fv.CLASSIFIER_V1).collect()
    assert len(new) == len(old) == 1
    assert new[0].effectiveDateTime == "2020-01-01"
    assert new[0].valueCodeableConcept.coding[0].code == fv.POSITIVE_CODE
    assert old[0].valueCodeableConcept.coding[0].code == fv.NEGATIVE_CODE
    assert (old[0].modifierExtension[0].valueInteger, new[0].modifierExtension[0].valueInteger) == (1, None)


def concept(cui, code="1", scheme="SNOMEDCT_US"):
    return {"code": code, "cui": cui, "tui": "T9", "codingScheme": scheme}


def mention(text, cui, polarity=0, **more):
    attributes = [concept(cui), concept(cui, "2", "RXNORM"), concept(cui, "3", "OTHER")]
    return {"begin": 1, "end": 4, "text": text, "polarity": polarity, "conceptAttributes": attributes, **more}


@pytest.fixture(scope="module")
def annotated(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "x.ndjson"
    records = [
        {"SignSymptomMention": [mention("cough", "C1", -1), mention("cough again", "C1", 0), mention("ache", "C2")],
         "MedicationMention": [mention("drug", "C3"), mention("cough drug", "C1")],
         "Unlisted": [mention("x", "C4")]},
        {},
        {"ProcedureMention": [mention("scan", "C1"), mention("none", "C9", conceptAttributes=[]),
                              mention("null", "C9", conceptAttributes=None)],
         "DiseaseDisorderMention": [mention("flu", "C5")], "IdentifiedAnnotation": []},
    ]
    path.write_text("\n".join(json.dumps({
        "PATIENT_NUM": "pu1", "ENCOUNTER_NUM": f"eu{i}", "START_DATE": "2021-05-06 07:08", "OBSERVATION_BLOB": r,
    }) for i, r in enumerate(records)))
    return ndjson.read_ndjson(spark, str(path), schemas.ANNOTATED_NOTE)[0]


def test_only_listed_types_and_first_mention_per_concept(annotated):
    order = ["src_file", "src_block", "src_row"]
    default = mentions.mention_resources(annotated, "Observation", SALT, order)
    rows = sorted((r.code.coding[0].display, r.modifierExtension[1].valueInteger) for r in default.collect())
    assert rows == [("ache", 0), ("cough", -1)]
    assert bare(default.schema) == bare(schemas.RESOURCES["Observation"])
    everything = mentions.mention_resources(annotated, "Observation", SALT, order, dedup=False)
    assert everything.count() == 3
    assert everything.select("id").distinct().count() == 3
    drugs = mentions.mention_resources(annotated, "MedicationStatement", SALT, order, fv.ALL_MENTION_TYPES)
    assert [r.medicationCodeableConcept.coding[0].display for r in drugs.collect()] == ["drug"]
    assert bare(drugs.schema) == bare(schemas.RESOURCES["MedicationStatement"])


def test_codes_of_a_mention(annotated):
    row = mentions.mention_resources(annotated, "Condition", SALT, [], fv.ALL_MENTION_TYPES).first()
    assert [(c.system, c.code, c.display) for c in row.code.coding] == [
        (fv.SNOMED, "1", "flu"), (fv.RXNORM, "2", "flu"), ("OTHER", "3", "flu"),
        (fv.CUI_SYSTEM, "C5", "cui"), (fv.TUI_SYSTEM, "T9", "tui")]
    assert row.category[0].text is None and row.modifierExtension[0].extension[0].valueDate == "2021-05-06"


def test_mentions_without_codes_are_rejects(annotated):
    usable, rejects = mentions.usable_mentions(mentions.explode_mentions(annotated, fv.ALL_MENTION_TYPES))
    assert sorted(r.mention.text for r in rejects.collect()) == ["none", "null"]
    assert usable.count() == 7


def test_mention_lines_hold_the_resource_without_nulls(annotated):
    usable, _ = mentions.usable_mentions(mentions.explode_mentions(annotated, fv.ALL_MENTION_TYPES))
    lines = mentions.mention_lines(usable, SALT).collect()
    assert {r.resourceType for r in lines} == {"Observation", "MedicationStatement", "Procedure", "Condition"}
    for line in lines:
        body = json.loads(line.value)
        assert body["resourceType"] == line.resourceType
        assert ("encounter" in body) == (line.resourceType == "Observation")


def test_annotate_notes_keeps_rejects_apart(spark, maps):
    notes = spark.createDataFrame(
        [(1, "1", "10", "d", "t"), (2, "9", "10", "d", "t"), (3, "2", "20", "d", "t")],
        "k int, PATIENT_NUM string, ENCOUNTER_NUM string, START_DATE string, OBSERVATION_BLOB string")
    blobs = spark.createDataFrame([(1,)], "k int").withColumn(
        "OBSERVATION_BLOB", F.expr(f"CAST(map('SignSymptomMention', array()) AS {schemas.ANNOTATIONS.simpleString()})"))
    annotated, rejects = mentions.annotate_notes(notes, blobs, "k", *maps)
    assert {r.k: (r.PATIENT_NUM, r.ENCOUNTER_NUM, len(r.OBSERVATION_BLOB)) for r in annotated.collect()} == {
        1: ("pu1", "eu10", 1), 3: ("pu2", "eu20", 0)}
    assert [r.k for r in rejects.collect()] == [2]


@pytest.mark.parametrize("raw,start,end", [
    ("2020", "2020-01-01", "2020-12-31"), ("2020-02", "2020-02-01", "2020-02-29"),
    ("2020-02-05T10:00:00Z", "2020-02-05", "2020-02-05"), ("bad", None, None), (None, None, None),
])
def test_date_range(spark, raw, start, end):
    row = spark.createDataFrame([(raw,)], "d string").selectExpr(f"{annotate.date_range('d')} AS r").first().r
    assert (row.start, row.end) == (start, end)


def test_flatten_extensions(spark, tmp_path):
    path = tmp_path / "p.ndjson"
    ext = [{"url": "race", "extension": [{"url": "omb", "valueString": "a"}, {"url": "detail", "valueCode": "b"}]},
           {"url": "sex", "valueCode": "F"}, {"url": "empty"},
           {"url": "both", "valueString": "v", "extension": [{"url": "in", "valueInteger": 3}]}]
    path.write_text("\n".join([json.dumps({"id": "1", "extension": ext}), json.dumps({"id": "2"})]))
    rows, _ = ndjson.read_ndjson(spark, str(path), schemas.RESOURCES["Patient"])
    flat = {r.id: r.extension for r in annotate.to_stored(rows, "Patient").collect()}
    assert [(e.url, e.parent) for e in flat["1"]] == [
        ("omb", "race"), ("detail", "race"), ("sex", None), ("both", None), ("in", "both")]
    assert flat["2"] is None


@pytest.mark.parametrize("path,trimmed", [
    ("Patient.extension.extension.url", "Patient.extension.url"),
    ("A.modifierExtension.extension.extension.b.extension", "A.modifierExtension.b.extension"),
    ("plain", "plain"),
])
def test_trim_extension_path(value, path, trimmed):
    assert value(annotate.trim_extension_path(f"'{path}'")) == trimmed


def test_stored_schema_of_every_resource(spark):
    for name, schema in schemas.RESOURCES.items():
        empty = spark.createDataFrame([], schema)
        assert bare(annotate.to_stored(empty, name).schema) == bare(schemas.stored(name)), name


def test_allow_list(spark):
    rules = deidentify.default_rules()
    assert len(rules) == 60 and deidentify.unmatched_rules(rules) == []
    for wrong in ("Patient.gendre", "nodesByType('Codeing').display", "nodesByType('Coding').displayed", "Unknown.id"):
        assert deidentify.unmatched_rules([(wrong, "keep", "x")]) == [(wrong, "keep", "x")]
        with pytest.raises(ValueError, match="without a field"):
            deidentify.project_allowed(spark.createDataFrame([], schemas.RESOURCES["Patient"]), "Patient", [(wrong, "keep", "x")])
    base = [("Patient.gender", "keep", "x"), ("Patient.id", "drop", "x")]
    assert deidentify.project_allowed(spark.createDataFrame([], schemas.RESOURCES["Patient"]), "Patient", [("Patient.id", "keep", "y")], base).columns == ["id", "gender"]
    kept = deidentify.kept_leaves("Patient", rules)
    assert "id" in kept and "birthDate" in kept and "gender" not in kept
    assert "extension.extension.valueCoding.code" in kept and "address.postalCode" not in kept
    obs = deidentify.kept_leaves("Observation", rules)
    assert "subject.reference" in obs and "encounter.reference" in obs and "code.coding.display" in obs
    assert "code.coding.code" not in obs and "effectiveDateTime" in obs
    doc = deidentify.kept_leaves("DocumentReference", rules)
    assert "content.attachment.data" not in doc and "date" in doc
    for name, schema in schemas.RESOURCES.items():
        out = deidentify.project_allowed(spark.createDataFrame([], schema), name, rules)
        assert out.columns
    assert deidentify.rules_frame(spark, rules).count() == len(rules)


def test_rules_from_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text("path,method,usecase\nPatient.gender,keep,x\nPatient.id,drop,y\n")
    rules = deidentify.load_rules(spark, str(tmp_path / "r.csv"))
    assert deidentify.kept_leaves("Patient", rules) == ["gender"]
