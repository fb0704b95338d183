"""Mappers from warehouse extracts to clinical resources.

Each mapper is one projection after the cohort joins. ``patients`` and ``encounters`` are
id maps (source_id, uuid). ``row_key`` names the columns that identify a source row; ids
derive from it, so a rerun yields the same ids. ``limit`` keeps a mapper's first outputs in
the order of the source files; its rows then carry their position (``positions.POSITION``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import codes, scalars
from cohortloom.functions import fixed_values as fv
from cohortloom.functions import nested as n
from cohortloom.functions.codes import text
from cohortloom.operators.dedup import cap_in_source_order, first_per_key, number_equal_rows
from cohortloom.sources.idmaps import ANY_ID, attach

PATIENT, ENCOUNTER = "PATIENT_NUM", "ENCOUNTER_NUM"
LAB_VALUES = [PATIENT, ENCOUNTER, "CONCEPT_CD", "START_DATE", "TVAL_CHAR"]
SUBJECT_REF = n.reference(scalars.reference_to("Patient", "patient_uuid"))
ENCOUNTER_REF = n.reference(scalars.reference_to("Encounter", "encounter_uuid"))


def in_cohort(df: DataFrame, patients: DataFrame) -> DataFrame:
    """Rows whose patient is in the cohort."""
    keys = patients.where(ANY_ID).select(F.col("source_id").alias(PATIENT))
    return df.join(keys, PATIENT, "left_semi")


def with_ids(df: DataFrame, patients: DataFrame, encounters: DataFrame) -> DataFrame:
    """Rows whose patient and encounter are in the cohort, with both ids."""
    return attach(attach(df, patients, PATIENT, "patient_uuid"), encounters, ENCOUNTER, "encounter_uuid")


def _profile(url: str) -> str:
    return f"named_struct('profile', array({text(url)}))"


def map_patient(
    df: DataFrame, patients: DataFrame, identifier_system: str = "hospital patient number", limit: int = 0
) -> DataFrame:
    race = n.inner_extension("ombCategory", valueCoding=n.coding(
        text(fv.OMB_RACE_SYSTEM), codes.race_code("RACE_CD"), "RACE_CD"
    ))
    identifier = {"system": text(identifier_system), "value": PATIENT}
    address = {"postalCode": "ZIP_CD", "country": "'US'"}
    if "STATE_CD" in df.columns:
        address["state"] = "STATE_CD"
    return n.as_resource(cap_in_source_order(attach(df, patients, PATIENT, "patient_uuid"), limit), "Patient", {
        "id": "patient_uuid",
        "meta": _profile(fv.PATIENT_PROFILE),
        "extension": n.array(n.extension(fv.RACE_EXTENSION, race)),
        "identifier": n.array(n.field_struct("Patient", "identifier", identifier)),
        "gender": codes.gender("SEX_CD"),
        "birthDate": "substring(BIRTH_DATE, 1, 4)",
        "address": n.array(n.field_struct("Patient", "address", address)),
    })


def map_condition(
    df: DataFrame,
    patients: DataFrame,
    encounters: DataFrame,
    salt: str,
    order: Sequence[str] = ("START_DATE",),
    limit: int = 0,
) -> DataFrame:
    """One Condition per encounter and concept: the first cohort row in ``order``."""
    rows = first_per_key(
        with_ids(df, patients, encounters), [ENCOUNTER, "CONCEPT_CD"], [*order, PATIENT]
    )
    return n.as_resource(cap_in_source_order(rows, limit), "Condition", {
        "id": scalars.pseudonym("Condition", scalars.row_key([ENCOUNTER, "CONCEPT_CD"]), salt),
        "meta": _profile(fv.CONDITION_PROFILE),
        "clinicalStatus": n.concept(n.fixed_coding(fv.CONDITION_CLINICAL, "active")),
        "verificationStatus": n.concept(n.fixed_coding(fv.CONDITION_VERIFICATION, "unconfirmed")),
        "category": n.array(n.concept(
            n.fixed_coding(fv.CONDITION_CATEGORY, "encounter-diagnosis", "Encounter Diagnosis")
        )),
        "code": n.coded(n.array(n.coding(
            codes.diagnosis_system("CONCEPT_CD"), codes.diagnosis_code("CONCEPT_CD")
        ))),
        "subject": SUBJECT_REF,
        "encounter": ENCOUNTER_REF,
        "onsetDateTime": scalars.day("START_DATE"),
    })


def map_lab_observation(
    df: DataFrame,
    patients: DataFrame,
    encounters: DataFrame,
    salt: str,
    row_key: Sequence[str] | None = None,
    case_sensitive: bool = False,
    limit: int = 0,
) -> DataFrame:
    """Observations of the listed lab codes. ``modifierExtension`` stays NULL.

    Without a ``row_key``, such as the source position, a row is known by its values and
    by its number among rows of the same values; such rows have no position, so a ``limit``
    needs a key.
    """
    listed = df.where(codes.one_of("CONCEPT_CD", fv.LAB_TO_LOINC))
    if row_key is None:
        if limit:
            raise ValueError("a limit needs a row key")
        listed = number_equal_rows(listed.select(*LAB_VALUES))
        row_key = [*LAB_VALUES, "occurrence"]
    rows = cap_in_source_order(with_ids(listed, patients, encounters), limit)
    return n.as_resource(rows, "Observation", {
        "id": scalars.pseudonym("Observation", scalars.row_key(row_key), salt),
        "status": "'final'",
        "category": n.array(n.concept(
            n.fixed_coding(fv.OBSERVATION_CATEGORY, "laboratory", "laboratory")
        )),
        "code": n.coded(n.array(n.coding(text(fv.LOINC), codes.lab_loinc("CONCEPT_CD")))),
        "subject": SUBJECT_REF,
        "encounter": ENCOUNTER_REF,
        "effectiveDateTime": scalars.day("START_DATE"),
        "valueCodeableConcept": n.concept(n.coding(
            text(fv.SNOMED), codes.result_code("TVAL_CHAR", case_sensitive), "TVAL_CHAR"
        )),
    })


def with_own_ids(df: DataFrame, salt: str) -> DataFrame:
    """The rows of the cohort that the id maps were made from, with both ids computed in place.

    Ids are digests of the natural keys, so the cohort's own rows need no join; rows without
    a key are in no map.
    """
    return df.where(f"{PATIENT} IS NOT NULL AND {ENCOUNTER} IS NOT NULL").selectExpr(
        "*", f"{scalars.pseudonym('Patient', PATIENT, salt)} AS patient_uuid",
        f"{scalars.pseudonym('Encounter', ENCOUNTER, salt)} AS encounter_uuid",
    )


def with_ids_by_pair(df: DataFrame, patients: DataFrame, encounters: DataFrame) -> DataFrame:
    """As ``with_ids`` for rows with large columns: keys meet the maps first, rows move once."""
    pairs = with_ids(df.select(PATIENT, ENCOUNTER).distinct(), patients, encounters)
    return df.join(pairs, [PATIENT, ENCOUNTER])


def map_document_reference(
    df: DataFrame,
    salt: str,
    row_key: Sequence[str],
    maps: tuple[DataFrame, DataFrame] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Notes as documents. ``row_key`` names the columns that identify a note, ``keep`` those
    that stay beside the resource.

    ``maps`` are the patient and encounter maps, if they weren't made from these very notes.
    Without them no row is exchanged.
    """
    rows = with_ids_by_pair(df, *maps) if maps else with_own_ids(df, salt)
    attachment = (
        "named_struct('contentType', 'text/plain', 'data', "
        f"{scalars.encode_note('OBSERVATION_BLOB')}, 'url', NULL)"
    )
    return n.as_resource(rows, "DocumentReference", {
        "id": scalars.pseudonym("DocumentReference", scalars.row_key(row_key), salt),
        "status": "'superseded'",
        "category": n.array(n.concept(
            n.fixed_coding(fv.DOCUMENT_CATEGORY, "clinical-note", "Clinical Note")
        )),
        "subject": SUBJECT_REF,
        "type": "named_struct('coding', NULL, 'text', CONCEPT_CD)",
        "date": f"concat({scalars.day('START_DATE')}, 'T00:00:00Z')",
        "content": n.array(f"named_struct('attachment', {attachment})"),
        "context": f"named_struct('encounter', {n.array(ENCOUNTER_REF)})",
    }, keep)


def map_encounter(
    df: DataFrame,
    patients: DataFrame,
    encounters: DataFrame,
    salt: str,
    identifier_system: str = "hospital visit number",
) -> DataFrame:
    """Encounters of cohort patients; one outside the encounter map gets a derived id."""
    rows = attach(
        attach(df, patients, PATIENT, "patient_uuid"), encounters, ENCOUNTER, "encounter_uuid", "left"
    )
    identifier = {"use": "'official'", "system": text(identifier_system), "value": ENCOUNTER}
    return n.as_resource(rows, "Encounter", {
        "id": f"coalesce(encounter_uuid, {scalars.pseudonym('Encounter', ENCOUNTER, salt)})",
        "meta": _profile(fv.ENCOUNTER_PROFILE),
        "identifier": n.array(n.field_struct("Encounter", "identifier", identifier)),
        "status": "'finished'",
        "class": n.coding(text(fv.ACT_CODE), codes.encounter_class("INOUT_CD")),
        "type": n.array(n.concept(
            n.fixed_coding(fv.SNOMED, "308335008", "Patient encounter procedure")
        )),
        "subject": SUBJECT_REF,
        "period": "named_struct('start', START_DATE, 'end', END_DATE)",
    })


def first_predictions(results: DataFrame, order: Sequence[str]) -> DataFrame:
    """(ENCOUNTER_NUM, PREDICTION): the first prediction of each encounter."""
    return first_per_key(results, [ENCOUNTER], order).select(ENCOUNTER, "PREDICTION")


def map_classifier(
    notes: DataFrame,
    predictions: DataFrame,
    patients: DataFrame,
    encounters: DataFrame,
    salt: str,
    order: Sequence[str] = ("START_DATE",),
    tag: str = fv.CLASSIFIER_202204,
) -> DataFrame:
    """One classifier Observation per noted encounter that has a prediction.

    ``tag`` names the classifier version. The first version matches ``Positive`` by exact
    case and carries its number besides its name; later ones ignore case.
    """
    first_version = tag == fv.CLASSIFIER_V1
    columns = dict.fromkeys([PATIENT, ENCOUNTER, "START_DATE", *order])
    first_notes = first_per_key(notes.select(*columns), [ENCOUNTER], order)
    usable = predictions.where(f"PREDICTION <> {text(fv.NOT_CLASSIFIED)}")
    rows = with_ids(first_notes.join(usable, ENCOUNTER), patients, encounters)
    positive = "PREDICTION = 'Positive'" if first_version else "lower(PREDICTION) = 'positive'"
    value_code = f"CASE WHEN {positive} THEN '{fv.POSITIVE_CODE}' ELSE '{fv.NEGATIVE_CODE}' END"
    number = {"valueInteger": str(fv.CLASSIFIER_V1_NUMBER)} if first_version else {}
    return n.as_resource(rows, "Observation", {
        "id": scalars.pseudonym("Observation", scalars.row_key([text(tag), ENCOUNTER]), salt),
        "text": "named_struct('status', 'generated', 'div', 'NLP Classifier')",
        "status": "'unknown'",
        "category": n.array(n.concept(
            n.fixed_coding(fv.CLASSIFIER_CATEGORY_SYSTEM, "laboratory", "laboratory")
        )),
        "code": n.coded(n.array(n.fixed_coding(fv.LOINC, fv.CLASSIFIER_LOINC))),
        "subject": SUBJECT_REF,
        "encounter": ENCOUNTER_REF,
        "effectiveDateTime": scalars.day("START_DATE"),
        "valueCodeableConcept": n.concept(n.coding(text(fv.SNOMED), value_code, "PREDICTION")),
        "modifierExtension": n.array(
            n.extension(fv.CLASSIFIER_URL, valueString=text(tag), **number)
        ),
    })
