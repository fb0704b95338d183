"""Comparison SQL: shared common table expressions in DuckDB's dialect."""

from __future__ import annotations

from collections.abc import Mapping

from cohortloom.functions import fixed_values as fv
from workload.shapes import AS_OF, SALT, SHAPES, shape_sql


def uuid(kind: str, key: str) -> str:
    digest = f"left(sha256('{SALT}|{kind}|' || {key}), 32)"
    return rf"regexp_replace({digest}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '\1-\2-\3-\4-')"


def row_key(*columns: str) -> str:
    """Each value after its length, NULL as a dash."""
    return " || ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns
    )


def patient(key: str = "PATIENT_NUM") -> str:
    return uuid("Patient", key)


def encounter(key: str = "ENCOUNTER_NUM") -> str:
    return uuid("Encounter", key)


def cases(key: str, table: Mapping[str, str], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {key} {arms} ELSE {default} END"


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


BASE = {name: shape_sql(name) for name in SHAPES}
BASE["cohort_p"] = "SELECT DISTINCT PATIENT_NUM FROM note_cohort"
BASE["cohort_e"] = "SELECT DISTINCT ENCOUNTER_NUM FROM note_cohort"
IN_COHORT = (
    "PATIENT_NUM IN (SELECT PATIENT_NUM FROM cohort_p)"
    " AND ENCOUNTER_NUM IN (SELECT ENCOUNTER_NUM FROM cohort_e)"
)

# Facts over natural keys: e = encounter, p = patient.
BASE["enc"] = (
    "SELECT ENCOUNTER_NUM e, PATIENT_NUM p, min(substr(START_DATE, 1, 10)) d"
    " FROM note_cohort GROUP BY ALL"
)
BASE["m1"] = (
    "SELECT *, row_number() OVER (PARTITION BY ENCOUNTER_NUM, cui ORDER BY row_id) rn"
    f" FROM nlp_mention WHERE {IN_COHORT}"
)
BASE["cond"] = (
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ENCOUNTER_NUM, CONCEPT_CD"
    f" ORDER BY START_DATE, PATIENT_NUM) rn FROM diagnosis WHERE {IN_COHORT}) WHERE rn = 1"
)
BASE["dx"] = (
    "SELECT DISTINCT ENCOUNTER_NUM e, PATIENT_NUM p, substr(START_DATE, 1, 10) d FROM cond"
    " WHERE CONCEPT_CD = 'ICD10:U07.1'"
)
BASE["lab"] = (
    "SELECT DISTINCT ENCOUNTER_NUM e, PATIENT_NUM p, substr(START_DATE, 1, 10) d,"
    " CASE lower(TVAL_CHAR) WHEN 'negative' THEN 'Negative' WHEN 'positive' THEN 'Positive' END r"
    " FROM lab_cohort WHERE CONCEPT_CD IN ('LAB:1043473617', 'LAB:1044804335', 'LAB:1134792565')"
    f" AND {IN_COHORT}"
)
BASE["first_note"] = (
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ENCOUNTER_NUM ORDER BY row_id) rn"
    " FROM note_cohort) WHERE rn = 1"
)
BASE["first_pred"] = (
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ENCOUNTER_NUM ORDER BY row_id) rn"
    " FROM classifier_prediction) WHERE rn = 1"
)
BASE["cl"] = (
    "SELECT n.ENCOUNTER_NUM e, n.PATIENT_NUM p, substr(START_DATE, 1, 10) d, PREDICTION,"
    " CASE WHEN lower(PREDICTION) = 'positive' THEN 'Positive' ELSE 'Negative' END r"
    " FROM first_note n JOIN first_pred f ON n.ENCOUNTER_NUM = f.ENCOUNTER_NUM"
)
BASE["cl1"] = (
    "SELECT n.ENCOUNTER_NUM e, n.PATIENT_NUM p, substr(START_DATE, 1, 10) d, V1_PREDICTION,"
    " CASE WHEN V1_PREDICTION = 'Positive' THEN 'Positive' ELSE 'Negative' END r"
    " FROM first_note n JOIN first_pred f ON n.ENCOUNTER_NUM = f.ENCOUNTER_NUM"
    " WHERE V1_PREDICTION <> 'Not classified'"
)
BASE["pat"] = (
    "SELECT PATIENT_NUM p, CASE SEX_CD WHEN 'F' THEN 'female' WHEN 'M' THEN 'male'"
    " ELSE 'unknown' END gender, CAST(substr(BIRTH_DATE, 1, 4) AS INT) birth,"
    f" {AS_OF[:4]} - CAST(substr(BIRTH_DATE, 1, 4) AS INT) age, ZIP_CD zip,"
    " CASE WHEN RACE_CD IN ('White', 'Black or African American', 'Asian') THEN RACE_CD END race,"
    " RACE_CD FROM patient_dimension WHERE PATIENT_NUM IN (SELECT PATIENT_NUM FROM cohort_p)"
)
BASE["majority"] = (
    f"SELECT ENCOUNTER_NUM e, {cases('snomed_code', fv.SYMPTOMS_B)} s FROM m1"
    f" WHERE rn = 1 AND snomed_code IN ({listed(fv.SYMPTOMS_B)}) GROUP BY 1, 2"
    " HAVING sum(CASE polarity WHEN 0 THEN 1 WHEN -1 THEN -1 END) > 0"
)


def asserted(labels: Mapping[str, str], kept) -> str:
    return (
        f"SELECT DISTINCT ENCOUNTER_NUM e, {cases('snomed_code', labels, quote(fv.OTHER_SYMPTOMS))} s"
        f" FROM m1 WHERE rn = 1 AND polarity = 0 AND snomed_code IN ({listed(kept)})"
    )


def quote(value: str) -> str:
    return f"'{value}'"


def age_band(default: str) -> str:
    return (
        "CASE WHEN age < 19 THEN '0-18' WHEN age BETWEEN 19 AND 44 THEN '19-44'"
        " WHEN age BETWEEN 45 AND 64 THEN '45-64' WHEN age BETWEEN 65 AND 84 THEN '65-84'"
        f" WHEN age BETWEEN 85 AND 300 THEN '85+' ELSE '{default}' END"
    )


def query(body: str, **extra: str) -> str:
    """A query over the base expressions and some of its own."""
    parts = ", ".join(f"{name} AS ({sql})" for name, sql in {**BASE, **extra}.items())
    return f"WITH {parts} {body}"


def symptom_cube(
    symptoms: str, no_symptom: str, dx: str, no_dx: str, lab: str, cls: str, prefix: str,
    window: str, dims: str, count: str,
) -> dict[str, str]:
    """Expressions ``symptom``, ``combine`` and ``cube`` of a symptom report."""
    combine = (
        "SELECT DISTINCT enc.e, enc.p,"
        " CAST(date_trunc('month', CAST(enc.d AS DATE)) AS DATE) enct_date,"
        f" coalesce(s.s, '{no_symptom}') symptoms,"
        " CASE WHEN gender IN ('male', 'female') THEN gender ELSE 'Missing' END gender,"
        f" {age_band('Missing')} age_group, coalesce(race, 'Missing') race,"
        f" CASE WHEN x.e IS NOT NULL THEN '{dx}' ELSE '{no_dx}' END covid_diagnosis,"
        f" coalesce('{lab}' || lab.r, 'No lab test') covid_lab_test,"
        f" coalesce('{prefix}' || c.r, 'No classifier') covid_classifier"
        " FROM enc LEFT JOIN symptom s ON enc.e = s.e LEFT JOIN pat ON enc.p = pat.p"
        " LEFT JOIN (SELECT DISTINCT e FROM dx) x ON enc.e = x.e"
        f" LEFT JOIN lab ON enc.e = lab.e LEFT JOIN {cls} c ON enc.e = c.e"
    )
    cube = (
        f"SELECT {dims}, count(DISTINCT {count}) AS cnt FROM combine WHERE {window}"
        f" GROUP BY CUBE({dims})"
    )
    return {"symptom": symptoms, "combine": combine, "cube_rows": cube}
