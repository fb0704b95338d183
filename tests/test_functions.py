import base64
import hashlib

import pytest

from cohortloom.functions import codes, scalars
from cohortloom.functions import fixed_values as fv


def test_result_code_case_rules(value):
    assert value(codes.result_code("'POSITIVE'")) == fv.POSITIVE_CODE
    assert value(codes.result_code("'POSITIVE'", case_sensitive=True)) == fv.INCONCLUSIVE_CODE
    assert value(codes.result_code("'Negative'", case_sensitive=True)) == fv.NEGATIVE_CODE
    assert value(codes.result_code("CAST(NULL AS STRING)")) == fv.INCONCLUSIVE_CODE


@pytest.mark.parametrize("concept,system,code", [
    ("ICD10:E66.9", "ICD-10", "E66.9"),
    ("ICD9:079.89", "ICD-9", "079.89"),
    ("LOCAL:X:Y", "Not Found", "X"),
    ("nocolon", "Not Found", None),
])
def test_diagnosis_parts(value, concept, system, code):
    assert value(codes.diagnosis_system(f"'{concept}'")) == system
    assert value(codes.diagnosis_code(f"'{concept}'")) == code


def test_defaults_for_null(value):
    null = "CAST(NULL AS STRING)"
    assert value(codes.gender(null)) == "unknown"
    assert value(codes.race_code(null)) is None
    assert value(codes.encounter_class(null)) == "EMER"
    assert value(codes.encounter_class("'Inpatient'")) == "IMP"
    assert value(codes.coding_system("'LOCAL'")) == "LOCAL"
    assert value(codes.lab_loinc("'LAB:0'")) is None


@pytest.mark.parametrize("age,band", [
    (-3, "0-18"), (18, "0-18"), (19, "19-44"), (64, "45-64"), (84, "65-84"), (300, "85+"),
    (301, "?"), ("CAST(NULL AS INT)", "?"),
])
def test_age_band(value, age, band):
    assert value(codes.age_band(f"{age}", "?")) == band


def test_polarity_vote(value):
    assert [value(codes.polarity_vote(str(p))) for p in (0, -1, 3)] == [1, -1, None]


def test_pseudonym_is_a_keyed_digest(value):
    digest = hashlib.sha256(b"salt|Patient|17").hexdigest()
    expected = "-".join((digest[:8], digest[8:12], digest[12:16], digest[16:20], digest[20:32]))
    assert value(scalars.pseudonym("Patient", "'17'", "salt")) == expected
    assert value(scalars.pseudonym("Patient", "CAST(NULL AS STRING)", "salt")) is None
    assert value(scalars.is_uuid(f"'{expected}'"))


def test_uuid_forms(value):
    assert value(scalars.is_uuid("'{ABCDEF00-0000-0000-0000-000000000000}'"))
    assert value(scalars.is_uuid("'urn:uuid:abcdef00-0000-0000-0000-000000000000'"))
    assert not value(scalars.is_uuid("'abc'"))
    assert value(scalars.is_uuid("CAST(NULL AS STRING)")) is False


def test_long_note_round_trip_on_one_line(spark):
    note = "Fièvre — 39°\n" * 400
    row = spark.createDataFrame([(note,)], "t string").selectExpr(
        f"{scalars.encode_note('t')} AS data"
    ).selectExpr("data", f"{scalars.decode_note('data')} AS back").first()
    assert row["data"] == base64.b64encode(note.encode()).decode()
    assert row["back"] == note


def test_bad_base64_and_dates_are_null(value):
    assert value(scalars.decode_note("'@@@'")) is None
    assert value(scalars.parse_day("'2021-13-40'")) is None
    assert value(scalars.to_int("'19x'")) is None
    assert str(value(scalars.trunc_day("week", "DATE '1997-01-01'"))) == "1996-12-30"
