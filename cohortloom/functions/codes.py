"""Code lookups and CASE expressions over the fixed tables, as SQL expressions.

Every function takes SQL expressions as text and returns one, for ``F.expr``,
``selectExpr`` or ``spark.sql``. Lookups are CASE chains of literals: they stay inside
whole-stage codegen and need neither a join nor a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from cohortloom.functions import fixed_values as fv


def text(value: str) -> str:
    """SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def one_of(key: str, values: Iterable[str]) -> str:
    return f"{key} IN ({', '.join(text(v) for v in values)})"


def lookup(key: str, table: Mapping[str, str], default: str = "NULL") -> str:
    """Value of ``key`` in a small literal table, ``default`` on a miss."""
    by_value: dict[str, list[str]] = {}
    for code, label in table.items():
        by_value.setdefault(label, []).append(code)
    arms = [f"WHEN {one_of(key, codes)} THEN {text(label)}" for label, codes in by_value.items()]
    return f"CASE {' '.join(arms)} ELSE {default} END"


def lab_loinc(code: str) -> str:
    return lookup(code, fv.LAB_TO_LOINC)


def result_code(value: str, case_sensitive: bool = False) -> str:
    """SNOMED code of a result text; anything but positive/negative is inconclusive."""
    table = {"Positive": fv.POSITIVE_CODE, "Negative": fv.NEGATIVE_CODE}
    if not case_sensitive:
        value, table = f"lower({value})", {k.lower(): v for k, v in table.items()}
    return lookup(value, table, text(fv.INCONCLUSIVE_CODE))


def concept_part(concept: str, at: int) -> str:
    """The ``:`` part of a concept code at a position, NULL when there is none."""
    return f"get(split({concept}, ':'), {at})"


def diagnosis_system(concept: str) -> str:
    return lookup(concept_part(concept, 0), fv.DIAGNOSIS_SYSTEMS, text(fv.UNKNOWN_SYSTEM))


def diagnosis_code(concept: str) -> str:
    return concept_part(concept, 1)


def race_code(display: str) -> str:
    return lookup(display, fv.RACE_TO_CODE)


def gender(code: str) -> str:
    return lookup(code, fv.GENDERS, "'unknown'")


def encounter_class(inout: str) -> str:
    return f"CASE WHEN {inout} = 'Inpatient' THEN 'IMP' ELSE 'EMER' END"


def coding_system(scheme: str) -> str:
    return lookup(scheme, fv.CODING_SCHEMES, scheme)


def result_label(
    system: str, code: str, positive: str, negative: str, default: str | None = None
) -> str:
    snomed = f"{system} = {text(fv.SNOMED)}"
    other = "NULL" if default is None else text(default)
    return (
        f"CASE WHEN {snomed} AND {code} = '{fv.NEGATIVE_CODE}' THEN {text(negative)}"
        f" WHEN {snomed} AND {code} = '{fv.POSITIVE_CODE}' THEN {text(positive)} ELSE {other} END"
    )


def omb_race(code: str, display: str) -> str:
    return f"CASE WHEN {one_of(code, fv.OMB_RACE_CODES)} THEN {display} END"


def age_band(age: str, default: str = "Missing") -> str:
    return (
        f"CASE WHEN {age} < 19 THEN '0-18' WHEN {age} BETWEEN 19 AND 44 THEN '19-44'"
        f" WHEN {age} BETWEEN 45 AND 64 THEN '45-64' WHEN {age} BETWEEN 65 AND 84 THEN '65-84'"
        f" WHEN {age} BETWEEN 85 AND 300 THEN '85+' ELSE {text(default)} END"
    )


def or_default(value: str, default: str) -> str:
    return f"coalesce({value}, {text(default)})"


def known_gender(value: str, default: str = "Missing") -> str:
    return f"CASE WHEN {value} IN ('male', 'female') THEN {value} ELSE {text(default)} END"


def polarity_vote(polarity: str) -> str:
    """+1 for an asserted mention, -1 for a negated one, NULL otherwise."""
    return f"CASE {polarity} WHEN 0 THEN 1 WHEN -1 THEN -1 END"
