"""Reports over stored resource tables.

``tables`` maps ``patient``, ``condition``, ``observation`` and ``documentreference`` to
stored tables. Date windows and the reporting date are parameters, so results repeat.

The symptom reports join per-encounter rows only: every fact is reduced to one row per
encounter, with its labels as a small array, before it is joined, and the arrays are
expanded after the last join. The fan-out of an encounter is bounded by the label
vocabularies and not by its number of facts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import codes, scalars
from cohortloom.functions import fixed_values as fv
from cohortloom.functions.codes import text
from cohortloom.operators.cube import distinct_cube
from cohortloom.operators.dedup import distinct_by
from cohortloom.plans import facts

Tables = Mapping[str, DataFrame]

KNOWN = "('Positive', 'Negative')"
RESULT_DIMS = ["enct_date", "test_method", "covid_result", "gender", "age_group", "race"]
SYMPTOM_DIMS_6 = ["enct_date", "symptoms", "gender", "age_group", "race", "covid_diagnosis"]
SYMPTOM_DIMS_8 = [*SYMPTOM_DIMS_6, "covid_lab_test", "covid_classifier"]


# --- result by week (R1) ---------------------------------------------------------------


def _per_encounter(results: DataFrame, label: str, name: str) -> DataFrame:
    """One row per encounter and subject with its distinct (day, label) pairs.

    The sets are combined before the exchange and bounded by days times labels.
    """
    pairs = results.selectExpr(
        "encounter_id", "subject_id",
        f"named_struct('day', {scalars.day('enct_date')}, 'label', {label}) AS pair",
    )
    return pairs.groupBy("encounter_id", "subject_id").agg(F.collect_set("pair").alias(name))


def lab_classifier(lab: DataFrame, classifier: DataFrame) -> DataFrame:
    """Full outer join of lab and classifier results per encounter and subject.

    The method and result columns follow the three-valued logic of the source: a missing
    lab result makes every comparison with it NULL, so classifier-only rows are Unknown.
    Both sides enter as one row per key. A dated lab result takes its own day, so it meets
    each classifier label once and not each classifier row: the rows of a key grow with
    its results, not with their product.
    """
    return _paired(_per_encounter(lab, "covid_lab_test", "l").join(
        _per_encounter(classifier, "covid_classifier", "c"), ["encounter_id", "subject_id"], "full"
    ))


def _paired(both: DataFrame) -> DataFrame:
    """Method and result rows of the joined sets ``l`` and ``c``, either of them NULL."""
    keys = ["encounter_id", "subject_id"]
    labels = "transform(array_distinct(c.label), z -> named_struct('day', CAST(NULL AS STRING), 'label', z))"
    nothing = "array(named_struct('day', CAST(NULL AS STRING), 'label', CAST(NULL AS STRING)))"
    pair = (
        "named_struct('enct_date', coalesce(x.day, y.day), 'covid_lab_test', x.label,"
        " 'covid_classifier', y.label)"
    )
    other = "CASE WHEN c IS NULL OR x.day IS NULL THEN all_c ELSE labels END"
    rows = both.selectExpr(
        *keys, f"coalesce(l, {nothing}) AS l", "c", f"coalesce(c, {nothing}) AS all_c", f"{labels} AS labels"
    ).selectExpr(*keys, f"inline(flatten(transform(l, x -> transform({other}, y -> {pair}))))")
    # Only a known result decides, the lab's before the classifier's; without any lab row
    # nothing is decided. A lab that stayed open next to an open classifier keeps its name.
    decided = f"covid_lab_test IN {KNOWN}"
    open_lab = "covid_lab_test IS NOT NULL"
    source = (
        f"CASE WHEN {decided} THEN named_struct('method', 'Lab_test', 'result', covid_lab_test)"
        f" WHEN {open_lab} AND covid_classifier IN {KNOWN}"
        " THEN named_struct('method', 'covid_classifier', 'result', covid_classifier)"
        f" ELSE named_struct('method', IF({open_lab} AND covid_lab_test = 'Unknown'"
        " AND covid_classifier IS NOT NULL, 'Lab_test', 'Unknown'), 'result', 'Unavailable') END"
    )
    return rows.where("covid_lab_test IS NOT NULL OR covid_classifier IS NOT NULL").selectExpr(
        *keys, "enct_date", f"{source} AS source"
    ).selectExpr(*keys, "enct_date", "source.method AS test_method", "source.result AS covid_result")


def covid_result_rows(
    tables: Tables, classifier_tag: int | str = 1, positional_union: bool = False
) -> DataFrame:
    """Lab, classifier and diagnosis rows by week.

    ``positional_union`` appends the diagnosis rows by position with the two id columns
    exchanged, as the original report did.
    """
    observations = tables["observation"]
    joined = _paired(facts.result_sets(observations, classifier_tag))
    dx = facts.diagnoses(tables["condition"])
    if positional_union:
        swapped = dx.select("subject_id", "encounter_id", "enct_date", "test_method", "covid_result")
        rows = joined.union(swapped)
    else:
        rows = joined.unionByName(dx)
    week = scalars.trunc_day("week", scalars.parse_day(scalars.day("enct_date")))
    return rows.selectExpr(
        "encounter_id", "subject_id", f"{week} AS enct_date", "test_method", "covid_result"
    )


def covid_result_cube(
    tables: Tables, as_of, year: int = 2021, classifier_tag: int | str = 1,
    positional_union: bool = False,
) -> DataFrame:
    rows = covid_result_rows(tables, classifier_tag, positional_union)
    profiles = facts.patient_profiles(tables["patient"], as_of)
    combined = (
        rows.where(f"year(enct_date) = {year}").distinct()
        .join(profiles, "subject_id", "left")
        .selectExpr(
            "encounter_id", "enct_date", "test_method", "covid_result",
            f"{codes.or_default('gender', 'Unavailable')} AS gender",
            f"{codes.age_band('age', '?')} AS age_group",
            f"{codes.or_default('race', 'Unavailable')} AS race",
        )
    )
    return distinct_cube(combined, RESULT_DIMS, "encounter_id")


# --- symptom cubes (R2 to R5) ----------------------------------------------------------


def _expand(labels: str, default: str, name: str) -> str:
    """Rows of a label array; ``default`` when the encounter has none."""
    return f"explode(CASE WHEN size({labels}) > 0 THEN {labels} ELSE array({text(default)}) END) AS {name}"


def symptom_rows(
    tables: Tables, as_of, window: str, evidence: DataFrame, *, entity: str, dx_label: str,
    no_dx: str, no_symptom: str, collapse_race: bool = False,
) -> DataFrame:
    """Distinct rows of the counted ``entity`` with all symptom report dimensions.

    Rows are made distinct before the profile join: when patients are counted, a patient
    with any number of encounters enters that join as a set bounded by the vocabularies.
    """
    encounters = (
        facts.note_encounters(tables["documentreference"], parsed=True)
        .withColumn("enct_date", F.expr(scalars.trunc_day("month", "enct_date"))).where(window)
    )
    dx = (
        facts.with_code(tables["condition"])
        .selectExpr(facts.ENCOUNTER).distinct()
        .withColumn("dx", F.expr(text(dx_label)))  # after the distinct, whose partitioning the join keeps
    )
    profiles = facts.patient_profiles(tables["patient"], as_of, collapse_race)
    keys = list(dict.fromkeys([entity, "subject_id"]))
    kept = [*keys, "enct_date", "covid_diagnosis"]
    rows = (
        encounters.join(evidence, "encounter_id", "left").join(dx, "encounter_id", "left")
        .withColumn("covid_diagnosis", F.expr(codes.or_default("dx", no_dx)))
        .selectExpr(*kept, "labs", "classifiers", _expand("symptoms", no_symptom, "symptoms"))
        .selectExpr(*kept, "symptoms", "classifiers", _expand("labs", "No lab test", "covid_lab_test"))
        .selectExpr(
            *kept, "symptoms", "covid_lab_test",
            _expand("classifiers", "No classifier", "covid_classifier"),
        )
    )
    # A patient's rows are bounded by months and vocabularies, those of its encounters are not.
    once = distinct_by(rows, "subject_id") if entity == "subject_id" else rows.distinct()
    return once.join(profiles, "subject_id", "left").selectExpr(
        *keys, "enct_date", "symptoms",
        f"{codes.known_gender('gender')} AS gender",
        f"{codes.age_band('age')} AS age_group",
        f"{codes.or_default('race', 'Missing')} AS race",
        "covid_diagnosis", "covid_lab_test", "covid_classifier",
    )


def _between(first: int, last: int) -> str:
    return f"year(enct_date) BETWEEN {first} AND {last}"


def _until(first: int, as_of) -> str:
    return f"year(enct_date) >= {first} AND enct_date <= {scalars.as_of_date(as_of)}"


def symptom_cube_v6(tables: Tables, as_of, year: int = 2021) -> DataFrame:
    """Encounters by asserted symptom and diagnosis."""
    evidence = facts.encounter_evidence(
        tables["observation"], fv.SYMPTOMS_A, majority=False, default_symptom=fv.OTHER_SYMPTOMS
    )
    rows = symptom_rows(
        tables, as_of, _between(year, year), evidence, entity="encounter_id",
        dx_label="presumably positive", no_dx="Negative", no_symptom=fv.OTHER_SYMPTOMS,
    )
    return distinct_cube(rows, SYMPTOM_DIMS_6, "encounter_id")


def symptom_cube_v7(
    tables: Tables, as_of, first_year: int = 2016, last_year: int = 2022,
    classifier_tag: int | str = 1,
) -> DataFrame:
    """Patients by asserted symptom, diagnosis, test and classifier.

    Second-edition codes count, labelled by the first edition's table.
    """
    evidence = facts.encounter_evidence(
        tables["observation"], fv.SYMPTOMS_A, kept_codes=list(fv.SYMPTOMS_B), majority=False,
        default_symptom=fv.OTHER_SYMPTOMS, lab=("Positive", "Negative"),
        classifier=("Positive", "Negative"), classifier_tag=classifier_tag,
    )
    rows = symptom_rows(
        tables, as_of, _between(first_year, last_year), evidence, entity="subject_id",
        dx_label="Positive", no_dx="No covid diagnosis", no_symptom=fv.OTHER_SYMPTOMS,
    )
    return distinct_cube(rows, SYMPTOM_DIMS_8, "subject_id", compact=False)


def symptom_cube_v72(
    tables: Tables, as_of, first_year: int = 2016, classifier_tag: int | str = 1
) -> DataFrame:
    """As the former, with second-edition labels and prefixed results, up to ``as_of``."""
    evidence = facts.encounter_evidence(
        tables["observation"], fv.SYMPTOMS_B, majority=False, default_symptom=fv.OTHER_SYMPTOMS,
        lab=("PCR Positive", "PCR Negative"), classifier=("NLP Positive", "NLP Negative"),
        classifier_tag=classifier_tag,
    )
    rows = symptom_rows(
        tables, as_of, _until(first_year, as_of), evidence, entity="subject_id",
        dx_label="DX Positive", no_dx="No covid diagnosis", no_symptom=fv.OTHER_SYMPTOMS,
    )
    return distinct_cube(rows, SYMPTOM_DIMS_8, "subject_id", compact=False)


def symptom_rows_v81(
    tables: Tables, as_of, first_year: int = 2016,
    classifier_tag: int | str = fv.CLASSIFIER_202204, collapse_race: bool = False,
) -> DataFrame:
    evidence = facts.encounter_evidence(
        tables["observation"], fv.SYMPTOMS_B, majority=True, default_symptom=fv.OTHER_SYMPTOMS,
        lab=("PCR Positive", "PCR Negative"), classifier=("Positive", "Negative"),
        classifier_tag=classifier_tag,
    )
    return symptom_rows(
        tables, as_of, _until(first_year, as_of), evidence, entity="subject_id",
        dx_label="DX Positive", no_dx="No covid diagnosis", no_symptom=fv.NO_SYMPTOMS,
        collapse_race=collapse_race,
    )


def symptom_cube_v81(
    tables: Tables, as_of, first_year: int = 2016,
    classifier_tag: int | str = fv.CLASSIFIER_202204, collapse_race: bool = False,
    grouping_id: bool = False,
) -> DataFrame:
    """Patients by majority symptom, diagnosis, test and classifier version, up to ``as_of``."""
    rows = symptom_rows_v81(tables, as_of, first_year, classifier_tag, collapse_race)
    return distinct_cube(rows, SYMPTOM_DIMS_8, "subject_id", grouping_id=grouping_id, compact=False)


# --- delays (R7) -----------------------------------------------------------------------


def encounter_delays(tables: Tables) -> DataFrame:
    """Days from note to diagnosis and to lab per encounter: min, max and gap.

    Extremes over all pairs of dates follow from the extremes of each side, so no pairs
    are made.
    """
    notes = (
        facts.note_encounters(tables["documentreference"], parsed=True)
        .groupBy("encounter_id")
        .agg(F.min("enct_date").alias("first_note"), F.max("enct_date").alias("last_note"))
    )

    def extremes(rows: DataFrame, date: str, name: str) -> DataFrame:
        return (
            rows.selectExpr(facts.ENCOUNTER, f"{scalars.parse_day(scalars.day(date))} AS day")
            .where("day IS NOT NULL")
            .groupBy("encounter_id")
            .agg(F.min("day").alias(f"first_{name}"), F.max("day").alias(f"last_{name}"))
        )

    dx = extremes(facts.with_code(tables["condition"]), "onsetDateTime", "dx")
    labs = tables["observation"].where(
        f"{facts.IS_LAB} AND size(valueCodeableConcept.coding.code) > 0"
    )
    lab = extremes(labs, "effectiveDateTime", "lab")
    both = notes.join(dx, "encounter_id", "left").join(lab, "encounter_id", "left").where(
        "first_dx IS NOT NULL OR first_lab IS NOT NULL"
    )

    def delays(name: str) -> list[str]:
        low = f"datediff(first_{name}, last_note)"
        high = f"datediff(last_{name}, first_note)"
        return [
            f"{low} AS min_{name}_delay",
            f"{high} AS max_{name}_delay",
            f"{high} - {low} AS multi_{name}_gap",
        ]

    return both.selectExpr("encounter_id", *delays("dx"), *delays("lab"))


def lab_delay_histogram(tables: Tables) -> DataFrame:
    """Encounters per smallest lab delay, those without a lab last."""
    return (
        encounter_delays(tables)
        .groupBy("min_lab_delay")
        .agg(F.count("encounter_id").alias("cnt"))
        .orderBy(F.asc_nulls_last("min_lab_delay"))
    )


# --- nested field query (R8) -----------------------------------------------------------


def patient_states(patients: DataFrame) -> DataFrame:
    return patients.select(F.explode("address.state").alias("state"))
