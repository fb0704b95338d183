"""Per-encounter facts from stored resource tables.

Struct leaves are projected before every explode, so that the scan reads only them, and
arrays are filtered before the explode, so that rows that cannot match are never made.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import codes, scalars
from cohortloom.functions import fixed_values as fv
from cohortloom.functions.codes import text
from cohortloom.operators.dedup import distinct_by

SUBJECT = "subject.reference_id_aa AS subject_id"
ENCOUNTER = "encounter.reference_id_aa AS encounter_id"


def leaves(path: str, *names: str) -> str:
    """Array of structs cut to some of its leaves, so that the scan reads only these."""
    return f"arrays_zip({', '.join(f'{path}.{name}' for name in names)})"


def spread(df: DataFrame, columns: list[str], array: str, into: str) -> DataFrame:
    """The columns, then one row per array item as column ``into``.

    Columns are projected to leaves and the array is built below the explode, so whole
    structs neither reach the scan nor the exploded rows.
    """
    below = df.selectExpr(*columns, f"{array} AS _items")
    return below.selectExpr(*below.columns[:-1], f"explode(_items) AS {into}")


def spread_structs(df: DataFrame, columns: list[str], array: str, key: str) -> DataFrame:
    """The columns, then one row per struct of an array, its fields as columns.

    ``key`` is a field that is never NULL. The outer generator with a filter behind it
    gives the rows of the plain one; for the plain one the optimizer infers a non-empty
    check and pushes it to the scan, where it evaluates the whole array expression twice
    more for every row.
    """
    below = df.selectExpr(*columns, f"{array} AS _items")
    rows = below.selectExpr(*below.columns[:-1], "inline_outer(_items)")
    return rows.where(f"{key} IS NOT NULL")


def note_encounters(documents: DataFrame, parsed: bool = False) -> DataFrame:
    """(encounter_id, subject_id, enct_date): first note day of each noted encounter.

    The day is text; ``parsed`` gives a date, whose minimum is kept in a hash aggregation
    where that of a text needs a sort.
    """
    day = scalars.day("date")
    columns = [SUBJECT, f"{scalars.parse_day(day) if parsed else day} AS day"]
    rows = spread(documents, columns, "context.encounter.reference_id_aa", "encounter_id")
    return rows.groupBy("encounter_id", "subject_id").agg(F.min("day").alias("enct_date"))


# Race of every extension, NULL where it is none of the listed ones.
_RACES = (
    f"transform({leaves('extension.valueCoding', 'code', 'display_aa')},"
    f" v -> {codes.omb_race('v.code', 'v.display_aa')})"
)


def _age(as_of) -> str:
    return scalars.age_in(scalars.as_of_date(as_of), scalars.to_int("birthDate"))


def patient_demographics(patients: DataFrame, as_of) -> DataFrame:
    """Distinct (gender, dob, age, race, postalcode, subject_id), one row per extension
    and address; patients without birth year, gender, extension or address are left out.
    """
    dob = scalars.parse_day("concat(birthDate, '-01-01')")
    usable = patients.where("birthDate IS NOT NULL AND gender IS NOT NULL")
    columns = [
        "id AS subject_id", "gender", f"{dob} AS dob", f"{_age(as_of)} AS age",
        "address.postalCode AS postal",
    ]
    rows = spread(usable, columns, _RACES, "race")
    return rows.selectExpr(
        "gender", "dob", "age", "race", "explode(postal) AS postalcode", "subject_id"
    ).distinct()


def patient_profiles(patients: DataFrame, as_of, collapse_race: bool = False) -> DataFrame:
    """Distinct (subject_id, gender, age, race) for reports.

    A patient with several extensions has one row per distinct race value, NULL included;
    ``collapse_race`` keeps the non-NULL ones where there are any.
    """
    races = f"array_distinct({_RACES})"
    if collapse_race:
        known = f"array_compact({races})"
        races = f"CASE WHEN size({known}) > 0 THEN {known} ELSE {races} END"
    usable = patients.where(
        "birthDate IS NOT NULL AND gender IS NOT NULL AND size(address.postalCode) > 0"
    )
    columns = ["id AS subject_id", "gender", f"{_age(as_of)} AS age"]
    return distinct_by(spread(usable, columns, races, "race"), "subject_id")


def with_code(conditions: DataFrame, code: str = fv.COVID_DIAGNOSIS) -> DataFrame:
    return conditions.where(f"exists(code.coding.code, c -> c = {text(code)})")


def diagnoses(
    conditions: DataFrame,
    test_method: str = "dx U07.1",
    covid_result: str = "Unavailable",
    code: str = fv.COVID_DIAGNOSIS,
) -> DataFrame:
    """Distinct (encounter_id, subject_id, enct_date, test_method, covid_result)."""
    return with_code(conditions, code).selectExpr(
        ENCOUNTER, SUBJECT, "onsetDateTime AS enct_date",
        f"{text(test_method)} AS test_method", f"{text(covid_result)} AS covid_result",
    ).distinct()


# Result of a listed laboratory test, not derived from notes.
IS_LAB = (
    "modifierExtension IS NULL"
    f" AND exists(code.coding.code, c -> {codes.one_of('c', fv.COVID_LOINC)})"
    " AND exists(category.coding, cs -> exists(cs, c -> c.code = 'laboratory'))"
)


def is_classifier(tag: int | str) -> str:
    """Classifier result of a version, by number or by name."""
    name, value = ("valueInteger", str(tag)) if isinstance(tag, int) else ("valueString", text(tag))
    return (
        f"exists({leaves('modifierExtension', 'url', name)},"
        f" m -> m.url = {text(fv.CLASSIFIER_URL)} AND m.{name} = {value})"
    )


def value_labels(positive: str, negative: str, default: str | None = None) -> str:
    """Array of the result labels of all value codings."""
    label = codes.result_label("v.system", "v.code", positive, negative, default)
    return f"transform({leaves('valueCodeableConcept.coding', 'system', 'code')}, v -> {label})"


def _results(observations: DataFrame, labels: str, name: str) -> DataFrame:
    columns = [SUBJECT, ENCOUNTER, "effectiveDateTime AS enct_date"]
    # Labels may be NULL, so a marker tells a label from an empty array.
    items = f"transform({labels}, x -> named_struct('hit', true, '{name}', x))"
    return spread_structs(observations, columns, items, "hit").drop("hit").distinct()


def lab_results(
    observations: DataFrame,
    positive: str = "Positive",
    negative: str = "Negative",
    default: str | None = None,
) -> DataFrame:
    """Distinct (subject_id, encounter_id, enct_date, covid_lab_test)."""
    labels = value_labels(positive, negative, default)
    return _results(observations.where(IS_LAB), labels, "covid_lab_test")


def classifier_results(
    observations: DataFrame,
    tag: int | str = fv.CLASSIFIER_202204,
    positive: str = "Positive",
    negative: str = "Negative",
) -> DataFrame:
    """Distinct (subject_id, encounter_id, enct_date, covid_classifier)."""
    labels = value_labels(positive, negative)
    return _results(observations.where(is_classifier(tag)), labels, "covid_classifier")


def result_sets(
    observations: DataFrame, tag: int | str, lab_default: str = "Unknown"
) -> DataFrame:
    """(encounter_id, subject_id, l, c): distinct (day, label) results per encounter and subject.

    The full outer join of ``lab_results`` and ``classifier_results`` as one scan and one
    exchange; a side without results is NULL.
    """
    day = scalars.day("effectiveDateTime")

    def items(kind: str, condition: str, labels: str) -> str:
        item = f"named_struct('kind', '{kind}', 'day', {day}, 'label', x)"
        return f"coalesce(CASE WHEN {condition} THEN transform({labels}, x -> {item}) END, array())"

    lab = items("l", IS_LAB, value_labels("Positive", "Negative", lab_default))
    classifier = items("c", is_classifier(tag), value_labels("Positive", "Negative"))
    rows = spread_structs(observations, [ENCOUNTER, SUBJECT], f"concat({lab}, {classifier})", "kind")

    def found(kind: str):
        pair = f"IF(kind = '{kind}', named_struct('day', day, 'label', label), NULL)"
        return F.expr(f"collect_set({pair}) AS {kind}")

    # Rows without a full key match nothing, so their two kinds stay apart.
    apart = F.expr("IF(encounter_id IS NULL OR subject_id IS NULL, kind, '') AS apart")
    sets = rows.groupBy("encounter_id", "subject_id", apart).agg(found("l"), found("c"))
    return sets.selectExpr(
        "encounter_id", "subject_id", "IF(size(l) > 0, l, NULL) AS l", "IF(size(c) > 0, c, NULL) AS c"
    )


def votes(
    labels: Mapping[str, str],
    system: str | None = fv.SNOMED,
    default: str | None = None,
    kept: Iterable[str] | None = None,
) -> str:
    """Array of (label, vote) of an observation: listed codes times its polarities.

    ``kept`` are the codes that count, by default those with a label; a kept code without
    one gets ``default``.
    """
    listed = codes.one_of("c.code", labels if kept is None else kept)
    if system is not None:
        listed = f"c.system = {text(system)} AND {listed}"
    label = codes.lookup("c.code", labels, "NULL" if default is None else text(default))
    signs = f"filter({leaves('modifierExtension', 'url', 'valueInteger')}, m -> m.url = {text(fv.POLARITY_URL)})"
    hits = f"filter({leaves('code.coding', 'system', 'code')}, c -> {listed})"
    pair = f"named_struct('label', {label}, 'vote', {codes.polarity_vote('m.valueInteger')})"
    return f"flatten(transform({hits}, c -> transform({signs}, m -> {pair})))"


def symptom_majority(
    observations: DataFrame, labels: Mapping[str, str] = fv.SYMPTOMS_B, system: str | None = fv.SNOMED
) -> DataFrame:
    """(encounter_id, symptoms) asserted more often than negated."""
    rows = spread_structs(observations, [ENCOUNTER], votes(labels, system), "label")
    return (
        rows.groupBy("encounter_id", F.col("label").alias("symptoms"))
        .agg(F.sum("vote").alias("votes"))
        .where("votes > 0")
        .select("encounter_id", "symptoms")
    )


def symptom_dates(
    observations: DataFrame, labels: Mapping[str, str] = fv.SYMPTOMS_CUI, system: str | None = None
) -> DataFrame:
    """(encounter_id, symptoms, first_date, last_date, mentions) by the dates that mentions carry themselves."""
    listed = codes.one_of("c.code", labels)
    if system is not None:
        listed = f"c.system = {text(system)} AND {listed}"
    dates = f"filter({leaves('modifierExtension', 'url', 'valueDate')}, m -> m.valueDate IS NOT NULL)"
    hits = f"filter({leaves('code.coding', 'system', 'code')}, c -> {listed})"
    pair = f"named_struct('label', {codes.lookup('c.code', labels, 'NULL')}, 'symp_date', m.valueDate)"
    rows = spread_structs(observations, [ENCOUNTER], f"flatten(transform({hits}, c -> transform({dates}, m -> {pair})))", "label")
    return rows.groupBy("encounter_id", F.col("label").alias("symptoms")).agg(
        F.min("symp_date").alias("first_date"), F.max("symp_date").alias("last_date"), F.count(F.lit(1)).alias("mentions"))


def asserted_symptoms(observations: DataFrame, kept: Iterable[str]) -> DataFrame:
    """Distinct (subject_id, encounter_id, symptom_code) of asserted mentions."""
    own = {code: code for code in kept}
    rows = spread_structs(observations, [SUBJECT, ENCOUNTER], votes(own), "label")
    return rows.where("vote = 1").selectExpr(
        "subject_id", "encounter_id", "label AS symptom_code"
    ).distinct()


def encounter_evidence(
    observations: DataFrame,
    symptom_labels: Mapping[str, str],
    *,
    kept_codes: Iterable[str] | None = None,
    majority: bool,
    default_symptom: str,
    lab: tuple[str, str] | None = None,
    classifier: tuple[str, str] | None = None,
    classifier_tag: int | str = fv.CLASSIFIER_202204,
    no_lab: str = "No lab test",
    no_classifier: str = "No classifier",
) -> DataFrame:
    """All observation facts of an encounter from one scan and one exchange.

    One row per encounter: ``symptoms``, ``labs`` and ``classifiers`` are arrays of labels
    out of a fixed vocabulary. The counters behind them are summed before the exchange, so
    an encounter with any number of observations is one row per map task. ``symptoms``
    holds labels whose votes sum above zero (``majority``) or that were asserted at all.
    """
    kept = list(symptom_labels if kept_codes is None else kept_codes)
    vocabulary = [("symptom", x) for x in dict.fromkeys(
        symptom_labels.get(code, default_symptom) for code in kept
    )]
    found = votes(symptom_labels, fv.SNOMED, default_symptom, kept)
    parts = [f"transform({found}, x -> named_struct('kind', 'symptom', 'label', x.label, 'vote', x.vote))"]
    for kind, pair, condition, missing in (
        ("lab", lab, IS_LAB, no_lab),
        ("classifier", classifier, is_classifier(classifier_tag), no_classifier),
    ):
        if pair:
            vocabulary += [(kind, x) for x in (*pair, missing)]
            one = f"x -> named_struct('kind', '{kind}', 'label', x, 'vote', 1)"
            parts.append(
                f"CASE WHEN {condition} THEN transform({value_labels(*pair, missing)}, {one}) END"
            )
    facts = ", ".join(f"coalesce({p}, array())" for p in parts)
    placed = observations.where("encounter.reference_id_aa IS NOT NULL")
    rows = spread_structs(placed, [ENCOUNTER], f"concat({facts})", "kind")
    score = "vote" if majority else "CASE WHEN vote > 0 THEN 1 END"
    summed = rows.groupBy("encounter_id").agg(*[
        F.expr(f"sum(CASE WHEN kind = '{kind}' AND label = {text(label)} THEN {score} END) AS _{i}")
        for i, (kind, label) in enumerate(vocabulary)
    ])

    def present(kind: str) -> str:
        hits = [
            f"CASE WHEN _{i} > 0 THEN {text(label)} END"
            for i, (k, label) in enumerate(vocabulary) if k == kind
        ]
        return f"array_compact(CAST(array({', '.join(hits)}) AS ARRAY<STRING>)) AS {kind}s"

    return summed.selectExpr(
        "encounter_id", present("symptom"), present("lab"), present("classifier")
    )
