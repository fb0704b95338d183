"""Note annotations to clinical resources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import codes, scalars
from cohortloom.functions import fixed_values as fv
from cohortloom.functions import nested as n
from cohortloom.functions.codes import text
from cohortloom.operators.dedup import first_per_key
from cohortloom.operators.resources import ENCOUNTER_REF, SUBJECT_REF
from cohortloom.sources.idmaps import attach

MENTION_POSITION = ["sem_pos", "mention_pos"]
MENTION_KEY = ("encounter_uuid", "cui")
KINDS = ("Observation", "MedicationStatement", "Condition", "Procedure")


def annotate_notes(
    notes: DataFrame,
    annotations: DataFrame,
    key: str,
    patients: DataFrame,
    encounters: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Replace natural keys by ids and attach each note's annotation.

    ``annotations`` is (key, OBSERVATION_BLOB map); a note without one gets an empty map.
    Returns annotated notes and the rows whose patient or encounter has no id. Note texts
    take no part in the joins.
    """
    slim = notes.drop("OBSERVATION_BLOB")
    placed = attach(
        attach(slim, patients, "PATIENT_NUM", "patient_uuid", "left"),
        encounters, "ENCOUNTER_NUM", "encounter_uuid", "left",
    )
    mapped = "patient_uuid IS NOT NULL AND encounter_uuid IS NOT NULL"
    blob_type = schemas.ANNOTATIONS.simpleString()
    others = [c for c in slim.columns if c not in ("PATIENT_NUM", "ENCOUNTER_NUM")]
    annotated = placed.where(mapped).join(
        annotations.select(key, "OBSERVATION_BLOB"), key, "left"
    ).selectExpr(
        "patient_uuid AS PATIENT_NUM", "encounter_uuid AS ENCOUNTER_NUM", *others,
        f"coalesce(OBSERVATION_BLOB, CAST(map() AS {blob_type})) AS OBSERVATION_BLOB",
    )
    rejects = placed.where(f"NOT ({mapped})").select("PATIENT_NUM", "ENCOUNTER_NUM", key)
    return annotated, rejects


def explode_mentions(
    annotated: DataFrame,
    types: Mapping[str, str] = fv.DEFAULT_MENTION_TYPES,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per mention of the listed semantic types, with its note context.

    Unlisted types are cut from the map before the explode. ``order`` columns are carried.
    Notes with an empty map give no row. The outer generators keep the optimizer from
    evaluating the map expression again in inferred non-empty checks.
    """
    wanted = f"map_filter(OBSERVATION_BLOB, (k, v) -> {codes.one_of('k', types)})"
    by_type = annotated.selectExpr(
        "PATIENT_NUM AS patient_uuid", "ENCOUNTER_NUM AS encounter_uuid",
        f"{scalars.day('START_DATE')} AS note_date", *order,
        f"posexplode_outer({wanted}) AS (sem_pos, sem_type, mentions)",
    )
    return by_type.selectExpr(
        "patient_uuid", "encounter_uuid", "note_date", *order, "sem_pos",
        f"{codes.lookup('sem_type', types)} AS resource_type",
        "posexplode_outer(mentions) AS (mention_pos, mention)",
    ).where("mention IS NOT NULL").withColumn(
        "cui", F.expr("get(mention.conceptAttributes, 0).cui")
    )


def usable_mentions(mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split off mentions without concept attributes, which carry no code."""
    coded = "coalesce(cardinality(mention.conceptAttributes), 0) > 0"
    return mentions.where(coded), mentions.where(f"NOT ({coded})")


def first_mentions(mentions: DataFrame, order: Sequence[str]) -> DataFrame:
    """First mention of each concept per encounter, across types, whatever its polarity."""
    return first_per_key(mentions, MENTION_KEY, [*order, *MENTION_POSITION])


def mention_codes(mention: str) -> str:
    """Codings of a mention: its concept codes, then the first concept's CUI and TUI."""
    first = f"get({mention}.conceptAttributes, 0)"
    own = n.coding(codes.coding_system("a.codingScheme"), "a.code", f"{mention}.text")
    extra = n.array(
        n.coding(text(fv.CUI_SYSTEM), f"{first}.cui", "'cui'"),
        n.coding(text(fv.TUI_SYSTEM), f"{first}.tui", "'tui'"),
    )
    return f"concat(transform({mention}.conceptAttributes, a -> {own}), {extra})"


def _values(kind: str, salt: str, id_key: Sequence[str]) -> dict[str, str]:
    coded = n.coded(mention_codes("mention"))
    values = {
        "id": scalars.pseudonym(kind, scalars.row_key(id_key), salt),
        "subject": SUBJECT_REF,
        "extension": n.array(n.extension(
            fv.TEXT_POSITION_URL,
            n.inner_extension("begin", valueInteger="mention.begin"),
            n.inner_extension("end", valueInteger="mention.end"),
        )),
        "modifierExtension": n.array(
            n.extension(
                fv.ALGORITHM_URL, n.inner_extension("dateofauthorship", valueDate="note_date")
            ),
            n.extension(fv.POLARITY_URL, valueInteger="mention.polarity"),
        ),
    }
    if kind == "Observation":
        return {**values, "status": "'unknown'", "code": coded, "encounter": ENCOUNTER_REF}
    if kind == "MedicationStatement":
        return {**values, "status": "'unknown'", "medicationCodeableConcept": coded}
    if kind == "Procedure":
        return {**values, "status": "'unknown'", "code": coded}
    if kind == "Condition":
        return {
            **values,
            "category": n.array(n.concept(
                n.fixed_coding(fv.CONDITION_CATEGORY, "problem-list-item", "Problem List Item")
            )),
            "clinicalStatus": n.concept(n.fixed_coding(fv.CONDITION_CLINICAL, "active", "Active")),
            "verificationStatus": n.concept(
                n.fixed_coding(fv.CONDITION_VERIFICATION, "unconfirmed", "Unconfirmed")
            ),
            "code": coded,
        }
    raise ValueError(f"mentions do not map to {kind}")


def map_mentions(
    mentions: DataFrame, kind: str, salt: str, id_key: Sequence[str] = MENTION_KEY
) -> DataFrame:
    """Mentions of one resource type as resources.

    ``id_key`` identifies a mention; add position columns when mentions are not deduplicated.
    """
    rows = mentions.where(f"resource_type = {text(kind)}")
    return n.as_resource(rows, kind, _values(kind, salt, id_key))


def mention_lines(
    mentions: DataFrame, salt: str, id_key: Sequence[str] = MENTION_KEY
) -> DataFrame:
    """(resourceType, value) JSON lines of all mapped types in one pass over the mentions."""
    arms = " ".join(
        f"WHEN {text(kind)} THEN to_json({n.resource_struct(kind, _values(kind, salt, id_key))})"
        for kind in KINDS
    )
    return mentions.selectExpr(
        "resource_type AS resourceType", f"CASE resource_type {arms} END AS value"
    )


def mention_resources(
    annotated: DataFrame,
    kind: str,
    salt: str,
    order: Sequence[str],
    types: Mapping[str, str] = fv.DEFAULT_MENTION_TYPES,
    dedup: bool = True,
) -> DataFrame:
    """Annotated notes to resources of one type, first mention per encounter and concept.

    ``dedup=False`` keeps every mention, so that later votes count all of them.
    """
    usable, _ = usable_mentions(explode_mentions(annotated, types, order))
    if dedup:
        return map_mentions(first_mentions(usable, order), kind, salt)
    return map_mentions(usable, kind, salt, [*MENTION_KEY, *order, *MENTION_POSITION])
