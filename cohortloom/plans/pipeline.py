"""Extracts to stored tables, end to end.

The tables are written once and read by every report: a report then scans only the
columns it names, and no report repeats the id joins and deduplication. Whatever a stage
does not map is stored as well, as rejects of that stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions import fixed_values as fv
from cohortloom.functions import scalars
from cohortloom.operators import mentions, resources
from cohortloom.operators.annotate import to_stored
from cohortloom.operators.dedup import cap_rows
from cohortloom.session import settled
from cohortloom.sources.catalog import register_tables
from cohortloom.sources.idmaps import has_id_map, load_id_map, rows_filtered_by_maps, save_id_map
from cohortloom.sources.publish import last_published, publish

TABLES = {
    "patient": "Patient",
    "condition": "Condition",
    "observation": "Observation",
    "documentreference": "DocumentReference",
    "encounter": "Encounter",
    "medicationstatement": "MedicationStatement",
    "procedure": "Procedure",
}
ID_MAPS = {
    "patient_mapping": ("Patient", resources.PATIENT),
    "encounter_mapping": ("Encounter", resources.ENCOUNTER),
}

#: Scans from which rows of no cohort are dropped before they are exchanged.
LEAST_SCAN = "32m"


def assign_ids(cohort: DataFrame, folder: str, salt: str) -> bool:
    """Publish the patient and encounter maps of a note cohort, unless the folder has them.

    The cohort is scanned once for both. Returns whether both maps were made from it.
    """
    spark, root = cohort.sparkSession, folder.rstrip("/")
    if all(has_id_map(spark, f"{root}/{name}") for name in ID_MAPS):
        return False
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("map"), F.col(key).alias("source_id")) for name, (_, key) in ID_MAPS.items()
    ]))
    keys = settled(cohort.select(pairs.alias("k")).select("k.*").where("source_id IS NOT NULL").distinct())
    made = [
        save_id_map(keys.where(F.col("map") == name).selectExpr(
            "source_id", f"{scalars.pseudonym(kind, 'source_id', salt)} AS uuid"), f"{root}/{name}")
        for name, (kind, _) in ID_MAPS.items()
    ]
    return all(made)


def load_ids(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The published patient and encounter maps."""
    patients, encounters = (load_id_map(spark, f"{folder.rstrip('/')}/{name}") for name in ID_MAPS)
    return patients, encounters


def write_tables(
    frames: Mapping[str, DataFrame], folder: str, leave_out: Mapping[str, Sequence[str]] | None = None,
    rejects: Mapping[str, DataFrame] | None = None,
) -> None:
    """Write resources as stored tables, flattened and annotated, and rejects by stage.

    Columns that ``leave_out`` lists by table are neither computed nor written. All tables of
    a run become visible together, by one last write. The writes are independent jobs and
    are submitted together, so that one's last tasks overlap the next one's first.
    """
    name_of_run, root = f"tables-{uuid.uuid4().hex}", folder.rstrip("/")
    tables = {
        name: to_stored(df, TABLES[name]).drop(*(leave_out or {}).get(name, ())) for name, df in frames.items()
    } | {f"reject_{stage}": df for stage, df in (rejects or {}).items()}

    def write(name: str) -> None:
        tables[name].write.option("compression", "zstd").parquet(f"{root}/{name_of_run}/{name}")

    session = next(iter(frames.values())).sparkSession
    with ThreadPoolExecutor(len(TABLES)) as pool:
        list(pool.map(inheritable_thread_target(session)(write), tables))
    publish(session, folder, name_of_run)


def _published(spark: SparkSession, folder: str) -> str:
    name = last_published(spark, folder)
    if name is None:
        raise ValueError(f"no tables were published in {folder}")
    return f"{folder.rstrip('/')}/{name}"


def read_tables(
    spark: SparkSession, folder: str, names: Sequence[str] = ("patient", "condition", "observation", "documentreference", "encounter"),
) -> dict[str, DataFrame]:
    """The last published tables with their declared schemas, without columns left out of them."""
    root, out = _published(spark, folder), {}
    for name in names:
        present = set(spark.read.parquet(f"{root}/{name}").columns)
        schema = T.StructType([f for f in schemas.stored(TABLES[name]) if f.name in present])
        out[name] = spark.read.schema(schema).parquet(f"{root}/{name}")
    return out


def register_store(spark: SparkSession, folder: str, database: str) -> None:
    """The last published tables as ``database.patient`` and so on, for reports in SQL."""
    root = _published(spark, folder)
    register_tables(spark, database, {name: (f"{root}/{name}", df.schema) for name, df in read_tables(spark, folder).items()})


def read_rejects(spark: SparkSession, folder: str, stage: str) -> DataFrame:
    """What a stage of the last published run did not map."""
    return spark.read.parquet(f"{_published(spark, folder)}/reject_{stage}")


def build_store(
    extracts: Mapping[str, DataFrame],
    annotated: DataFrame,
    folder: str,
    salt: str,
    *,
    order: Mapping[str, Sequence[str]],
    classifiers: Mapping[str, DataFrame],
    types: Mapping[str, str] = fv.DEFAULT_MENTION_TYPES,
    leave_out: Mapping[str, Sequence[str]] | None = None,
    rejects: Mapping[str, DataFrame] | None = None,
    row_cap: int = 0,
    own_maps: bool = False,
) -> None:
    """Map all extracts and write the stored tables.

    ``extracts`` holds the five warehouse extracts by name, ``annotated`` the annotated
    notes (natural keys already replaced), ``classifiers`` the predictions per version tag,
    and ``order`` the first-seen order columns of ``note_cohort``, ``diagnosis``,
    ``classifier_results`` and ``annotated``. Mentions of every type in ``types`` go to the
    table of the resource it maps to. ``rejects`` are those of earlier stages by name, such
    as unparsed lines; mentions without codes are added. ``row_cap`` keeps the first rows of
    every mapped extract by id; 0 keeps all. ``own_maps`` says that the id maps in ``folder`` were
    made earlier from these very notes with this salt, so that the texts meet no map.
    """
    notes = extracts["note_cohort"]
    own = assign_ids(notes, folder, salt) or own_maps
    patients, encounters = load_ids(notes.sparkSession, folder)
    with rows_filtered_by_maps(notes.sparkSession, encounters.count(), LEAST_SCAN):
        # Exploded once, for the mapped tables and the rejects.
        usable, uncoded = mentions.usable_mentions(settled(mentions.explode_mentions(annotated, types, order["annotated"])))
        kinds = [kind for kind in mentions.KINDS if kind in types.values()]
        # Ranked once for all tables of mentions.
        first = settled(mentions.first_mentions(usable, order["annotated"]))
        found = {kind: mentions.map_mentions(first, kind, salt) for kind in kinds}
        mapped = {
            "Patient": [resources.map_patient(extracts["patient_dimension"], patients)],
            "Condition": [resources.map_condition(extracts["diagnosis"], patients, encounters, salt, order["diagnosis"])],
            "Observation": [resources.map_lab_observation(extracts["lab_cohort"], patients, encounters, salt)],
            "DocumentReference": [resources.map_document_reference(
                notes, salt, order["note_cohort"], None if own else (patients, encounters))],
            "Encounter": [resources.map_encounter(extracts["visit_dimension"], patients, encounters, salt)],
            "MedicationStatement": [],
            "Procedure": [],
        }
        for tag, results in classifiers.items():
            predictions = resources.first_predictions(results, order["classifier_results"])
            mapped["Observation"].append(resources.map_classifier(
                notes, predictions, patients, encounters, salt, order["note_cohort"], tag
            ))
        frames = {}
        for name, kind in TABLES.items():
            parts = [cap_rows(df, row_cap, ["id"]) for df in [*mapped[kind], *([found[kind]] if kind in found else [])]]
            whole = parts[0] if parts else notes.sparkSession.createDataFrame([], schemas.RESOURCES[kind])
            for part in parts[1:]:
                whole = whole.unionByName(part)
            frames[name] = whole
        write_tables(frames, folder, leave_out, {**(rejects or {}), "mentions": uncoded})
