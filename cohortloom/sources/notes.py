"""Dated note files: ``<uuid>.txt`` with date lines between notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import fixed_values as fv
from cohortloom.functions import scalars
from cohortloom.functions.codes import text
from cohortloom.session import settled, shared_folder
from cohortloom.sources.ndjson import DATED_TEXT, read_lines
from cohortloom.sources.positions import POSITION
from cohortloom.sources.records import gather


def read_note_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the dated note files below ``path`` with their patient (the file stem)."""
    lines = read_lines(spark, path, DATED_TEXT)
    name = F.element_at(F.split("src_file", "/"), -1)
    return lines.select(
        F.get(F.split(name, "[.]"), F.lit(0)).alias("patient_uuid"),
        F.col("value").alias("line"),
        *POSITION,
    )


def segment_notes(lines: DataFrame) -> DataFrame:
    """Cut each file into notes at its date lines.

    Input: ``patient_uuid``, ``line`` and the position columns. Output: one row per note
    with ``patient_uuid``, NULL ``encounter``, ``note_date`` (the whole date line, or the
    undated marker for text before the first one) and ``text`` (a line feed before every
    line). Notes of at most one character are dropped.

    Notes are put together in two levels, within a split and then over neighbouring splits, so no
    task orders more than one split and no group holds more lines than a split has, however long
    a file or a note is.
    """
    pieces = lines.selectExpr(
        "patient_uuid", *POSITION, r"regexp_replace(line, '[\\s\\p{Z}]+$', '') AS value"
    ).withColumn("starts", F.expr(f"value RLIKE {text(fv.NOTE_HEADER)}"))
    notes = gather(pieces, "\n", ["patient_uuid"]).selectExpr(
        "patient_uuid", r"IF(number > 0, substring_index(value, '\n', 1), NULL) AS header", "value")
    return notes.selectExpr(
        "patient_uuid",
        "CAST(NULL AS STRING) AS encounter",
        f"coalesce(header, '{fv.UNDATED_NOTE}') AS note_date",
        r"IF(header IS NULL, concat('\n', value), substring(value, length(header) + 1)) AS text",
    ).where("length(text) > 1")


def note_context(patient: str, encounter: str, date: str) -> list[str]:
    """Context columns of a note: encounter reference, patient id, day."""
    return [
        f"concat('Encounter/', right({encounter}, 36)) AS encounter",
        f"right({patient}, 36) AS patient_uuid",
        f"{scalars.day(date)} AS note_date",
    ]


NO_FILES = "path string, text string"


def document_notes(documents: DataFrame, files: DataFrame) -> DataFrame:
    """Clinical notes held in DocumentReference resources, one row per text attachment.

    Keeps documents with a clinical-note category and attachments of plain text. The text
    is the attachment's base64 data, else the file at its url, looked up in ``files``
    (path, text), which ``linked_texts`` reads. Attachments with neither are in ``document_note_rejects``.
    """
    keep = ["encounter", "patient_uuid", "note_date", "attachment_pos"]
    notes = _text_attachments(documents)
    inline = notes.where("data IS NOT NULL").selectExpr(*keep, f"{scalars.decode_note('data')} AS text")
    # Only attachments without data are joined: the others would all meet in the partition
    # of the NULL path, texts included.
    found = notes.where("data IS NULL").join(files.selectExpr("path AS url", "text"), "url").where("text IS NOT NULL")
    return inline.unionByName(found.select(*keep, "text"))


def linked_texts(documents: DataFrame, root: str, max_files: int = 10_000) -> DataFrame:
    """(path, text) of the files that attachments without data name, for ``document_notes``.

    ``path`` is the url as given: a path or url below the folder ``root``, or a name relative to it.
    The folder is listed once, without contents, and only listed files that are named are opened.
    Their names are dealt into batches of about ``max_files`` by hash; Spark packs the files of a
    batch into tasks by size, and texts go to the shared folder, so the driver holds one batch of
    names at a time. Named files that do not exist are left to ``document_note_rejects``.
    """
    spark, base = documents.sparkSession, root.rstrip("/")
    urls = _text_attachments(documents).where("data IS NULL AND url IS NOT NULL").select("url").distinct()
    full = F.when(F.col("url").rlike(r"^(\w+:)?/"), F.col("url")).otherwise(F.concat(F.lit(f"{base}/"), F.col("url")))
    wanted = urls.withColumn("key", _plain(full))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select("path")
    met = settled(listed.withColumn("key", _plain(F.col("path"))).join(wanted.select("key").distinct(), "key", "left_semi"))
    batches = -(-met.count() // max_files)
    folder = shared_folder(spark)
    for k in range(batches):
        names = [r["path"] for r in met.where(F.pmod(F.xxhash64("key"), F.lit(batches)) == k).select("path").collect()]
        if names:
            contents = spark.read.format("binaryFile").load(names)
            contents.select(_plain(F.col("path")).alias("key"), F.decode("content", "UTF-8").alias("text")).write.mode("append").parquet(folder)
    if not batches:
        return spark.createDataFrame([], NO_FILES)
    texts = spark.read.schema("key string, text string").parquet(folder)
    return wanted.join(texts, "key").select(F.col("url").alias("path"), "text")


def _plain(path):
    """A path with its scheme, if any, in front of one slash; the local scheme is left out."""
    return F.regexp_replace(F.regexp_replace(path, r"^(\w+):/+", "$1:/"), "^file:", "")


def document_note_rejects(documents: DataFrame, files: DataFrame) -> DataFrame:
    """(encounter, patient_uuid, note_date, attachment_pos, url) of text attachments without a text."""
    known = files.where("text IS NOT NULL").selectExpr("path AS url")
    return _text_attachments(documents).where("data IS NULL").drop("data").join(known, "url", "left_anti")


def _text_attachments(documents: DataFrame) -> DataFrame:
    """Plain-text attachments of clinical notes with their note context, data and url."""
    is_note = (
        "resourceType = 'DocumentReference' AND exists(category.coding, cs -> exists(cs,"
        f" c -> c.system = {text(fv.DOCUMENT_CATEGORY)} AND c.code = 'clinical-note'))"
    )
    context = note_context("subject.reference", "get(context.encounter.reference, 0)", "date")
    attachments = "filter(content.attachment, a -> a.contentType = 'text/plain')"
    keep = ["encounter", "patient_uuid", "note_date", "attachment_pos"]
    return (
        documents.where(is_note)
        .selectExpr(*context, f"posexplode({attachments}) AS (attachment_pos, attachment)")
        .where("encounter IS NOT NULL")
        .selectExpr(*keep, "attachment.data AS data", "attachment.url AS url")
    )
