import datetime as dt
import gzip
import json
import uuid

import pytest

from cohortloom import schemas
from cohortloom.sources import extracts, idmaps, ndjson, notes, snapshots


def test_extract_strings_blanks_and_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,NOTE,X\n001,"two\nlines, ""quoted""",NA\n2,null,\n')
    rows = extracts.read_extract(spark, str(tmp_path), ["ID", "NOTE", "X"]).orderBy("ID").collect()
    assert [tuple(r) for r in rows] == [("001", 'two\nlines, "quoted"', None), ("2", None, None)]


def test_extract_glob_selects_by_name_and_keeps_position(spark, tmp_path):
    for i in (1, 2):
        body = "\n".join(f"{i}{n},x" for n in range(3))
        (tmp_path / f"{i}_Diagnosis.csv").write_text(f"ID,OTHER\n{body}\n")
    (tmp_path / "other.csv").write_text("Z\n9\n")
    df = extracts.read_extract(
        spark, f"{tmp_path}/*Diagnosis.csv", ["ID"], position=True, splittable=True
    )
    ordered = [r["ID"] for r in df.orderBy(*extracts.POSITION).collect()]
    assert ordered == ["10", "11", "12", "20", "21", "22"]
    with pytest.raises(ValueError):
        extracts.read_extract(spark, f"{tmp_path}/*Diagnosis.csv", ["MISSING"])


def test_extract_files_are_aligned_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,2\n")
    (tmp_path / "b.csv").write_text("B,X,A\n4,9,3\n")
    (tmp_path / "empty.csv").write_text("")
    read = extracts.read_extract(spark, str(tmp_path), ["A", "B"], position=True)
    assert sorted((r["A"], r["B"]) for r in read.collect()) == [("1", "2"), ("3", "4")]
    with pytest.raises(ValueError, match="X"):
        extracts.read_extract(spark, str(tmp_path), ["A", "X"])


def note_json(n):
    mention = {"begin": 0, "end": 3, "text": "dry", "polarity": 0, "conceptAttributes": [
        {"code": "1", "cui": "C1", "tui": "T1", "codingScheme": "SNOMEDCT_US"}]}
    return json.dumps({"PATIENT_NUM": f"p{n}", "ENCOUNTER_NUM": f"e{n}",
                       "START_DATE": "2021-01-01 08:00", "OBSERVATION_BLOB": {"SignSymptomMention": [mention]}})


def test_ndjson_rows_and_rejects_add_up(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text("\n".join([note_json(0), "{broken", note_json(1)]) + "\n")
    with gzip.open(tmp_path / "b.json.gz", "wt") as f:
        f.write(note_json(2) + "\nnot json\n")
    rows, rejects = ndjson.read_ndjson(spark, str(tmp_path), schemas.ANNOTATED_NOTE)
    assert sorted(r["ENCOUNTER_NUM"] for r in rows.collect()) == ["e0", "e1", "e2"]
    assert sorted(r["value"] for r in rejects.collect()) == ["not json", "{broken"]
    assert rows.count() + rejects.count() == 5


def test_routing_by_file_name(spark, tmp_path):
    stem = str(uuid.uuid4())
    for name in ("a.NDJSON", "b.gz", f"{stem}.txt", "notes.txt", "c.csv"):
        (tmp_path / name).write_text("x")
    kinds = {r["path"].split("/")[-1]: r["kind"] for r in ndjson.list_inputs(spark, str(tmp_path)).collect()}
    assert kinds == {"a.NDJSON": "ndjson", "b.gz": "ndjson", f"{stem}.txt": "dated_text",
                     "notes.txt": "unrecognised", "c.csv": "unrecognised"}


def expected_notes(lines):
    """The note rules, line by line."""
    out, date, body = [], "1900-01-01", []
    for line in [*[x.rstrip() for x in lines], None]:
        header = line is not None and len(line) >= 10 and line[:4].isdigit() and line[4] == "-" \
            and line[5:7].isdigit() and line[7] == "-" and line[8:10].isdigit()
        if header or line is None:
            text = "".join("\n" + b for b in body)
            if len(text) > 1:
                out.append((date, text))
            date, body = line, []
        else:
            body.append(line)
    return sorted(out)


def test_dated_notes(spark, tmp_path):
    stem = str(uuid.uuid4())
    lines = ["before any date", "2020-01-02 ward  ", "first", "  second  ", "2020-01-03", "",
             "2020-02-30x", "kept last line"]
    (tmp_path / f"{stem}.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "ignored.txt").write_text("2020-01-01\nnot a uuid\n")
    got = notes.segment_notes(notes.read_note_lines(spark, str(tmp_path))).collect()
    assert {r["patient_uuid"] for r in got} == {stem}
    assert sorted((r["note_date"], r["text"]) for r in got) == expected_notes(lines)
    assert all(r["encounter"] is None for r in got)


def test_dated_notes_do_not_depend_on_splits(spark, tmp_path):
    stem = str(uuid.uuid4())
    lines = []
    for n in range(3000):
        lines.append(f"2020-{n % 12 + 1:02d}-{n % 28 + 1:02d} visit {n}" if n % 7 == 3 else f"line {n} " + "x" * 40)
    (tmp_path / f"{stem}.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        read = notes.read_note_lines(spark, str(tmp_path))
        assert read.select("src_block").distinct().count() > 5
        got = sorted((r["note_date"], r["text"]) for r in notes.segment_notes(read).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == expected_notes(lines)


def document(encounter, attachments, category="clinical-note"):
    system = "http://hl7.org/fhir/us/core/CodeSystem/us-core-documentreference-category"
    return json.dumps({
        "resourceType": "DocumentReference", "subject": {"reference": "Patient/" + "p" * 36},
        "date": "2021-03-04T00:00:00Z", "category": [{"coding": [{"system": system, "code": category}]}],
        "content": [{"attachment": a} for a in attachments],
        "context": {"encounter": [{"reference": encounter}]},
    })


def test_document_notes_inline_linked_and_skipped(spark, tmp_path):
    docs = [
        document("Encounter/" + "a" * 36, [
            {"contentType": "text/plain", "data": "aGk="}, {"contentType": "image/png", "data": "eA=="},
            {"contentType": "text/plain", "url": "/n/1"}, {"contentType": "text/plain", "url": "/n/none"}]),
        document("Encounter/" + "b" * 36, [{"contentType": "text/plain", "data": "aGk="}], "other"),
    ]
    (tmp_path / "d.ndjson").write_text("\n".join(docs))
    rows, rejects = ndjson.read_ndjson(spark, str(tmp_path), schemas.RESOURCES["DocumentReference"])
    files = spark.createDataFrame([("/n/1", "from file")], "path string, text string")
    got = notes.document_notes(rows, files).collect()
    assert sorted((r["encounter"], r["patient_uuid"], r["note_date"], r["text"]) for r in got) == [
        ("Encounter/" + "a" * 36, "p" * 36, "2021-03-04", "from file"),
        ("Encounter/" + "a" * 36, "p" * 36, "2021-03-04", "hi"),
    ]
    assert rejects.count() == 0
    missing = notes.document_note_rejects(rows, files).collect()
    assert [r["url"] for r in missing] == ["/n/none"]
    assert {r["url"] for r in notes.document_note_rejects(rows, files.limit(0)).collect()} == {"/n/1", "/n/none"}


@pytest.mark.parametrize("max_files", [1, 100])
def test_only_named_files_are_opened(spark, tmp_path, max_files):
    root = tmp_path / "notes"
    (root / "sub").mkdir(parents=True)
    for name in ("a.txt", "sub/b.txt", "never named.txt"):
        (root / name).write_bytes(f"text of {name}\né".encode())
    urls = ["a.txt", "sub/b.txt", f"{root}/a.txt", f"file://{root}/sub/b.txt", "missing.txt", "/elsewhere/a.txt"]
    docs = [document("Encounter/" + "a" * 36, [{"contentType": "text/plain", "url": u} for u in urls])]
    (tmp_path / "d.ndjson").write_text("\n".join(docs))
    rows, _ = ndjson.read_ndjson(spark, str(tmp_path / "d.ndjson"), schemas.RESOURCES["DocumentReference"])
    files = notes.linked_texts(rows, str(root), max_files)
    assert {r["path"]: r["text"] for r in files.collect()} == {
        u: f"text of {'a.txt' if u.endswith('a.txt') else 'sub/b.txt'}\né" for u in urls[:4]}
    assert notes.document_notes(rows, files).count() == 4
    assert {r["url"] for r in notes.document_note_rejects(rows, files).collect()} == set(urls[4:])
    assert notes.linked_texts(rows.limit(0), str(root)).count() == 0


def test_id_maps(spark, tmp_path):
    cohort = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "K string")
    first = idmaps.cohort_id_map(cohort, "K", "Patient", "s")
    assert first.count() == 2
    path = str(tmp_path / "m")
    idmaps.save_id_map(first, path)
    more = spark.createDataFrame([("3",), ("2",)], "K string")
    idmaps.save_id_map(idmaps.cohort_id_map(more, "K", "Patient", "s"), path)
    loaded = idmaps.load_id_map(spark, path)
    assert sorted(r["source_id"] for r in loaded.collect()) == ["1", "2"]
    extended = idmaps.extend_id_map(loaded, more, "K", "Patient", "s")
    assert sorted(r["source_id"] for r in extended.collect()) == ["1", "2", "3"]
    for indent in (None, 1):
        (tmp_path / "old.json").write_text(json.dumps({"7": "u7", "8": "u8"}, indent=indent))
        old = idmaps.import_json_id_map(spark, str(tmp_path / "old.json"))
        assert sorted(map(tuple, old.collect())) == [("7", "u7"), ("8", "u8")]
    (tmp_path / "none.json").write_text("{}")
    assert idmaps.import_json_id_map(spark, str(tmp_path / "none.json")).count() == 0


def test_crashed_map_write_leaves_no_map(spark, tmp_path):
    path = str(tmp_path / "m")
    (tmp_path / "m" / "map-crashed" / "_temporary").mkdir(parents=True)
    (tmp_path / "m" / "published" / "_temporary").mkdir(parents=True)
    with pytest.raises(ValueError, match="no id map"):
        idmaps.load_id_map(spark, path)
    keys = spark.createDataFrame([("1",)], "K string")
    assert idmaps.save_id_map(idmaps.cohort_id_map(keys, "K", "Patient", "s"), path)
    assert idmaps.load_id_map(spark, path).count() == 1


def test_two_writers_of_a_map(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    one, two = (spark.createDataFrame([(k, k)], idmaps.SCHEMA) for k in "ab")
    assert idmaps.save_id_map(one, path)
    monkeypatch.setattr(idmaps, "has_id_map", lambda *_: False)  # looked before the first one published
    assert not idmaps.save_id_map(two, path)
    assert [r["uuid"] for r in idmaps.load_id_map(spark, path).collect()] == ["a"]


def test_interrupted_snapshot_is_not_read_and_is_replaced(spark, tmp_path):
    table = str(tmp_path / "t")
    assert snapshots.write_snapshot(spark.range(3), table) == 0
    spark.range(99).write.parquet(f"{table}/version=1")  # no history row followed
    assert snapshots.read_snapshot(spark, table).count() == 3
    assert snapshots.write_snapshot(spark.range(7), table) == 1
    assert snapshots.read_snapshot(spark, table).count() == 7
    changes = snapshots.snapshot_changes(spark, table, 0, 1)
    assert sorted((r["id"], r["change"], r["n"]) for r in changes.collect()) == [(k, "added", 1) for k in range(3, 7)]
    assert {r["change"] for r in snapshots.snapshot_changes(spark, table, 1, 0).collect()} == {"removed"}


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda n: dt.datetime(2022, 5, n, tzinfo=dt.timezone.utc)
    for n in range(3):
        assert snapshots.write_snapshot(spark.range(10 * (n + 1)), path, day(n + 1)) == n
    assert snapshots.read_snapshot(spark, path).count() == 30
    assert snapshots.read_snapshot(spark, path, 0).count() == 10
    assert snapshots.restore_timestamp(spark, path, "2022-05-02 12:00:00", day(9)) == 3
    assert snapshots.read_snapshot(spark, path).count() == 20
    assert snapshots.restore_version(spark, path, 2) == 4
    history = snapshots.snapshot_history(spark, path).orderBy("version").collect()
    assert [(r["version"], r["source_version"], r["rows"]) for r in history] == [
        (0, 0, 10), (1, 1, 20), (2, 2, 30), (3, 1, 20), (4, 2, 30)]
    live = [r["file"] for r in snapshots.manifest(spark, path).collect()]
    assert live and all("version=2/" in f for f in live)
    snapshots.write_manifest(spark, path, str(tmp_path / "manifest"))
    assert spark.read.text(str(tmp_path / "manifest")).count() == len(live)
    with pytest.raises(ValueError):
        snapshots.restore_version(spark, path, 99)
