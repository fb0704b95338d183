"""Records over splits: quoted CSV, a JSON map and dated notes, each cut into many splits."""

import csv
import io
import json
import random
import uuid

import pytest

from cohortloom.sources import extracts, idmaps, notes


@pytest.fixture(params=["134217728", "2000"])
def split_bytes(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield int(request.param)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


PARTS = ["a", "note", "\n", "\n\n", ",", '"', '","', '"\n', '5" x', "é", "\r\n", "\r", " ", ",\n", "long " * 30]


def test_quoted_csv_in_splits(spark, tmp_path, split_bytes):
    rng, rows = random.Random(3), {}
    for name, end in (("a", "\n"), ("b", "\r\n")):
        made = [(f"{name}{k}", "".join(rng.choices(PARTS, k=rng.randint(0, 12))), f"x{k}") for k in range(250)]
        made[100] = (f"{name}100", 'every line\n"quoted", or\nnot\n' * 200, "")
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=end)
        writer.writerows([("ID", "TEXT", "X"), *made])
        (tmp_path / f"{name}.csv").write_bytes(out.getvalue().encode())
        rows[name] = made
    read = extracts.read_extract(spark, str(tmp_path), ["ID", "TEXT", "X"], position=True, na_tokens=[])
    got = read.orderBy(*extracts.POSITION).collect()
    assert [(r["ID"], r["TEXT"], r["X"]) for r in got] == [(i, t or None, x or None) for i, t, x in rows["a"] + rows["b"]]
    assert (len({(r["src_file"], r["src_block"]) for r in got}) > 10) == (split_bytes < 10_000)


def test_quotes_that_are_ordinary_characters(spark, tmp_path, split_bytes):
    lines = ["ID,A,B"]
    for k in range(200):
        lines += [f'{k},5" tube,x', f'{k},6"" tube,"two\nlines"', f'{k},a"b"c,', f'{k},"closed" and more,y', f'{k},"","""q"""']
    (tmp_path / "a.csv").write_text("\n".join(lines))  # no line feed at the end
    got = extracts.read_extract(spark, str(tmp_path), ["ID", "A", "B"], na_tokens=[]).collect()
    assert len(got) == 1000
    assert {r["B"] for r in got} == {"x", "two\nlines", None, "y", '"q"'}


def test_blank_lines_and_a_quote_left_open(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,A\n1,x\n\n\r\n2,"never\nclosed\n')
    (tmp_path / "b.csv").write_text("ID,A\n")
    (tmp_path / "c.csv").write_text("")
    got = extracts.read_extract(spark, str(tmp_path), ["ID", "A"]).collect()
    assert sorted((r["ID"], r["A"].rstrip("\n")) for r in got) == [("1", "x"), ("2", "never\nclosed")]


def test_lines_are_scanned_and_moved_in_splits(spark, tmp_path):
    """One exchange of the lines by split, reused by both levels; no task reads a whole file."""
    body = "".join(f'{k},"line\n{k}"\n' for k in range(3000))
    (tmp_path / "a.csv").write_text("ID,A\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = extracts.quoted_records(spark, str(tmp_path))
        assert rows.where("NOT is_header").count() == 3000
        lines = extracts.with_position(spark.read.text(str(tmp_path)))
        assert lines.rdd.getNumPartitions() >= 8
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan
        assert plan.count("FileScan text") <= 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


KEYS = ["plain", 'a "quoted" key', "comma, inside", "back\\slash", 'both \\", x', "{brace}", "}", "é\n\t", "", "\\\\", '","', '\\"']


@pytest.mark.parametrize("indent", [None, 1])
def test_json_map_in_splits(spark, tmp_path, split_bytes, indent):
    rng = random.Random(5)
    known = {"".join(rng.choices(KEYS, k=2)) + str(k): f"u,{k}" for k in range(400)} | {k: "plain" for k in KEYS}
    (tmp_path / "map.json").write_text(json.dumps(known, indent=indent))
    got = idmaps.import_json_id_map(spark, str(tmp_path / "map.json")).collect()
    assert len(got) == len(known) and {r["source_id"]: r["uuid"] for r in got} == known


def test_json_map_errors_and_repeats(spark, tmp_path):
    (tmp_path / "twice.json").write_text('{"a": "1", "b": "2", "a": "3"}')
    got = idmaps.import_json_id_map(spark, str(tmp_path / "twice.json")).collect()
    assert sorted(map(tuple, got)) == [("a", "3"), ("b", "2")]
    for bad in ('{"a": "1" "b": "2"}', '{"a"}', '{"a": "1", x}'):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(Exception, match="not an entry"):
            idmaps.import_json_id_map(spark, str(tmp_path / "bad.json")).collect()


def test_one_note_over_many_splits(spark, tmp_path, split_bytes):
    stem = str(uuid.uuid4())
    long_note = [f"line {k} of a note without end" for k in range(2000)]
    lines = ["2020-01-01 first", *long_note, "2020-01-02", "short", *[f"2020-02-{k:02d}" for k in range(1, 29)], *long_note]
    (tmp_path / f"{stem}.txt").write_text("\n".join(lines) + "\n")
    got = notes.segment_notes(notes.read_note_lines(spark, str(tmp_path))).collect()
    whole = "".join(f"\n{x}" for x in long_note)
    assert sorted((r["note_date"], r["text"]) for r in got) == [
        ("2020-01-01 first", whole), ("2020-01-02", "\nshort"), ("2020-02-28", whole)]


def test_a_file_without_any_date_is_one_note(spark, tmp_path, split_bytes):
    stem = str(uuid.uuid4())
    lines = [f"line {k}" for k in range(3000)]
    (tmp_path / f"{stem}.txt").write_text("\n".join(lines))
    got = notes.segment_notes(notes.read_note_lines(spark, str(tmp_path))).collect()
    assert [(r["patient_uuid"], r["note_date"], r["text"]) for r in got] == [(stem, "1900-01-01", "".join(f"\n{x}" for x in lines))]
