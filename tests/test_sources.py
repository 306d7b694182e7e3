from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from samples import CASES, PAGES, documents, flat_rows, page, record

from tidegate.errors import LandingError
from tidegate.operators.flatten import explode_records, flatten_table
from tidegate.plans.chapters import CHAPTERS
from tidegate.sources import (
    find_run_folder,
    newest_run,
    page_audit,
    page_statistics,
    parse_documents,
    read_documents,
    read_page_files,
    read_sidecar,
    require_complete,
)
from tidegate.spec import Field, OrderBy, ProductSpec


def write_run(folder, documents, **sidecar):
    folder.mkdir(parents=True)
    for number, body in enumerate(documents, start=1):
        text = body if isinstance(body, str) else json.dumps(body, indent=2)
        (folder / f"page_{number:04d}.json").write_text(text)
    (folder / "_ingest_metadata.json").write_text(json.dumps(sidecar))


def test_page_files_and_documents_give_the_same_frame(spark, tmp_path):
    write_run(tmp_path / "run", PAGES)
    files = read_page_files(spark, str(tmp_path / "run"), CHAPTERS)
    texts = read_documents(spark, str(tmp_path / "run"))
    parsed = parse_documents(texts, CHAPTERS)
    assert files.dtypes == parsed.dtypes
    assert sorted(files.collect(), key=lambda r: r["page_no"]) == sorted(
        parsed.collect(), key=lambda r: r["page_no"]
    )
    assert [r["more"] for r in files.orderBy("page_no").collect()] == [True, False]


def test_single_fixture_document_is_page_one(spark, tmp_path):
    (tmp_path / "fixture.json").write_text(json.dumps(PAGES[0], indent=1))
    assert read_documents(spark, str(tmp_path / "fixture.json")).first()["page_no"] == 1


def test_flatten_types_and_normalises(spark):
    rows = {r["source_object_id"]: r for r in flat_rows(spark).collect()}
    assert len(rows) == len(CASES)
    assert (rows[41]["chapter_id"], rows[41]["state"]) == ("O-41", "OR")
    assert (rows[40]["longitude"], rows[40]["latitude"]) == (-120.5, 38.25)
    assert rows[45]["longitude"] is None and rows[44]["latitude"] == 90.5
    assert (rows[46]["city"], rows[51]["city"]) == ("", "Unknown")
    assert rows[40]["ingest_run_id"] == "run_test"


def test_flat_columns(spark):
    assert flat_rows(spark).dtypes == [
        ("chapter_id", "string"),
        ("chapter_name", "string"),
        ("city", "string"),
        ("state", "string"),
        ("longitude", "double"),
        ("latitude", "double"),
        ("source_object_id", "bigint"),
        ("raw_payload", "string"),
        ("ingest_run_id", "string"),
        ("ingested_at_utc", "timestamp"),
    ]


def test_payload_keeps_wrong_values_and_no_personal_data(spark):
    bad = record(7, "CA-7", "CA", x="abc", y=1e2)
    row = flat_rows(spark, [page(bad)]).first()
    assert row["longitude"] is None and row["latitude"] == 100.0
    payload = json.loads(row["raw_payload"])
    assert payload["geometry"]["x"] == "abc"
    assert "Secret Person" not in row["raw_payload"]


def test_payload_keeps_empty_fields(spark):
    row = flat_rows(spark, [page(record(7, "CA-7", "CA", x=None, y=None))]).first()
    assert json.loads(row["raw_payload"])["geometry"] is None


def test_redacted_path_is_dropped_from_payload(spark):
    spec = CHAPTERS.with_changes(
        payload_paths=("attributes.MEVR_RD", "attributes.Extra"), redact=("attributes.MEVR_RD",)
    )
    row = flat_rows(spark, [page(record(7, "CA-7", "CA", Extra="kept"))], spec).first()
    assert "Secret Person" not in row["raw_payload"] and "kept" in row["raw_payload"]


def test_all_null_geometry_empty_array_and_null_element(spark):
    nothing = page(record(1, "CA-1", "CA", x=None, y=None), record(2, "CA-2", "CA", x=None, y=None))
    rows = flat_rows(spark, [nothing, page(), page(None)]).collect()
    assert len(rows) == 3  # the empty page adds none, the null element one
    assert all(r["longitude"] is None for r in rows)


def test_malformed_values_do_not_fail_the_job(spark):
    odd = [
        record("not a number", "CA-1", "CA"),
        {"attributes": {"ChapterID": "CA-2", "State": "CA"}, "geometry": "n/a"},
        {"attributes": 7},
    ]
    rows = flat_rows(spark, [page(*odd)]).collect()
    assert [r["source_object_id"] for r in rows] == [None, None, None]
    assert [r["chapter_id"] for r in rows] == ["CA-1", "CA-2", None]


def test_a_page_is_parsed_once(spark):
    pages = parse_documents(documents(spark), CHAPTERS)
    plan = explode_records(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_flatten_table_addresses_columns(spark):
    spec = ProductSpec(
        fields=(Field("id", "raw_id", "bigint"), Field("label", "label", normalise=("trim", "upper"))),
        key=("id",),
        order=(OrderBy("label"),),
        contract=(("id", "bigint"),),
        redact=("secret",),
    )
    df = spark.createDataFrame([("5", " a ", "s")], "raw_id string, label string, secret string")
    row = flatten_table(df, spec, {"ingest_run_id": F.lit("r")}).first()
    assert (row["id"], row["label"], row["ingest_run_id"]) == (5, "A", "r")
    assert json.loads(row["raw_payload"]) == {"raw_id": "5", "label": " a "}


def audit(spark, pages, first=1):
    return page_audit(page_statistics(documents(spark, pages, first), CHAPTERS)).first()


def test_audit_of_a_complete_run(spark):
    row = audit(spark, PAGES)
    assert (row["pages"], row["rows_in"], row["is_complete"]) == (2, len(CASES), True)
    require_complete(row)
    require_complete(audit(spark, [PAGES[0], page(more=True)]))  # an empty page ends the paging


@pytest.mark.parametrize(
    ("pages", "first", "message"),
    [
        ([page(), page()], 1, "no record on any page"),
        ([{"error": {"code": 400}}], 1, "error payload"),
        ([PAGES[0], {"error": {"code": 400}, "features": []}], 1, "error payload"),
        ([{"something": 1}], 1, "no record array"),
        (["{broken"], 1, "no record array"),
        ([page(9)], 1, "no record array"),
        ([PAGES[0]], 1, "says there is more"),
        ([PAGES[1], PAGES[1]], 1, "gaps"),
        ([PAGES[0], PAGES[1]], 2, "gaps"),
    ],
)
def test_audit_refuses(spark, pages, first, message):
    with pytest.raises(LandingError, match=message):
        require_complete(audit(spark, pages, first))


def test_audit_finds_repeated_and_missing_page_numbers(spark):
    docs = documents(spark, [PAGES[0], PAGES[0], PAGES[1]])
    for numbers in ([1, 1, 2], [1, 2, 4], [1, 3, 2]):
        renumbered = docs.withColumn(
            "page_no", F.element_at(F.array(*map(F.lit, numbers)), F.col("page_no").cast("int")).cast("long")
        )
        row = page_audit(page_statistics(renumbered, CHAPTERS)).first()
        assert row["is_complete"] is False


def test_audit_by_run(spark):
    docs = documents(spark).withColumn("run_id", F.lit("a")).union(
        documents(spark, [PAGES[0]]).withColumn("run_id", F.lit("b"))
    )
    rows = {r["run_id"]: r for r in page_audit(page_statistics(docs, CHAPTERS), ["run_id"]).collect()}
    assert rows["a"]["is_complete"] is True and rows["b"]["is_complete"] is False


def test_find_run_folder_takes_the_newest_date(spark, tmp_path):
    for day in ("2026-01-01", "2026-01-03", "2026-01-02"):
        write_run(tmp_path / f"ingest_date={day}" / "run_id=r1", PAGES)
    assert "ingest_date=2026-01-03" in find_run_folder(spark, str(tmp_path), "r1")
    with pytest.raises(LandingError):
        find_run_folder(spark, str(tmp_path), "r2")


def test_sidecar(spark, tmp_path):
    described = dict(
        run_id="r1", ingest_date="2026-01-01", ingested_at_utc="2026-01-01T05:00:00+00:00",
        source="live", source_detail="x", where_clause="y", pages=2, rows_in=len(CASES),
    )
    write_run(tmp_path / "run", PAGES, **described)
    run = read_sidecar(spark, str(tmp_path / "run"))
    assert (run.run_id, run.rows_in, run.ingested_at_utc) == ("r1", len(CASES), "2026-01-01T05:00:00+00:00")
    with pytest.raises(LandingError):
        read_sidecar(spark, str(tmp_path))


def test_newest_run(spark):
    runs = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "run_id string, ingest_date int, folder string"
    )
    assert {(r["run_id"], r["folder"]) for r in newest_run(runs).collect()} == {("a", "y"), ("b", "z")}
