"""Random data against brute-force models in plain Python."""

from __future__ import annotations

import json
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import documents, page

from tidegate.lake import Lake
from tidegate.operators.flatten import flatten
from tidegate.operators.ledger import run_ledger
from tidegate.operators.merge import (
    change_report,
    change_totals,
    changes_by_bucket,
    compared_buckets,
    merge_upsert,
)
from tidegate.operators.quarantine import read_quarantine
from tidegate.operators.route import routed
from tidegate.operators.snapshots import SnapshotTable
from tidegate.plans.chapters import CHAPTERS
from tidegate.plans.silver import silver_of, transform
from tidegate.session import scratch_path
from tidegate.sources import page_audit, page_statistics, parse_documents

COMMON = settings(
    deadline=None,
    derandomize=True,
    database=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
COORDINATES = st.sampled_from([None, "abc", "", "12.5", -180, 180, 180.5, -90, 90, 90.25, -91, 0])
RECORDS = st.one_of(
    st.none(),
    st.builds(
        lambda object_id, key, name, city, state, point: {
            "attributes": {
                "OBJECTID": object_id,
                "ChapterID": key,
                "University_Chapter": name,
                "City": city,
                "State": state,
            },
            "geometry": point,
        },
        st.one_of(st.none(), st.integers(0, 9), st.just("seven")),
        st.sampled_from(["A", " A ", "B", "C", None]),
        st.sampled_from(["n1", "n2", None]),
        st.sampled_from(["Bend", "", "  ", "Unknown", " UNKNOWN ", None]),
        st.sampled_from(["CA", " or", "WA ", "NV", None]),
        st.one_of(st.none(), st.builds(lambda x, y: {"x": x, "y": y}, COORDINATES, COORDINATES)),
    ),
)
PAGES = st.lists(st.lists(RECORDS, max_size=6), min_size=1, max_size=4)


def number(value):
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def trimmed(value):
    return None if value is None else str(value).strip(" ")


def nulls_first(value):
    return (value is not None, value if value is not None else "")


def model(pages):
    """Ledger, published rows and the number of rejected rows, one record at a time."""
    ledger = dict.fromkeys(
        ("rows_in", "rows_out_of_scope", "rows_quarantined", "rows_deduped", "rows_warned", "rows_ok"), 0
    )
    groups = {}
    for record in (r for page in pages for r in page):
        ledger["rows_in"] += 1
        attributes = (record or {}).get("attributes") or {}
        point = (record or {}).get("geometry") or {}
        state = trimmed(attributes.get("State"))
        if state is None or state.upper() not in ("CA", "OR", "WA"):
            ledger["rows_out_of_scope"] += 1
            continue
        x, y = number(point.get("x")), number(point.get("y"))
        if x is None or y is None or not -180 <= x <= 180 or not -90 <= y <= 90:
            ledger["rows_quarantined"] += 1
            continue
        object_id = number(attributes.get("OBJECTID"))
        row = (
            trimmed(attributes.get("ChapterID")),
            trimmed(attributes.get("University_Chapter")),
            trimmed(attributes.get("City")),
            state.upper(),
            x,
            y,
            None if object_id is None else int(object_id),
        )
        groups.setdefault(row[0], []).append(row)
    published = []
    for rows in groups.values():
        rows.sort(
            key=lambda r: (
                r[6] is None,
                -(r[6] or 0),
                nulls_first(r[1]),
                nulls_first(r[2]),
                nulls_first(r[3]),
                r[4],
                r[5],
            )
        )
        ledger["rows_deduped"] += len(rows) - 1
        city = rows[0][2]
        warned = city is None or city == "" or city.upper() == "UNKNOWN"
        ledger["rows_warned" if warned else "rows_ok"] += 1
        published.append((*rows[0], "WARNING" if warned else "OK"))
    ledger["rows_silver"] = len(published)
    return ledger, published


@settings(COMMON, max_examples=12)
@given(pages=PAGES)
def test_transform_equals_the_model(spark, pages):
    ledger, published = model(pages)
    texts = [json.dumps({"features": page}) for page in pages]
    flat = flatten(parse_documents(documents(spark, texts), CHAPTERS), CHAPTERS)
    lineage = {
        "ingest_run_id": F.lit("r1"),
        "ingested_at_utc": F.lit("2026-01-01T00:00:00Z").cast("timestamp"),
    }
    lake = Lake(scratch_path(spark, "model"), "points")
    counts = transform(spark, flat, CHAPTERS, lake, "r1", lineage, rows_landed=ledger["rows_in"])
    assert counts == ledger
    lazy = run_ledger(routed(flat, CHAPTERS), silver_of(flat, CHAPTERS, lineage)).first()
    assert lazy.asDict() == ledger

    silver = SnapshotTable(spark, lake.silver).read().select(*CHAPTERS.field_columns, "dq_status")
    assert sorted(map(repr, map(tuple, silver.collect()))) == sorted(map(repr, published))
    assert read_quarantine(spark, lake, CHAPTERS).count() == ledger["rows_quarantined"]


SNAPSHOT = st.dictionaries(
    st.tuples(st.integers(0, 3), st.sampled_from(["a", "b"])), st.one_of(st.none(), st.integers(0, 1))
)
KEYLESS = st.lists(st.tuples(st.sampled_from([None, 1]), st.none(), st.integers(0, 1)), max_size=3)
SNAPSHOT_SCHEMA = "k int, part string, v int"


@settings(COMMON, max_examples=15)
@given(old=SNAPSHOT, new=SNAPSHOT, old_keyless=KEYLESS, new_keyless=KEYLESS)
def test_merge_equals_the_model(spark, old, new, old_keyless, new_keyless):
    rows = lambda keyed, keyless: [(*k, v) for k, v in keyed.items()] + keyless
    target = spark.createDataFrame(rows(old, old_keyless), SNAPSHOT_SCHEMA)
    source = spark.createDataFrame(rows(new, new_keyless), SNAPSHOT_SCHEMA)
    key = ["k", "part"]

    expected = [(*k[:2], "DELETE") for k in old_keyless] + [(*k[:2], "INSERT") for k in new_keyless]
    for k in old.keys() | new.keys():
        if k not in old:
            action = "INSERT"
        elif k not in new:
            action = "DELETE"
        else:
            action = "UNCHANGED" if old[k] == new[k] else "UPDATE"
        expected.append((*k, action))
    report = change_report(target, source, key).collect()
    assert sorted(map(repr, map(tuple, report))) == sorted(map(repr, expected))

    known = compared_buckets(target, source, key, 5)
    by_bucket = changes_by_bucket(target, source, key, 5, known)
    totals = {r["action"]: r["n_rows"] for r in change_totals(by_bucket, known).collect()}
    assert totals == Counter(action for *_, action in expected)
    changed = lambda rows: sorted(repr(tuple(r)) for r in rows if r[2] != "UNCHANGED")
    assert changed(by_bucket.collect()) == changed(report)

    kept = {k: v for k, v in old.items() if k not in new}
    expected = rows(kept, old_keyless) + rows(new, new_keyless)
    upserted = merge_upsert(target, source, key).collect()
    assert sorted(map(repr, map(tuple, upserted))) == sorted(map(repr, expected))
    # one evaluation per side gives the same rows
    once = merge_upsert(target, source, key, assume_unique=True).collect()
    assert sorted(map(repr, map(tuple, once))) == sorted(map(repr, expected))
    assert sorted(map(repr, change_report(target, source, key, assume_unique=True).collect())) == sorted(
        map(repr, report)
    )


RUN_PAGES = st.lists(
    st.tuples(st.integers(1, 4), st.booleans(), st.one_of(st.none(), st.integers(0, 2))),
    min_size=1,
    max_size=4,
)


@settings(COMMON, max_examples=20)
@given(pages=RUN_PAGES)
def test_page_audit_equals_the_model(spark, pages):
    """A run is complete when walking its pages from the first visits each of them exactly once."""
    rows = [
        (number, json.dumps(page(*[None] * n, more=more)) if n is not None else "{}")
        for number, more, n in pages
    ]
    by_number = {number: (more, n) for number, more, n in pages}
    complete = len(by_number) == len(pages)
    walked, number = 0, 1
    while complete and number in by_number:
        walked += 1
        more, n = by_number[number]
        if n is None or not (more and n):
            break
        number += 1
    complete = complete and walked == len(pages) and number in by_number
    frame = spark.createDataFrame(rows, "page_no long, document string")
    audit = page_audit(page_statistics(frame, CHAPTERS)).first()
    assert audit["is_complete"] is complete
    assert audit["rows_in"] == sum(n or 0 for _, _, n in pages)
    assert audit["shapeless_pages"] == sum(n is None for _, _, n in pages)
