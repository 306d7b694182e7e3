"""Missing pages, completing a refused batch, and pages left unparsed."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import documents, page, record

from tidegate import storage
from tidegate.errors import LandingError
from tidegate.operators.landing import land_documents
from tidegate.plans import run_landed, run_pages
from tidegate.plans.chapters import CHAPTERS
from tidegate.operators.snapshots import SnapshotTable
from tidegate.lake import Lake
from tidegate.sources import (
    find_run,
    landed_runs,
    missing_pages,
    missing_ranges,
    page_statistics,
    pages as page_source,
    parse_documents,
    read_landed_documents,
    read_landed_in_scope,
)
from tidegate.sources import runs as landing_runs

COUNTED = "run_id string, page_no long, n_records long, more boolean, error string"
PAGES = st.lists(
    st.tuples(
        st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 14)), st.one_of(st.none(), st.integers(0, 2)),
        st.booleans(), st.sampled_from([None, None, None, "bad"]),
    ),
    max_size=14,
)


def model(rows):
    found = set()
    for run in {row[0] for row in rows}:
        pages = {}
        for _, number, n, more, error in (row for row in rows if row[0] == run):
            if number is not None and number >= 1 and n is not None and error is None:
                pages[number] = pages.get(number, True) and more and n > 0
        last = max(pages, default=0)
        lacking = [n for n in range(1, last) if n not in pages]
        while lacking:
            end = first = lacking[0]
            while end + 1 in lacking:
                end += 1
            found.add((run, first, end))
            lacking = [n for n in lacking if n > end]
        if pages.get(last, True):
            found.add((run, last + 1, None))
    return found


@settings(
    deadline=None, derandomize=True, database=None, max_examples=25,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(rows=PAGES, part=st.sampled_from([3, 4096]))
def test_missing_ranges_equal_the_model(spark, rows, part):
    whole, page_source.PAGES_PER_PART = page_source.PAGES_PER_PART, part
    try:
        found = missing_pages(spark.createDataFrame(rows, COUNTED), ["run_id"]).collect()
    finally:
        page_source.PAGES_PER_PART = whole
    assert sorted(map(tuple, found), key=repr) == sorted(model(rows), key=repr)


def test_a_refusal_names_what_is_missing(spark, lake):
    pages = [page(record(n, f"CA-{n}", "CA"), more=True) for n in range(1, 9)]
    some = documents(spark, pages).filter("page_no in (2, 3, 7)")
    with pytest.raises(LandingError, match="missing: 1, 4-6, 8 and on") as refused:
        land_documents(spark, some, lake, CHAPTERS, "run_1")
    assert refused.value.missing == ((1, 1), (4, 6), (8, None)) and refused.value.attempt is None
    assert not storage.glob(spark, f"{lake.bronze}/*/*/attempt=*")


def test_many_ranges_are_named_in_part(spark):
    rows = [("a", n, 1, n < 99, None) for n in range(1, 100, 2)]
    statistics = spark.createDataFrame(rows, COUNTED)
    assert len(missing_ranges(statistics)) == page_source.RANGES_NAMED + 1
    assert missing_pages(statistics).count() == 49


def test_a_refused_batch_is_completed(spark, lake):
    pages = [page(record(n, f"CA-{n}", "CA"), more=n < 6) for n in range(1, 7)]
    whole = documents(spark, pages)
    broken = whole.withColumn(
        "document", F.when(F.col("page_no") == 5, F.lit('{"error": {"code": 500}}')).otherwise(F.col("document"))
    ).filter("page_no <> 3")
    with pytest.raises(LandingError, match="error payload; missing: 3, 5") as first:
        land_documents(spark, broken, lake, CHAPTERS, "run_1", keep_refused=True)
    assert landed_runs(spark, lake).count() == 0
    # only a part of what is missing comes back, and one page has changed at the source
    changed = documents(spark, [page(record(4, "CA-new", "CA"), more=True)], first=4)
    some = whole.filter("page_no = 3").unionByName(changed)
    with pytest.raises(LandingError, match="missing: 5") as second:
        land_documents(spark, some, lake, CHAPTERS, "run_1", keep_refused=True, completes=first.value.attempt)
    run = land_documents(
        spark, whole.filter("page_no = 5"), lake, CHAPTERS, "run_1", completes=second.value.attempt
    )
    assert (run.pages, run.rows_in) == (6, 6)
    landed = read_landed_documents(spark, lake, find_run(spark, lake, "run_1"))
    assert "CA-new" in landed.filter("page_no = 4").first()["document"]
    assert run_landed(spark, CHAPTERS, lake, "run_1")["rows_gold"] == 6
    left = storage.glob(spark, f"{lake.bronze}/*/*/attempt=*")
    assert not any(left_over.endswith(second.value.attempt) for left_over in left)
    assert any(left_over.endswith(run.folder) for left_over in left)


def test_pages_out_of_scope_are_not_parsed(spark, tmp_path, monkeypatch):
    by_state = [("NV", 3), ("CA", 2), (" nv", 1), ("or ", 2), (None, 2), ("TX", 70)]
    pages, number = [], 0
    for at, (state, n) in enumerate(by_state):
        records = []
        for _ in range(n):
            number += 1
            name = f"{state}{number}" if state == "TX" else state  # more values than are noted
            records.append(record(number, f"K-{number}", name))
        pages.append(page(*records, more=at + 1 < len(by_state)))
    lakes = [Lake(str(tmp_path / name), "points") for name in ("skipped", "all")]
    summary = run_pages(spark, CHAPTERS, lakes[0], documents(spark, pages), "run_1")
    run = find_run(spark, lakes[0], "run_1")
    parsed, rows_skipped = read_landed_in_scope(spark, lakes[0], run, CHAPTERS)
    # of the page with many values nothing is known, so it is parsed
    assert sorted(r["page_no"] for r in parsed.collect()) == [2, 4, 6] and rows_skipped == 3 + 1 + 2
    assert parse_documents(parsed, CHAPTERS).count() == 3
    nothing_known = page_statistics(documents(spark, pages), CHAPTERS, scope=True).filter("page_no = 6").first()
    assert nothing_known["scope_values"] is None and nothing_known["scope_path"] is None

    monkeypatch.setattr(landing_runs, "out_of_scope", lambda spec: F.lit(False))
    everything = run_pages(spark, CHAPTERS, lakes[1], documents(spark, pages), "run_1")
    counts = [{k: v for k, v in s.items() if k.startswith("rows_")} for s in (summary, everything)]
    assert counts[0] == counts[1] and counts[0]["rows_out_of_scope"] == 76
    gold = [
        sorted(map(str, SnapshotTable(spark, l.gold).read().drop("ingested_at_utc").collect())) for l in lakes
    ]
    assert gold[0] == gold[1] and len(gold[0]) == 4


def test_another_scope_path_or_none_skips_nothing(spark, lake):
    land_documents(spark, documents(spark), lake, CHAPTERS, "run_1")
    run = find_run(spark, lake, "run_1")
    for spec in (
        CHAPTERS.with_changes(scope=("city", ("Nowhere",))),
        CHAPTERS.with_changes(scope=None),
    ):
        parsed, rows_skipped = read_landed_in_scope(spark, lake, run, spec)
        assert (parsed.count(), rows_skipped) == (run.pages, 0)
    other = CHAPTERS.with_changes(scope=("state", ("ZZ",)))
    assert read_landed_in_scope(spark, lake, run, other)[1] == run.rows_in


@settings(
    deadline=None, derandomize=True, database=None, max_examples=25,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(rows=PAGES)
def test_pages_in_missing_ranges_are_all_found(spark, rows):
    rows = [("a", *row[1:]) for row in rows]
    wanted = [(n,) for n in [None, *range(-1, 20)]]
    found = page_source.in_missing_pages(spark.createDataFrame(wanted, "page_no long"), spark.createDataFrame(rows, COUNTED))
    ranges = model(rows)
    expected = [
        n for (n,) in wanted
        if n is not None and any(n >= first and (last is None or n <= last) for _, first, last in ranges)
    ]
    assert sorted(row["page_no"] for row in found.collect()) == expected


def test_pages_beyond_the_named_ranges_are_found(spark):
    rows = [("a", n, 1, n < 99, None) for n in range(1, 100, 2)]
    wanted = spark.createDataFrame([(n, f"page {n}") for n in range(1, 120)], "page_no long, document string")
    found = page_source.in_missing_pages(wanted, spark.createDataFrame(rows, COUNTED))
    assert sorted(row["page_no"] for row in found.collect()) == list(range(2, 99, 2))
