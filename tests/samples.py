"""Synthetic pages in the shape of the source, with several records of each outcome."""

from __future__ import annotations

import json


def record(object_id, chapter_id, state, city="Springfield", name=None, x=-120.5, y=38.25, **more):
    return {
        "attributes": {
            "OBJECTID": object_id,
            "University_Chapter": name or f"College {object_id}",
            "City": city,
            "State": state,
            "ChapterID": chapter_id,
            "MEVR_RD": f"Secret Person {object_id}",
            **more,
        },
        "geometry": None if x is None and y is None else {"x": x, "y": y},
    }


def page(*records, more=None, **other):
    document = {"objectIdFieldName": "OBJECTID", **other, "features": list(records)}
    if more is not None:
        document["exceededTransferLimit"] = more
    return document


# What becomes of each record, next to the rule that decides it. Counts are taken from this list.
CASES = [
    ("OK", record(40, "W-40", "WA")),
    ("OK", record(41, " O-41 ", " or ")),  # padded and in lower case
    ("DUPLICATE", record(42, "C-50", "CA", name="First")),  # a later record of the key follows
    ("OUT_OF_SCOPE", record(43, "T-43", "TX", x="far out")),  # scope comes before the coordinates
    ("QUARANTINED", record(44, "W-44", "WA", y=90.5)),
    ("DUPLICATE", record(49, "C-50", "CA", name="Second")),
    ("QUARANTINED", record(45, "C-45", "CA", x="west")),
    ("WARNING", record(46, "O-46", "OR", city="  ")),
    ("QUARANTINED", record(47, "O-47", "OR", y=None)),  # half a point
    ("OUT_OF_SCOPE", record(48, "N-48", None)),
    ("WARNING", record(51, "W-51", "WA", city="Unknown")),
    ("OK", record(52, "C-50", "CA", name="Third")),
    ("DUPLICATE", record(39, "W-40", "WA", name="Earlier")),  # read last, but not the latest
]
FIRST_PAGE = 7
PAGES = [
    page(*(r for _, r in CASES[:FIRST_PAGE]), more=True),
    page(*(r for _, r in CASES[FIRST_PAGE:])),
]


def ids(*outcomes):
    """The keys of the records with one of these outcomes."""
    return {r["attributes"]["ChapterID"].strip() for outcome, r in CASES if outcome in outcomes}


def number_of(*outcomes):
    return sum(outcome in outcomes for outcome, _ in CASES)


LEDGER = {
    "rows_in": len(CASES),
    "rows_out_of_scope": number_of("OUT_OF_SCOPE"),
    "rows_quarantined": number_of("QUARANTINED"),
    "rows_deduped": number_of("DUPLICATE"),
    "rows_warned": number_of("WARNING"),
    "rows_ok": number_of("OK"),
    "rows_silver": number_of("OK", "WARNING"),
}
PUBLISHED = ids("OK", "WARNING")


def documents(spark, pages=PAGES, first=1):
    rows = [
        (number, page if isinstance(page, str) else json.dumps(page))
        for number, page in enumerate(pages, start=first)
    ]
    return spark.createDataFrame(rows, "page_no long, document string")


def flat_rows(spark, pages=PAGES, spec=None, run_id="run_test"):
    from pyspark.sql import functions as F

    from tidegate.operators.flatten import flatten
    from tidegate.plans.chapters import CHAPTERS
    from tidegate.sources.pages import parse_documents

    spec = spec or CHAPTERS
    lineage = {
        "ingest_run_id": F.lit(run_id),
        "ingested_at_utc": F.lit("2026-01-02T03:04:05+00:00").cast("timestamp"),
    }
    return flatten(parse_documents(documents(spark, pages), spec), spec, lineage)
