"""Ready-made spec for paged point features of chapters in three states."""

from __future__ import annotations

from tidegate.spec import BlankOrLiteral, Field, OrderBy, OutsideRange, ProductSpec

# Fixed values of the source pages and of the published contract.
STATES = ("CA", "OR", "WA")
INVALID_COORDINATES = "INVALID_COORDINATES"
MISSING_OR_UNKNOWN_CITY = "MISSING_OR_UNKNOWN_CITY"

CHAPTERS = ProductSpec(
    fields=(
        Field("chapter_id", "attributes.ChapterID"),
        Field("chapter_name", "attributes.University_Chapter"),
        Field("city", "attributes.City"),
        Field("state", "attributes.State", normalise=("trim", "upper")),
        Field("longitude", "geometry.x", "double"),
        Field("latitude", "geometry.y", "double"),
        Field("source_object_id", "attributes.OBJECTID", "bigint"),
    ),
    key=("chapter_id",),
    order=(
        OrderBy("source_object_id", descending=True, nulls_last=True),
        OrderBy("chapter_name"),
    ),
    contract=(
        ("chapter_id", "string"),
        ("chapter_name", "string"),
        ("city", "string"),
        ("state", "string"),
        ("longitude", "double"),
        ("latitude", "double"),
        ("dq_status", "string"),
        ("dq_warnings", "array<string>"),
        ("ingest_run_id", "string"),
        ("ingested_at_utc", "timestamp"),
    ),
    scope=("state", STATES),
    hard_rules=(
        OutsideRange(
            INVALID_COORDINATES, (("longitude", -180.0, 180.0), ("latitude", -90.0, 90.0))
        ),
    ),
    soft_rules=(BlankOrLiteral(MISSING_OR_UNKNOWN_CITY, "city", ("UNKNOWN",)),),
    group="state",
    expected_groups=STATES,
    required_groups=("CA",),
    # The director's name is personal data. It stays in the landed pages: no field reads it, the payload
    # leaves it out wherever it occurs, and the contract refuses it.
    forbidden_columns=("MEVR_RD",),
)
