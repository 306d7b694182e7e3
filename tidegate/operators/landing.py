"""Landing page documents verbatim, append-by-run."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import storage
from tidegate.errors import LandingError
from tidegate.functions.runs import run_id_at
from tidegate.lake import Lake
from tidegate.session import single_row
from tidegate.sources.pages import (
    is_acceptable,
    missing_ranges,
    page_audit,
    page_statistics,
    require_complete,
    sound_page,
)
from tidegate.sources.runs import DOCUMENT_SCHEMA, LANDING_TYPES, LandedRun, landed_runs
from tidegate.spec import ProductSpec

# Readers decode up to 4,096 rows of a row group at a time, which for documents of some 100 KB is
# gigabytes of text. The number of documents in a row group bounds that batch; its size in bytes,
# counted after compression, would not.
DOCUMENTS_PER_ROW_GROUP = 200
COUNTED_SCHEMA = f"{DOCUMENT_SCHEMA}, n_records long, error string"


def write_documents(documents: DataFrame, path: str) -> None:
    """Write rows that hold whole page documents, in row groups a reader can decode at once."""
    (
        documents.write.option("compression", "zstd")
        .option("parquet.block.row.count.limit", DOCUMENTS_PER_ROW_GROUP)
        .parquet(path)
    )


def land_documents(
    spark: SparkSession,
    documents: DataFrame,
    lake: Lake,
    spec: ProductSpec,
    run_id: str | None = None,
    started_at: datetime | None = None,
    source: str | None = None,
    source_detail: str | None = None,
    where_clause: str | None = None,
    keep_refused: bool = False,
    completes: str | None = None,
) -> LandedRun:
    """Land ``documents`` (``page_no``, ``document``) as one run and register it.

    The documents are written once, together with the few counts the audit needs, so the audit
    reads small columns instead of parsing the pages again. A run becomes findable only by its row
    in the landings table, added after the audit has passed: a refused batch leaves an earlier
    landing of the same run untouched. Landing a run again replaces it.

    A refusal names the ranges of pages that are lacking. With ``keep_refused`` the refused documents
    stay, in the folder the error names as ``attempt``; giving it as ``completes`` lands them together
    with ``documents``, so only the lacking pages need fetching. A page in both is taken from
    ``documents``, and pages that were errors are left behind.
    """
    if started_at is None:
        started_at = datetime.now(timezone.utc)
    if run_id is None:
        run_id = run_id_at(started_at)
    ingest_date = started_at.astimezone(timezone.utc).date()
    path = lake.landing(run_id, ingest_date.isoformat(), f"a{uuid.uuid4().hex}")

    numbered = documents.select(F.col("page_no").cast("long"), "document")
    if completes:
        earlier = spark.read.schema(COUNTED_SCHEMA).parquet(f"{lake.bronze}/{completes}").filter(sound_page())
        kept = earlier.join(numbered.select("page_no"), "page_no", "left_anti")
        numbered = numbered.unionByName(kept.select("page_no", "document"))
    statistics = page_statistics(numbered, spec, scope=True)
    write_documents(statistics, path)
    landed = spark.read.schema(statistics.schema).parquet(path)
    audit = page_audit(landed).first()
    try:
        require_complete(audit, () if is_acceptable(audit) else missing_ranges(landed))
    except LandingError as refusal:
        if keep_refused and refusal.missing:
            refusal.attempt = path.removeprefix(f"{lake.bronze}/")
        else:
            storage.delete(spark, path)
        raise

    replaced = (
        landed_runs(spark, lake)
        .filter((F.col("run_id") == run_id) & (F.col("ingest_date") == F.lit(ingest_date)))
        .select("folder")
        .collect()
    )
    run = LandedRun(
        run_id=run_id,
        ingest_date=ingest_date.isoformat(),
        ingested_at_utc=started_at.astimezone(timezone.utc).isoformat(),
        source=source,
        source_detail=source_detail,
        where_clause=where_clause,
        pages=audit["pages"],
        rows_in=audit["rows_in"],
        folder=path.removeprefix(f"{lake.bronze}/"),
    )
    entry = {**run.__dict__, "landed_at_utc": datetime.now(timezone.utc).isoformat()}
    single_row(spark, entry, LANDING_TYPES).write.mode("append").parquet(lake.landings)
    for old in {row["folder"] for row in replaced} | ({completes} if completes else set()):
        storage.delete(spark, f"{lake.bronze}/{old}")
    return run
