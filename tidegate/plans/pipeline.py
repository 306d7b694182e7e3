"""Whole runs: land, transform, publish, record."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidegate import storage
from tidegate.errors import LandingError
from tidegate.lake import Lake
from tidegate.operators.flatten import flatten
from tidegate.operators.landing import land_documents, write_documents
from tidegate.operators.runs import append_run
from tidegate.plans.publish import publish_gold
from tidegate.plans.silver import transform
from tidegate.session import scratch_path
from tidegate.sources.pages import (
    PAGE_FILE_GLOB,
    page_audit,
    page_statistics,
    parse_documents,
    read_numbered,
    require_complete,
)
from tidegate.sources.runs import (
    LandedRun,
    find_run,
    find_run_folder,
    read_landed_in_scope,
    read_sidecar,
)
from tidegate.spec import ProductSpec


def _finish(
    spark: SparkSession,
    pages: DataFrame,
    spec: ProductSpec,
    lake: Lake,
    run: LandedRun,
    folder: str,
    started_at: datetime,
    merge: bool,
    rows_skipped: int = 0,
) -> dict[str, object]:
    flat = flatten(pages, spec)
    ledger = transform(
        spark,
        flat,
        spec,
        lake,
        run.run_id,
        run.lineage(),
        rows_landed=run.rows_in,
        rows_skipped=rows_skipped,
    )
    published = publish_gold(spark, spec, lake, run.run_id, merge)
    summary = {
        "run_id": run.run_id,
        "source": run.source,
        "started_at_utc": started_at.isoformat(),
        "finished_at_utc": datetime.now(timezone.utc).isoformat(),
        "bronze_dir": folder,
        **ledger,
        **published,
    }
    append_run(spark, lake, summary)
    return summary


def _finish_landed(
    spark: SparkSession,
    spec: ProductSpec,
    lake: Lake,
    run: LandedRun,
    started_at: datetime,
    merge: bool,
) -> dict[str, object]:
    documents, skipped = read_landed_in_scope(spark, lake, run, spec)
    folder = f"{lake.bronze}/{run.folder}"
    pages = parse_documents(documents, spec)
    return _finish(spark, pages, spec, lake, run, folder, started_at, merge, skipped)


def run_landed(
    spark: SparkSession,
    spec: ProductSpec,
    lake: Lake,
    run_id: str,
    merge: bool = False,
) -> dict[str, object]:
    """Transform and publish a run that is already landed; returns the run summary.

    The summary is recorded on success only. Running it again converges to the same tables.
    """
    started_at = datetime.now(timezone.utc)
    run = find_run(spark, lake, run_id)
    return _finish_landed(spark, spec, lake, run, started_at, merge)


def run_pages(
    spark: SparkSession,
    spec: ProductSpec,
    lake: Lake,
    documents: DataFrame,
    run_id: str | None = None,
    merge: bool = False,
    **description: str,
) -> dict[str, object]:
    """Land page documents as a new run, then transform and publish it.

    ``description`` takes what ``land_documents`` records of the source: ``source``,
    ``source_detail`` and ``where_clause``.
    """
    started_at = datetime.now(timezone.utc)
    run = land_documents(spark, documents, lake, spec, run_id, started_at, **description)
    return _finish_landed(spark, spec, lake, run, started_at, merge)


def audit_page_files(statistics: DataFrame, run: LandedRun) -> None:
    """Refuse page files that are incomplete, malformed, or not what the run's sidecar describes."""
    audit = page_audit(statistics).first()
    require_complete(audit)
    for name, described in (("pages", run.pages), ("rows_in", run.rows_in)):
        if audit[name] != described:
            raise LandingError(f"{name}: the sidecar says {described}, the files hold {audit[name]}")


def run_folder(
    spark: SparkSession,
    spec: ProductSpec,
    lake: Lake,
    bronze_root: str,
    run_id: str,
    merge: bool = False,
    name_filter: str = PAGE_FILE_GLOB,
) -> dict[str, object]:
    """Transform and publish a run kept as page files with a JSON sidecar.

    The files are read once, into the shared scratch folder with the counts the audit needs, and
    audited before anything is written, so a bad folder leaves silver as it is.
    """
    started_at = datetime.now(timezone.utc)
    folder = find_run_folder(spark, bronze_root, run_id)
    run = read_sidecar(spark, folder)
    counted = page_statistics(read_numbered(spark, folder, name_filter), spec)
    staged = scratch_path(spark, "page-files")
    try:
        write_documents(counted, staged)
        pages = spark.read.schema(counted.schema).parquet(staged)
        audit_page_files(pages, run)
        parsed = parse_documents(pages.select("page_no", "document"), spec)
        return _finish(spark, parsed, spec, lake, run, folder, started_at, merge)
    finally:
        storage.delete(spark, staged)
