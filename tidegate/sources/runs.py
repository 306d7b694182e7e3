"""Finding landed runs.

Every accepted landing is one row of the landings table, so a run is found by reading that small
table and its pages by one explicit folder; the bronze tree itself is never listed.
``find_run_folder`` and ``read_sidecar`` serve lakes whose runs are described by a JSON sidecar
next to the page files.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import storage
from tidegate.errors import LandingError
from tidegate.lake import Lake
from tidegate.sources.pages import out_of_scope
from tidegate.spec import ProductSpec

# Fixed name and shape of the run description.
DOCUMENT_SCHEMA = "page_no long, document string"
SUMMARY_SCHEMA = f"{DOCUMENT_SCHEMA}, n_records long, scope_path string, scope_values array<string>"
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
RUN_FOLDER_DATE = re.compile(r"/ingest_date=(\d{4}-\d{2}-\d{2})/run_id=[^/]*$")
SIDECAR_NAME = "_ingest_metadata.json"
LANDING_TYPES = {
    "run_id": "string",
    "ingest_date": "date",
    "ingested_at_utc": "timestamp",
    "source": "string",
    "source_detail": "string",
    "where_clause": "string",
    "pages": "long",
    "rows_in": "long",
    "landed_at_utc": "timestamp",
    "folder": "string",
}
LANDING_SCHEMA = ", ".join(f"{name} {data_type}" for name, data_type in LANDING_TYPES.items())


@dataclass(frozen=True)
class LandedRun:
    """One landed run. Dates and times are ISO text: a driver-side datetime without an offset
    would be read in the driver's own time zone."""

    run_id: str
    ingest_date: str
    ingested_at_utc: str
    source: str | None
    source_detail: str | None
    where_clause: str | None
    pages: int
    rows_in: int
    folder: str | None = None

    def lineage(self) -> dict[str, Column]:
        """The columns that tie every row to its run."""
        return {
            "ingest_run_id": F.lit(self.run_id),
            "ingested_at_utc": F.lit(self.ingested_at_utc).cast("timestamp"),
        }


def landed_runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """All accepted landings, oldest landing of a re-landed run included."""
    if not storage.exists(spark, lake.landings):
        return spark.createDataFrame([], LANDING_SCHEMA)
    return spark.read.schema(LANDING_SCHEMA).parquet(lake.landings)


def newest_run(runs: DataFrame, date_column: str = "ingest_date", *tie_break: str) -> DataFrame:
    """Per ``run_id`` the row of the newest date; partial aggregation, no sort of the table."""
    latest = F.max_by(
        F.struct(*[c for c in runs.columns if c != "run_id"]),
        F.struct(date_column, *tie_break),
    )
    return runs.groupBy("run_id").agg(latest.alias("_latest")).select("run_id", "_latest.*")


def find_run(spark: SparkSession, lake: Lake, run_id: str) -> LandedRun:
    """The newest landing of ``run_id``; an unknown run is an error."""
    mine = landed_runs(spark, lake).filter(F.col("run_id") == run_id)
    newest = newest_run(mine, "ingest_date", "landed_at_utc").drop("landed_at_utc")
    row = newest.withColumns(
        {
            "ingest_date": F.col("ingest_date").cast("string"),
            "ingested_at_utc": F.date_format("ingested_at_utc", ISO_PATTERN),
        }
    ).first()
    if row is None:
        raise LandingError(f"no landed run {run_id!r} under {lake.bronze}")
    return LandedRun(**row.asDict())


def read_landed_documents(spark: SparkSession, lake: Lake, run: LandedRun) -> DataFrame:
    return spark.read.schema(DOCUMENT_SCHEMA).parquet(f"{lake.bronze}/{run.folder}")


def read_landed_in_scope(
    spark: SparkSession, lake: Lake, run: LandedRun, spec: ProductSpec
) -> tuple[DataFrame, int]:
    """The documents of a run that can have records in scope, and the number of records on the others.

    Pages are judged by what was noted of them at landing, so those that are left out are not
    parsed. Counting their records reads the small columns only.
    """
    pages = spark.read.schema(SUMMARY_SCHEMA).parquet(f"{lake.bronze}/{run.folder}")
    skipped = pages.filter(out_of_scope(spec)).agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("n"))
    return pages.filter(~out_of_scope(spec)).select("page_no", "document"), skipped.first()["n"]


def find_run_folder(spark: SparkSession, bronze_root: str, run_id: str) -> str:
    """Locate a folder ``ingest_date=*/run_id=<run_id>`` of page files; the newest date wins."""
    pattern = f"{bronze_root}/ingest_date=*/run_id={run_id}"
    dated = {
        date.fromisoformat(match[1]): folder
        for folder in storage.glob(spark, pattern)
        if (match := RUN_FOLDER_DATE.search(folder))
    }
    if not dated:
        raise LandingError(f"{bronze_root} holds no dated folder of run {run_id!r}")
    return dated[max(dated)]


def write_sidecar(spark: SparkSession, run_folder: str, run: LandedRun) -> None:
    """Describe a run next to its page files, the way ``read_sidecar`` reads it."""
    described = {name: value for name, value in run.__dict__.items() if name != "folder"}
    storage.write_text(spark, f"{run_folder.rstrip('/')}/{SIDECAR_NAME}", json.dumps(described))


def read_sidecar(spark: SparkSession, run_folder: str) -> LandedRun:
    """Read the JSON description next to the page files of a run."""
    path = f"{run_folder.rstrip('/')}/{SIDECAR_NAME}"
    if not storage.exists(spark, path):
        raise LandingError(f"missing {SIDECAR_NAME} in {run_folder}")
    described = json.loads(storage.read_text(spark, path))
    return LandedRun(
        run_id=described["run_id"],
        ingest_date=described["ingest_date"],
        ingested_at_utc=described["ingested_at_utc"],
        source=described.get("source"),
        source_detail=described.get("source_detail"),
        where_clause=described.get("where_clause"),
        pages=described["pages"],
        rows_in=described["rows_in"],
        folder=run_folder,
    )
