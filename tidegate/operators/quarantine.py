"""The quarantine table: one folder per run, replaced as a whole when the run is repeated."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import storage
from tidegate.lake import Lake
from tidegate.session import single_row
from tidegate.spec import LINEAGE, PAYLOAD, REASON, ProductSpec


LOG_TYPES = {"run_id": "string", "folder": "string", "written_at_utc": "timestamp"}
LOG_SCHEMA = ", ".join(f"{name} {data_type}" for name, data_type in LOG_TYPES.items())


def quarantine_schema(spec: ProductSpec) -> str:
    types = {f.name: f.type for f in spec.fields} | LINEAGE | {REASON: "string", PAYLOAD: "string"}
    return ", ".join(f"`{name}` {types[name]}" for name in spec.quarantine_columns)


def write_quarantine(rejected: DataFrame, lake: Lake, run_id: str) -> None:
    """Replace the run's rows, so a repeated run leaves the same rows, also when there are none.

    Each attempt writes a folder of its own and becomes the run's by one log row written last: a
    failed write leaves the earlier evidence as it was, and readers never see a part of it. What was
    replaced is deleted afterwards. Rejected rows are few and scattered over all input tasks; the
    rebalance packs them into files of the advisory size instead of one small file per task.
    """
    spark = rejected.sparkSession
    folder = f"{lake.quarantine_run(run_id)}/attempt={uuid.uuid4().hex}"
    rejected.drop("ingest_run_id").hint("rebalance").write.parquet(folder)
    entry = {
        "run_id": run_id,
        "folder": folder.removeprefix(f"{lake.quarantine}/"),
        "written_at_utc": datetime.now(timezone.utc).isoformat(),
    }
    single_row(spark, entry, LOG_TYPES).write.mode("append").parquet(lake.quarantine_log)
    for old in storage.glob(spark, f"{lake.quarantine_run(run_id)}/attempt=*"):
        if old.rsplit("/", 1)[-1] != folder.rsplit("/", 1)[-1]:
            storage.delete(spark, old)


def _current_folders(spark: SparkSession, lake: Lake, run_id: str | None) -> list[str]:
    """The folder of each run that counts: the log's newest; one row for each run."""
    if not storage.exists(spark, lake.quarantine_log):
        return []
    log = spark.read.schema(LOG_SCHEMA).parquet(lake.quarantine_log)
    if run_id is not None:
        log = log.filter(F.col("run_id") == run_id)
    newest = log.groupBy("run_id").agg(F.max_by("folder", "written_at_utc").alias("folder"))
    return [f"{lake.quarantine}/{row['folder']}" for row in newest.collect()]


def read_quarantine(
    spark: SparkSession, lake: Lake, spec: ProductSpec, run_id: str | None = None
) -> DataFrame:
    """Quarantined rows of all runs, or of one run without listing the others' files."""
    schema = quarantine_schema(spec)
    folders = _current_folders(spark, lake, run_id)
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", lake.quarantine).parquet(*folders)
    return rows.select(*spec.quarantine_columns)


def quarantined_by_run(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("ingest_run_id", REASON).agg(F.count(F.lit(1)).alias("n_rows"))
