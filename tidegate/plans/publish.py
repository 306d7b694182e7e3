"""The gated publish of a run's silver snapshot, and what consumers read."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidegate import storage
from tidegate.errors import GateError
from tidegate.lake import Lake
from tidegate.operators.contract import (
    contract_projection,
    require_contract,
    require_contract_schema,
)
from tidegate.operators.gates import gate_columns, require_publishable
from tidegate.operators.ledger import status_counts
from tidegate.operators.merge import (
    buckets_for,
    change_totals,
    changes_by_bucket,
    compared_buckets,
    require_unique_key,
    rows_of_changed,
)
from tidegate.operators.quarantine import read_quarantine
from tidegate.operators.runs import read_runs
from tidegate.operators.snapshots import SnapshotTable
from tidegate.session import scratch_path
from tidegate.sources.runs import find_run
from tidegate.spec import ProductSpec

CHANGE_METRICS = {
    "INSERT": "rows_inserted",
    "UPDATE": "rows_updated",
    "DELETE": "rows_deleted",
    "UNCHANGED": "rows_unchanged",
}


def published_counts(gold: DataFrame, spec: ProductSpec) -> dict[str, int]:
    """Rows of the published snapshot, in total and per expected group, in one aggregate."""
    per_group = [
        F.count_if(F.col(spec.group) == group).alias(f"rows_gold_{group.lower()}")
        for group in spec.expected_groups
    ]
    return gold.agg(F.count(F.lit(1)).alias("rows_gold"), *per_group).first().asDict()


FOREIGN_ROWS = "rows_of_other_runs"


def publish_metrics(silver: DataFrame, spec: ProductSpec, run_id: str) -> Row:
    """What the gates need, and the number of rows of other runs, in one aggregate."""
    foreign = F.lit(False)
    if "ingest_run_id" in spec.lineage:
        foreign = ~F.col("ingest_run_id").eqNullSafe(F.lit(run_id))
    return silver.agg(*gate_columns(spec), F.count_if(foreign).alias(FOREIGN_ROWS)).first()


def require_single_run(metrics: Row, run_id: str) -> None:
    """Raise unless every row of the snapshot belongs to the run that is to be published."""
    if metrics[FOREIGN_ROWS]:
        raise GateError(f"{metrics[FOREIGN_ROWS]} row(s) of the silver snapshot are not of run {run_id!r}")


def merge_changes(
    spark: SparkSession, live: DataFrame, gold: DataFrame, spec: ProductSpec, rows: int
) -> dict[str, int]:
    """Rows inserted, updated, deleted and unchanged against the live snapshot.

    Both are read once for the digests of their buckets; only the buckets that differ are joined, and
    only they are checked for repeated keys, as what equals the live snapshot has none.
    """
    business = [c for c in spec.contract_columns if c not in (*spec.key, *spec.lineage)]
    buckets = buckets_for(rows)
    path = scratch_path(spark, "buckets")
    try:
        found = compared_buckets(live, gold, spec.key, buckets, business)
        found.write.parquet(path)
        known = spark.read.schema(found.schema).parquet(path)
        require_unique_key(rows_of_changed(gold.select(*spec.key), spec.key, buckets, known), spec.key)
        report = changes_by_bucket(live, gold, spec.key, buckets, known, business)
        counted = change_totals(report, known).collect()  # a row for each kind of change
    finally:
        storage.delete(spark, path)
    changes = {name: 0 for name in CHANGE_METRICS.values()}
    changes.update({CHANGE_METRICS[row["action"]]: row["n_rows"] for row in counted})
    return changes


def publish_gold(
    spark: SparkSession,
    spec: ProductSpec,
    lake: Lake,
    run_id: str,
    merge: bool = False,
    verify: bool = False,
) -> dict[str, object]:
    """Gate the silver snapshot of ``run_id`` and publish its contract columns.

    Silver is read by its run, never as whatever is newest: an unknown run and a snapshot with
    rows of another run are refused. The gates run before anything is written, so a refusal leaves the live snapshot alone. With
    ``merge=True`` the publish has MERGE semantics: the key must be unique, and rows inserted,
    updated, deleted and unchanged against the live snapshot are counted. ``verify=True`` also checks
    every contract guarantee first, for one shuffle of the keys; silver of this library has them by
    construction. The counts of rows are read back from what was published.
    """
    silver = SnapshotTable(spark, lake.silver).as_of_run(run_id)
    metrics = publish_metrics(silver, spec, run_id)
    require_single_run(metrics, run_id)
    require_publishable(metrics, spec)

    published_at = datetime.now(timezone.utc).isoformat()
    gold = contract_projection(silver, spec)
    require_contract_schema(gold, spec)
    if verify:
        require_contract(silver, spec, allow_null_key=spec.null_key == "collapse")
    table = SnapshotTable(spark, lake.gold)
    changes: dict[str, int] = {}
    if merge and table.exists():
        changes = merge_changes(spark, table.read(), gold, spec, metrics["rows_silver"])
    # for consumers that look keys up or page through the product by key
    version = table.publish(gold, run_id, sort_by=spec.key)
    return {
        "gold_published_at_utc": published_at,
        **published_counts(table.as_of_version(version), spec),
        **changes,
    }


def derived_ledger(
    spark: SparkSession, spec: ProductSpec, lake: Lake, run_id: str
) -> dict[str, int]:
    """What the lake still tells about a run whose ledger was not kept: rows landed, rows
    quarantined and the statuses in silver. Rows out of scope and duplicates leave no trace."""
    quarantined = read_quarantine(spark, lake, spec, run_id)
    silver = SnapshotTable(spark, lake.silver).as_of_run(run_id)
    return {
        "rows_in": find_run(spark, lake, run_id).rows_in,
        "rows_quarantined": quarantined.count(),
        **silver.agg(*status_counts()).first().asDict(),
    }


def register_views(spark: SparkSession, spec: ProductSpec, lake: Lake, prefix: str = "") -> None:
    """Temporary views for SQL consumers: gold, silver, quarantine, runs and publications."""
    gold = SnapshotTable(spark, lake.gold)
    views = {
        "gold": gold.read(),
        "silver": SnapshotTable(spark, lake.silver).read(),
        "quarantine": read_quarantine(spark, lake, spec),
        "runs": read_runs(spark, lake),
        "publications": gold.history(),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
