"""Flat rows to silver, quarantine and the count ledger."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import storage
from tidegate.functions.rules import with_soft_flags
from tidegate.lake import Lake
from tidegate.operators.dedupe import latest_wins
from tidegate.operators.ledger import (
    ledger_from_counts,
    require_all_read,
    require_balanced,
    route_counts,
    status_counts,
)
from tidegate.operators.quarantine import write_quarantine
from tidegate.operators.route import (
    QUARANTINED,
    ROUTE,
    SURVIVOR,
    quarantine_split,
    route,
    routed,
    survivors,
)
from tidegate.operators.snapshots import SnapshotTable
from tidegate.session import run_together, scratch_path
from tidegate.spec import PAYLOAD, REASON, ProductSpec


def _silver_from_survivors(
    surviving: DataFrame, spec: ProductSpec, lineage: Mapping[str, Column] | None = None
) -> DataFrame:
    # Soft flags drop no row and lineage is constant within a run, so both are added after the
    # exchange, to the rows that are kept.
    latest = latest_wins(surviving, spec.key, spec.order)
    flagged = with_soft_flags(latest, spec.soft_rules)
    return flagged.withColumns(dict(lineage or {})).select(*spec.silver_columns)


def silver_of(
    flat: DataFrame, spec: ProductSpec, lineage: Mapping[str, Column] | None = None
) -> DataFrame:
    """Silver as a lazy frame: scope, hard rules, latest-wins, soft flags.

    ``lineage`` gives the lineage columns that ``flat`` does not have.
    """
    return _silver_from_survivors(survivors(flat, spec), spec, lineage)


def transform(
    spark: SparkSession,
    flat: DataFrame,
    spec: ProductSpec,
    lake: Lake,
    run_id: str,
    lineage: Mapping[str, Column] | None = None,
    stage: bool = True,
    rows_landed: int | None = None,
    rows_skipped: int = 0,
) -> dict[str, int]:
    """Write silver and quarantine of one run and return its ledger.

    ``stage=True`` suits expensive sources such as page documents: they are parsed once, and the
    flat rows go to a table in the shared scratch folder, one folder per route. Silver and
    quarantine read only their own route, and a lost executor never causes a page to be parsed
    again. ``stage=False`` suits columnar tables, where three pruned scans cost less than an extra
    copy.

    Staged and published rows are counted from the committed files, where a count needs file
    footers or a single column, and not with accumulators, which a repeated stage or a lost event
    would distort. ``rows_landed`` is the number of records the audit counted; reading any other
    number fails before silver or quarantine is touched. ``rows_skipped`` are records on pages that
    were left out because none of them is in scope.
    """
    silver_table = SnapshotTable(spark, lake.silver)

    def write_silver(surviving: DataFrame) -> dict[str, object]:
        return silver_table.write(_silver_from_survivors(surviving, spec, lineage), run_id)

    def keep_rejected(rejected: DataFrame) -> None:
        complete = rejected.withColumns(dict(lineage or {}))
        write_quarantine(complete.select(*spec.quarantine_columns), lake, run_id)

    def write_both(
        routes: DataFrame, rejected: DataFrame, surviving: DataFrame
    ) -> dict[str, int]:
        before = routes.agg(*route_counts()).first().asDict()
        for name in ("rows_in", "rows_out_of_scope"):
            before[name] += rows_skipped
        require_all_read(before["rows_in"], rows_landed)
        writes = (lambda: keep_rejected(rejected), lambda: write_silver(surviving))
        # silver goes live once both are written
        version = silver_table.commit(run_together(spark, *writes)[1])
        kept = silver_table.as_of_version(version).agg(*status_counts()).first().asDict()
        ledger = ledger_from_counts(before, kept)
        require_balanced(ledger)
        return ledger

    if not stage:
        routes = flat.select(route(spec).alias(ROUTE))
        return write_both(routes, quarantine_split(flat, spec), survivors(flat, spec))

    staged = scratch_path(spark, "routed")
    rows = routed(flat, spec)
    try:
        rows.write.partitionBy(ROUTE).parquet(staged)
        kept = spark.read.schema(rows.schema).parquet(staged)
        rejected = kept.filter(F.col(ROUTE) == QUARANTINED).drop(ROUTE)
        surviving = kept.filter(F.col(ROUTE) == SURVIVOR).drop(ROUTE, REASON, PAYLOAD)
        return write_both(kept.select(ROUTE), rejected, surviving)
    finally:
        storage.delete(spark, staged)
