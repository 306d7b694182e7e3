"""Publish gates: one aggregate over silver, then a decision on its single row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidegate.errors import GateError
from tidegate.functions.rules import STATUSES
from tidegate.spec import STATUS, ProductSpec


def group_metric(group: str) -> str:
    return f"rows_group_{group.lower()}"


def gate_columns(spec: ProductSpec) -> list[Column]:
    """Total rows, rows outside the status domain (NULL counts) and rows per expected group."""
    known_status = F.coalesce(F.col(STATUS).isin(*STATUSES), F.lit(False))
    return [
        F.count(F.lit(1)).alias("rows_silver"),
        F.count_if(~known_status).alias("rows_bad_status"),
        *(
            F.count_if(F.col(spec.group) == group).alias(group_metric(group))
            for group in spec.expected_groups
        ),
    ]


def gate_metrics(silver: DataFrame, spec: ProductSpec) -> DataFrame:
    return silver.agg(*gate_columns(spec))


def require_publishable(metrics: Row, spec: ProductSpec) -> None:
    """Raise on a silver without rows, a status outside the domain or an empty required group."""
    if not metrics["rows_silver"]:
        raise GateError("silver has no rows, there is nothing to publish")
    if metrics["rows_bad_status"]:
        raise GateError(
            f"{metrics['rows_bad_status']} row(s) have a {STATUS} that is none of {STATUSES}"
        )
    empty = [group for group in spec.required_groups if not metrics[group_metric(group)]]
    if empty:
        raise GateError(f"no rows for required {spec.group}: {', '.join(empty)}")


def group_counts(
    spark: SparkSession, df: DataFrame, column: str, expected: tuple[str, ...]
) -> DataFrame:
    """Rows per expected group, zero where a group has none.

    Rows of other groups are filtered out before counting, so both sides of the join have at most
    as many rows as the spec names groups.
    """
    counts = (
        df.filter(F.col(column).isin(*expected))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    wanted = spark.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, expected))).alias(column))
    return wanted.join(counts, column, "left").select(
        column, F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows")
    )
