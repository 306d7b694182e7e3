"""The published contract: projection, schema equality, guarantees and freshness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.errors import ContractError
from tidegate.functions.rules import STATUS_OK, STATUSES, any_failed
from tidegate.spec import STATUS, WARNINGS, ProductSpec


def contract_projection(silver: DataFrame, spec: ProductSpec) -> DataFrame:
    """Exactly the contract's columns in its order; anything else stays behind."""
    return silver.select(*spec.contract_columns)


def require_contract_schema(df: DataFrame, spec: ProductSpec) -> None:
    """Raise unless names, order and types are the contract's and nothing forbidden is in."""
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if actual != list(spec.contract):
        raise ContractError(f"schema {actual} is not the contract {list(spec.contract)}")
    if exposed := spec.forbidden_among(df.columns):
        raise ContractError(f"forbidden columns published: {exposed}")


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, (F.col(name).isNull() for name in columns))


def contract_assertions(df: DataFrame, spec: ProductSpec) -> DataFrame:
    """Number of rows that break each guarantee, as one row.

    Everything is counted per key first, in the one aggregation that finds repeated keys; it
    combines map-side, so a repeated key costs its reducer one row per input task.
    """
    hard = any_failed(spec.hard_rules)
    known = F.coalesce(F.col(STATUS).isin(*STATUSES), F.lit(False))
    is_clean = F.coalesce(F.col(STATUS) == STATUS_OK, F.lit(False))
    no_warning = F.coalesce(F.size(WARNINGS) == 0, F.lit(False))
    per_key = df.groupBy(*spec.key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(hard).alias("hard"),
        F.count_if(~known).alias("status"),
        F.count_if(is_clean != no_warning).alias("warnings"),
        F.count_if(~spec.in_scope()).alias("scope"),
    )
    total = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast("long")
    return per_key.agg(
        total("n").alias("rows_checked"),
        total(F.col("n") - 1).alias("repeated_key"),
        total(F.when(_any_null(spec.key), F.col("n")).otherwise(0)).alias("null_key"),
        total("hard").alias("hard_rule_broken"),
        total("status").alias("status_outside_domain"),
        total("warnings").alias("warnings_disagree"),
        total("scope").alias("out_of_scope"),
    )


def require_contract(df: DataFrame, spec: ProductSpec, allow_null_key: bool = False) -> None:
    """Raise when any guarantee is broken."""
    found = contract_assertions(df, spec).first().asDict()
    found.pop("rows_checked")
    if allow_null_key:
        found.pop("null_key")
    broken = {name: n for name, n in found.items() if n}
    if broken:
        raise ContractError(f"contract broken: {broken}")


def freshness(df: DataFrame) -> DataFrame:
    """Newest ingest time and number of runs of a snapshot (a consistent one has one run)."""
    return df.agg(
        F.max("ingested_at_utc").alias("newest_ingested_at_utc"),
        F.count_distinct("ingest_run_id").alias("n_runs"),
        F.count_if(F.col("ingest_run_id").isNull()).alias("rows_without_run"),
    )


def overlap(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of left rows whose key also occurs on the right (quarantine against gold: none).

    Both sides are reduced to one row per key before the join, so a frequent key is one row in it.
    """
    counted = left.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    found = counted.join(right.select(*key).distinct(), list(key), "left_semi")
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_overlapping"))
