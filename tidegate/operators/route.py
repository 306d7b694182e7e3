"""Scope filter, hard rules and the split into survivors and quarantine.

The order is part of the meaning. Scope comes first: a row outside it is nobody's concern, however
wrong its values. Quarantine comes before deduplication: a rejected record never displaces a valid
one of the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.rules import any_failed, quarantine_reason
from tidegate.spec import PAYLOAD, REASON, ProductSpec

ROUTE = "route"
OUT_OF_SCOPE = "OUT_OF_SCOPE"
QUARANTINED = "QUARANTINED"
SURVIVOR = "SURVIVOR"


def _carried(flat: DataFrame, spec: ProductSpec) -> list[str]:
    """The lineage columns a frame has; a single run's are constants that are added at the end."""
    return [name for name in spec.lineage if name in flat.columns]


def scope_filter(flat: DataFrame, spec: ProductSpec) -> DataFrame:
    return flat.filter(spec.scope_predicate())


def quarantine_split(flat: DataFrame, spec: ProductSpec) -> DataFrame:
    """In-scope rows that fail a hard rule, with the reason, payload and lineage."""
    rejected = scope_filter(flat, spec).filter(any_failed(spec.all_hard_rules))
    return rejected.select(
        *spec.field_columns,
        quarantine_reason(spec.all_hard_rules).alias(REASON),
        *_carried(flat, spec),
        PAYLOAD,
    )


def survivors(flat: DataFrame, spec: ProductSpec) -> DataFrame:
    """In-scope rows that pass every hard rule, without the payload."""
    passed = scope_filter(flat, spec).filter(~any_failed(spec.all_hard_rules))
    return passed.select(*spec.field_columns, *_carried(flat, spec))


def route(spec: ProductSpec) -> Column:
    """The route of a flat row as one expression; never NULL."""
    return (
        F.when(~spec.in_scope(), F.lit(OUT_OF_SCOPE))
        .when(any_failed(spec.all_hard_rules), F.lit(QUARANTINED))
        .otherwise(F.lit(SURVIVOR))
    )


def routed(flat: DataFrame, spec: ProductSpec) -> DataFrame:
    """Every flat row with its route and reason.

    Nothing is kept of an out-of-scope row but its route, and the payload of quarantined rows only,
    so what no output needs is neither built nor carried.
    """
    in_scope, failed = F.col(ROUTE) != OUT_OF_SCOPE, F.col(ROUTE) == QUARANTINED
    return flat.withColumn(ROUTE, route(spec)).select(
        *(
            F.when(in_scope, F.col(name)).alias(name)
            for name in (*spec.field_columns, *_carried(flat, spec))
        ),
        F.when(failed, quarantine_reason(spec.all_hard_rules)).alias(REASON),
        F.when(failed, F.col(PAYLOAD)).alias(PAYLOAD),
        ROUTE,
    )
