"""The count ledger of a run.

Every input row is counted exactly once:
``rows_in = rows_out_of_scope + rows_quarantined + rows_deduped + rows_warned + rows_ok``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.errors import ContractError
from tidegate.functions.rules import STATUS_OK, STATUS_WARNING
from tidegate.operators.route import OUT_OF_SCOPE, QUARANTINED, ROUTE, SURVIVOR
from tidegate.spec import STATUS

LEDGER_COLUMNS = (
    "rows_in",
    "rows_out_of_scope",
    "rows_quarantined",
    "rows_deduped",
    "rows_warned",
    "rows_ok",
    "rows_silver",
)


def route_counts() -> list[Column]:
    """Aggregates over rows that carry ``route``."""
    at = F.col(ROUTE)
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(at == OUT_OF_SCOPE).alias("rows_out_of_scope"),
        F.count_if(at == QUARANTINED).alias("rows_quarantined"),
        F.count_if(at == SURVIVOR).alias("rows_surviving"),
    ]


def status_counts() -> list[Column]:
    """Aggregates over silver rows."""
    return [
        F.count_if(F.col(STATUS) == STATUS_WARNING).alias("rows_warned"),
        F.count_if(F.col(STATUS) == STATUS_OK).alias("rows_ok"),
        F.count(F.lit(1)).alias("rows_silver"),
    ]


def run_ledger(routed: DataFrame, silver: DataFrame) -> DataFrame:
    """The ledger as a one-row frame.

    Rows are never labelled as duplicates one by one, which would shuffle every losing row to its
    key. Losers are the survivors that are not in silver, and both sides are aggregates.
    """
    before = routed.agg(*route_counts())
    after = silver.agg(*status_counts())
    both = before.unionByName(after, allowMissingColumns=True)
    total = both.agg(*(F.max(name).alias(name) for name in both.columns))
    return total.select(
        "rows_in",
        "rows_out_of_scope",
        "rows_quarantined",
        (F.col("rows_surviving") - F.col("rows_silver")).alias("rows_deduped"),
        "rows_warned",
        "rows_ok",
        "rows_silver",
    )


def ledger_from_counts(before: Mapping[str, int], after: Mapping[str, int]) -> dict[str, int]:
    """The same ledger from the two sets of counts."""
    counts = {**before, **after}
    counts["rows_deduped"] = counts["rows_surviving"] - counts["rows_silver"]
    return {name: counts[name] for name in LEDGER_COLUMNS}


def require_all_read(rows_in: int, rows_landed: int | None) -> None:
    """Raise unless as many records were read as the page audit counted, where it is known."""
    if rows_landed is not None and rows_landed != rows_in:
        raise ContractError(f"{rows_in} records were read but {rows_landed} were landed")


def require_balanced(ledger: Mapping[str, int]) -> None:
    """Raise unless every record is in exactly one part of the ledger."""
    parts = (
        ledger["rows_out_of_scope"]
        + ledger["rows_quarantined"]
        + ledger["rows_deduped"]
        + ledger["rows_warned"]
        + ledger["rows_ok"]
    )
    if parts != ledger["rows_in"]:
        raise ContractError(f"the ledger does not add up to rows_in: {dict(ledger)}")


def disposition_counts(ledger: DataFrame) -> DataFrame:
    """The ledger turned to one row per disposition."""
    parts = F.map_from_arrays(
        F.array(*map(F.lit, ("OUT_OF_SCOPE", "QUARANTINED", "DUPLICATE", "WARNING", "OK"))),
        F.array(
            "rows_out_of_scope", "rows_quarantined", "rows_deduped", "rows_warned", "rows_ok"
        ),
    )
    return ledger.select(F.explode(parts).alias("disposition", "n_rows"))
