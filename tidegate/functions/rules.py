"""Hard and soft quality predicates, and their annotation on a frame.

All of them are native expressions that take part in whole-stage code generation, so a rule
costs no Python round trip and can be tested by itself on a literal frame.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from tidegate.spec import FailingRule

STATUS_OK = "OK"
STATUS_WARNING = "WARNING"
STATUSES = (STATUS_OK, STATUS_WARNING)


def outside_range(column: Column, low: float, high: float) -> Column:
    """True when the value is NULL, NaN or outside ``[low, high]``; never NULL."""
    return column.isNull() | F.isnan(column) | (column < F.lit(low)) | (column > F.lit(high))


def blank_or_literal(column: Column, literals: Iterable[str] = ("UNKNOWN",)) -> Column:
    """True when the text is NULL, only spaces, or one of ``literals`` in any case."""
    text = F.upper(F.trim(column))
    return column.isNull() | text.isin("", *(literal.upper() for literal in literals))


def failed(rule: FailingRule) -> Column:
    """The verdict of one rule; NULL counts as failed.

    Only rules that can yield NULL are wrapped: a bare comparison can be pushed to the scan.
    """
    verdict = rule.fails()
    return verdict if rule.never_null else F.coalesce(verdict, F.lit(True))


def any_failed(rules: Sequence[FailingRule]) -> Column:
    """True when any rule fails; never NULL, so filtering by this column and by its negation always
    splits a frame without losing rows."""
    return reduce(or_, map(failed, rules)) if rules else F.lit(False)


def quarantine_reason(rules: Sequence[FailingRule]) -> Column:
    """Code of the first hard rule that fails, NULL for a row that passes them all."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*(F.when(failed(rule), F.lit(rule.code)) for rule in rules))


def warnings_array(rules: Sequence[FailingRule]) -> Column:
    """Codes of all failed soft rules in rule order; an empty array for a clean row.

    ``concat`` of one-element arrays is used because a higher-order ``filter`` would take the
    whole projection out of generated code.
    """
    empty = F.array().cast("array<string>")
    if not rules:
        return empty
    return F.concat(
        *(F.when(failed(rule), F.array(F.lit(rule.code))).otherwise(empty) for rule in rules)
    )


def soft_status(rules: Sequence[FailingRule]) -> Column:
    return F.when(any_failed(rules), F.lit(STATUS_WARNING)).otherwise(F.lit(STATUS_OK))


def with_soft_flags(df: DataFrame, rules: Sequence[FailingRule]) -> DataFrame:
    """Add ``dq_status`` and ``dq_warnings``."""
    return df.withColumns({"dq_status": soft_status(rules), "dq_warnings": warnings_array(rules)})


def annotate(df: DataFrame, hard: Sequence[FailingRule], soft: Sequence[FailingRule]) -> DataFrame:
    """Add ``is_quarantined``, ``quarantine_reason``, ``dq_status`` and ``dq_warnings``."""
    return df.withColumns(
        {
            "is_quarantined": any_failed(hard),
            "quarantine_reason": quarantine_reason(hard),
            "dq_status": soft_status(soft),
            "dq_warnings": warnings_array(soft),
        }
    )
