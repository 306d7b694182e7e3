"""Column expressions: text normalisation, quality predicates, run ids."""

from tidegate.functions.rules import (
    annotate,
    blank_or_literal,
    outside_range,
    quarantine_reason,
    warnings_array,
)
from tidegate.functions.text import normalised, typed
from tidegate.functions.runs import run_id_at, run_id_of

__all__ = [
    "annotate",
    "blank_or_literal",
    "run_id_at",
    "normalised",
    "outside_range",
    "quarantine_reason",
    "run_id_of",
    "typed",
    "warnings_array",
]
