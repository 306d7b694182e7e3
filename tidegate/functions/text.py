"""Text normalisation and tolerant typing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NORMALISERS = {"trim": F.trim, "upper": F.upper}


def normalised(column: Column, steps: tuple[str, ...]) -> Column:
    """Apply ``steps`` in order; ``trim`` removes spaces (U+0020) only, not tabs or newlines."""
    text = column.cast("string")
    for step in steps:
        text = NORMALISERS[step](text)
    return text


def typed(column: Column, data_type: str) -> Column:
    """Cast so that a malformed value becomes NULL instead of failing the job under ANSI."""
    return column if data_type == "string" else column.try_cast(data_type)
