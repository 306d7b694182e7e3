"""Run identifiers."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed format of a run id, once for the driver clock and once for a timestamp column.
RUN_ID_STRFTIME = "run_%Y%m%dT%H%M%SZ"
RUN_ID_PATTERN = "'run_'yyyyMMdd'T'HHmmss'Z'"


def run_id_at(moment: datetime) -> str:
    """The run id of a moment, in UTC whatever its own zone; a moment without a zone is refused."""
    if moment.tzinfo is None:
        raise ValueError("a run id needs a time with a zone")
    return f"{moment.astimezone(timezone.utc):{RUN_ID_STRFTIME}}"


def run_id_of(timestamp: Column) -> Column:
    """The run id a timestamp column stands for; the session time zone must be UTC."""
    return F.date_format(timestamp, RUN_ID_PATTERN)
