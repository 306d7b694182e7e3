"""Whether a product was published when it was due: on time, late, or not at all, day by day."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.errors import GateError

ON_TIME, LATE, MISSING = "ON_TIME", "LATE", "MISSING"


def publication_calendar(log: DataFrame, first: date, last: date, deadline: time) -> DataFrame:
    """day, first_published_at_utc and freshness for every day from ``first`` to ``last``.

    ``log`` has ``published_at_utc``. A day is served by its first publication, in UTC; it is LATE
    when that came after the deadline and MISSING when there was none. The calendar is made here, so
    days that left no trace in the log are found. The log is reduced to a row a day before the join.
    """
    days = log.sparkSession.range(0, (last - first).days + 1, 1, 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("day")
    )
    served = log.groupBy(F.to_date("published_at_utc").alias("day")).agg(
        F.min("published_at_utc").alias("first_published_at_utc")
    )
    seconds = timedelta(hours=deadline.hour, minutes=deadline.minute, seconds=deadline.second).total_seconds()
    due = F.col("day").cast("timestamp") + F.make_dt_interval(secs=F.lit(seconds))
    published = F.col("first_published_at_utc").cast("timestamp")
    return days.join(served, "day", "left").select(
        "day",
        "first_published_at_utc",
        F.when(published.isNull(), MISSING).when(published > due, LATE).otherwise(ON_TIME).alias("freshness"),
    )


def require_fresh(log: DataFrame, moment: datetime, deadline: time) -> None:
    """Raise unless the newest day that is due at ``moment`` has been published by then.

    Before the deadline yesterday is due, afterwards today. A publication after its deadline makes
    the product fresh again; ``publication_calendar`` still shows it as late.
    """
    if moment.tzinfo is None:
        raise ValueError("freshness needs a time with a zone")
    moment = moment.astimezone(timezone.utc)
    due = moment.date() if moment.time() >= deadline else moment.date() - timedelta(days=1)
    known = log.filter(F.col("published_at_utc") <= F.lit(moment.isoformat()).cast("timestamp"))
    newest = known.agg(F.max(F.to_date("published_at_utc")).alias("day")).first()["day"]
    if newest is None or newest < due:
        since = "never published" if newest is None else f"last published on {newest.isoformat()}"
        raise GateError(f"the product of {due.isoformat()} is due and was {since}")
