"""Row history: since when, and until when, each key had which values in a table's snapshots.

An interval names the publication a value first appears in and the one it is gone from; equal values
of neighbouring publications are one interval, and a key that was absent in between has two. Two
ways lead to the same rows: ``row_history`` over all snapshots at once, one exchange on the key, and
``extend_history``, which joins a kept history with one more snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.operators.snapshots import SnapshotTable

FROM, TO = "from_run", "to_run"


def _values(df: DataFrame, key: Sequence[str], compare: Sequence[str] | None) -> list[str]:
    return list(compare) if compare is not None else [c for c in df.columns if c not in key]


def row_history(
    snapshots: Sequence[tuple[str, DataFrame]], key: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """key, compared columns, ``from_run`` and ``to_run`` (NULL while the value is live).

    ``snapshots`` are the run ids and rows of successive publications, each unique by the key, the
    NULL key included. A key has a row for each snapshot at most, so no key is hot.
    """
    if not snapshots:
        raise ValueError("a history needs a snapshot")
    values = _values(snapshots[0][1], key, compare)
    rows = reduce(
        DataFrame.unionByName,
        (df.select(*key, F.struct(*values).alias("row"), F.lit(at).alias("at")) for at, (_, df) in enumerate(snapshots)),
    )
    in_order = Window.partitionBy(*key).orderBy("at")
    goes_on = (F.lag("at").over(in_order) == F.col("at") - 1) & F.lag("row").over(in_order).eqNullSafe(F.col("row"))
    started = rows.withColumn("starts", F.when(goes_on, 0).otherwise(1))
    intervals = (
        started.withColumn("interval", F.sum("starts").over(in_order))
        .groupBy(*key, "interval")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.min_by("row", "at").alias("row"))
    )
    runs = F.array(*(F.lit(run_id) for run_id, _ in snapshots))
    return intervals.select(
        *key,
        *(F.col(f"row.{name}").alias(name) for name in values),
        F.get(runs, F.col("first")).alias(FROM),
        F.get(runs, F.col("last") + 1).alias(TO),
    )


def first_history(snapshot: DataFrame, run_id: str, key: Sequence[str], compare: Sequence[str] | None = None) -> DataFrame:
    """The history of a single publication: everything is live since then."""
    values = _values(snapshot, key, compare)
    return snapshot.select(
        *key, *values, F.lit(run_id).alias(FROM), F.lit(None).cast("string").alias(TO)
    )


def extend_history(history: DataFrame, snapshot: DataFrame, run_id: str, key: Sequence[str]) -> DataFrame:
    """The history with one more publication: one full join of its live rows with the snapshot.

    Closed intervals are passed through unread. NULL keys are one key.
    """
    values = [c for c in history.columns if c not in (*key, FROM, TO)]
    live = history.filter(F.col(TO).isNull())
    old = live.select(*(F.col(k).alias(f"_old_{k}") for k in key), F.struct(*values).alias("old"), FROM)
    new = snapshot.select(*(F.col(k).alias(f"_new_{k}") for k in key), F.struct(*values).alias("new"))
    same_key: Column = reduce(and_, (F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in key))
    # a field that is never NULL tells a row's absence from NULL values in it
    joined = old.withColumn("was", F.lit(True)).join(new.withColumn("is", F.lit(True)), same_key, "full_outer")
    both = F.col("was").isNotNull() & F.col("is").isNotNull()
    unchanged = both & F.col("old").eqNullSafe(F.col("new"))
    earlier = F.struct(
        *(F.col(f"_old_{k}").alias(k) for k in key),
        F.col("old").alias("row"),
        F.col(FROM).alias(FROM),
        F.when(~unchanged, F.lit(run_id)).alias(TO),
    )
    later = F.struct(
        *(F.col(f"_new_{k}").alias(k) for k in key),
        F.col("new").alias("row"),
        F.lit(run_id).alias(FROM),
        F.lit(None).cast("string").alias(TO),
    )
    made = F.array_compact(
        F.array(
            F.when(F.col("was").isNotNull(), earlier),
            F.when(F.col("is").isNotNull() & ~unchanged, later),
        )
    )
    extended = joined.select(F.explode(made).alias("made")).select("made.*")
    closed = history.filter(F.col(TO).isNotNull())
    return closed.unionByName(
        extended.select(*key, *(F.col(f"row.{name}").alias(name) for name in values), FROM, TO)
    )


def publications(table: SnapshotTable) -> list[tuple[str, DataFrame]]:
    """Run id and rows of each publication of a snapshot table that is still there, oldest first.

    The log has a row for each publication; expired ones are left out.
    """
    log = table.history().select("version", "run_id", "folder").orderBy("version").collect()
    return [(row["run_id"], table.as_of_version(row["version"])) for row in log if table.is_kept(row["folder"])]
