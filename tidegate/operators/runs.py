"""The run table: one row per finished run, columns may be added over time.

Summaries are appended, so a repeated run writes a second row; readers keep the newest of a run id.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import storage
from tidegate.lake import Lake
from tidegate.session import single_row

#: Numbers of a summary that are not counts of rows.
NUMBERS = frozenset({"pages", "version"})


def summary_type(name: str) -> str:
    """Counts, and what is known to be a number, are long; everything else is text.

    A column's name alone decides: a value would decide differently in different runs, and a column
    of two types cannot be read back.
    """
    return "long" if name.startswith("rows_") or name in NUMBERS else "string"


def summary_frame(spark: SparkSession, summary: Mapping[str, object]) -> DataFrame:
    """A run summary as a one-row frame."""
    return single_row(spark, summary, {name: summary_type(name) for name in summary})


def append_run(spark: SparkSession, lake: Lake, summary: Mapping[str, object]) -> None:
    summary_frame(spark, summary).write.mode("append").parquet(lake.runs)


def read_runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """The newest summary of each run; columns a run did not have are NULL."""
    if not storage.exists(spark, lake.runs):
        return spark.createDataFrame([], "run_id string, finished_at_utc string")
    rows = spark.read.option("mergeSchema", True).parquet(lake.runs)
    finished = F.col("finished_at_utc") if "finished_at_utc" in rows.columns else F.lit(None)
    # of summaries without a time the file written last counts
    order = F.struct(
        F.coalesce(finished.cast("string"), F.lit("")),
        F.col("_metadata.file_modification_time"),
        F.col("_metadata.file_name"),
    )
    newest = F.max_by(F.struct(*rows.columns), order)
    return rows.groupBy("run_id").agg(newest.alias("_newest")).select("_newest.*")


def newest_first(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """Runs by time of finishing, the latest first."""
    ordered = runs.orderBy(F.col("finished_at_utc").desc_nulls_last(), F.col("run_id").desc())
    return ordered if limit is None else ordered.limit(limit)


def union_ledgers(*ledgers: DataFrame) -> DataFrame:
    """Append ledgers with different columns; what one lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ledgers)
