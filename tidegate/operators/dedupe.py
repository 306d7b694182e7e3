"""Latest-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.spec import OrderBy


def _comparable(field: T.StructField) -> Column:
    unordered = any(kind in field.dataType.simpleString() for kind in ("map<", "variant"))
    return F.to_json(F.struct(F.col(field.name))) if unordered else F.col(field.name)


def latest_wins(df: DataFrame, key: Sequence[str], order: Sequence[OrderBy]) -> DataFrame:
    """Keep the first row of each key under ``order``; NULL keys form one group.

    Rows that tie on the whole order are told apart by their remaining columns, so the result
    does not depend on how the input was split; a column without an order of its own, one that holds
    a map, is compared by its JSON. Because only the first row is kept, Spark plans a
    group limit before the exchange: every input task sends at most one row per key, and a key
    that holds a third of the data reaches its reducer as one row per task.
    """
    ordered = {term.column for term in order}
    ties = [
        _comparable(f).asc_nulls_first()
        for f in df.schema.fields
        if f.name not in ordered and f.name not in key
    ]
    window = Window.partitionBy(*key).orderBy(*(term.expression() for term in order), *ties)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
    )
