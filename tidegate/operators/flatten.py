"""Explode pages to records and flatten records to typed, normalised, published names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.evidence import Shown
from tidegate.functions.text import normalised, typed
from tidegate.spec import PAYLOAD, Field, ProductSpec

RECORD = "record"


def explode_records(pages: DataFrame) -> DataFrame:
    """One row per record; pages with no or an empty array yield none.

    The outer form with a position filter keeps a NULL element as a row, as a plain explode does,
    but stops the optimizer from adding a filter on the array below the explode, which would
    parse a page document twice.
    """
    kept = [c for c in pages.columns if c != "records"]
    return (
        pages.select(*kept, F.posexplode_outer("records").alias("_position", RECORD))
        .filter(F.col("_position").isNotNull())
        .drop("_position")
    )


def _typed_field(field: Field, source: Column) -> Column:
    if field.type == "string":
        return normalised(source, field.normalise).alias(field.name)
    return typed(source, field.type).alias(field.name)


def payload(record: Column, kind: T.DataType, shown: Shown) -> Column:
    """A value as JSON, empty fields included, without what may not be shown."""
    return F.to_json(shown.typed(record, kind), {"ignoreNullFields": "false"})


def flatten(
    pages: DataFrame, spec: ProductSpec, lineage: Mapping[str, Column] | None = None
) -> DataFrame:
    """Pages to flat rows: the spec's fields, the payload and, when given, the lineage columns.

    Fields are read as text and typed afterwards. The payload is all of the record, whether the spec
    names it or not, with numbers as numbers; of a record that repeats a name, which no variant can
    hold, it is the fields. It is a plain projection of the record's text: where only some rows keep
    it, it is worked out after their filter, and where no row keeps it, it is pruned.
    """
    read = explode_records(pages).withColumn("_fields", F.from_json(RECORD, spec.record_schema()))
    whole = payload(F.try_parse_json(RECORD), T.VariantType(), spec.shown())
    fields = payload(F.col("_fields"), spec.record_schema(), spec.shown())
    return read.select(
        *(_typed_field(f, F.col(f"_fields.{f.path}")) for f in spec.fields),
        F.coalesce(whole, fields).alias(PAYLOAD),
        *(column.alias(name) for name, column in (lineage or {}).items()),
    )


def flatten_table(
    df: DataFrame, spec: ProductSpec, lineage: Mapping[str, Column] | None = None
) -> DataFrame:
    """The same flat rows from a table whose columns are addressed by the field paths.

    Forbidden names and redacted paths, nested ones too, never enter the payload.
    """
    row = F.struct(*(F.col(_quoted(c)) for c in df.columns))
    return df.select(
        *(_typed_field(f, F.col(f.path)) for f in spec.fields),
        payload(row, df.schema, spec.shown()).alias(PAYLOAD),
        *(column.alias(name) for name, column in (lineage or {}).items()),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
