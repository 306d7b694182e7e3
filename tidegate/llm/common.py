"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import scratch_path

#: A word is a run of characters other than space and U+0009 to U+000D. ``bytes.split()`` cuts
#: UTF-8 at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts the lineage, survives lost executors."""
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fold(id_column: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n. A NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(spark_frame: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    row = spark_frame.agg(F.sum(F.octet_length(column).cast("long"))).first()
    return int(row[0] or 0)


def rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows as tuples, without a Python copy of more than one batch slice at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield from zip(*(part.column(name).to_pylist() for name in names))


def arrow_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, schema)], schema=schema
    )


def emitted(schema: pa.Schema, found: Iterator[tuple], size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Pack tuples into record batches."""
    held: list[tuple] = []
    for item in found:
        held.append(item)
        if len(held) >= size:
            yield arrow_batch(schema, *zip(*held))
            held = []
    if held:
        yield arrow_batch(schema, *zip(*held))
