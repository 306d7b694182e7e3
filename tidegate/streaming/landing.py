"""Append-by-run landing as a stream: every trigger lands what arrived since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.lake import Lake
from tidegate.operators.landing import land_documents
from tidegate.sources.pages import PAGE_FILE_GLOB, PAGE_FILE_NUMBER
from tidegate.spec import ProductSpec


def new_page_files(spark: SparkSession, incoming: str) -> DataFrame:
    """Page files as they arrive in a folder, as a stream of ``page_no`` and ``document``."""
    number = F.regexp_extract("_metadata.file_name", PAGE_FILE_NUMBER, 1)
    return (
        spark.readStream.format("text")
        .schema("value string")
        .option("wholetext", True)
        .option("pathGlobFilter", PAGE_FILE_GLOB)
        .load(incoming)
        .select(number.try_cast("long").alias("page_no"), F.col("value").alias("document"))
    )


def land_stream(
    documents: DataFrame,
    lake: Lake,
    spec: ProductSpec,
    checkpoint: str,
    run_prefix: str = "stream",
    source_detail: str | None = None,
) -> StreamingQuery:
    """Land the documents that arrived since the last trigger as one run, then stop.

    The checkpoint remembers what was seen, so a daily job that starts this query lands everything
    once. The run id is made of the batch number: a batch that is replayed after a failure lands
    under the same id and replaces its first attempt. A batch is held to the same audit as any
    other landing, so the pages of a run must arrive together.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            run_id = f"{run_prefix}_{batch_id:08d}"
            land_documents(
                batch.sparkSession,
                batch,
                lake,
                spec,
                run_id,
                source="stream",
                source_detail=source_detail,
            )

    return (
        documents.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_new_pages(
    spark: SparkSession,
    incoming: str,
    lake: Lake,
    spec: ProductSpec,
    checkpoint: str,
    run_prefix: str = "stream",
) -> StreamingQuery:
    """Land the page files that are new in ``incoming``."""
    arrived = new_page_files(spark, incoming)
    return land_stream(arrived, lake, spec, checkpoint, run_prefix, incoming)
