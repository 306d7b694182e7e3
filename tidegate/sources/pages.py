"""Page sources: one JSON document per page, each with an array of records.

Pages are read as whole documents: from a folder of page files, or from landed bronze, which holds
their text in a column, compresses, is splittable between pages and keeps the evidence verbatim.
``parse_documents`` is the one parser of both.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.errors import LandingError
from tidegate.spec import ProductSpec

# Fixed name of a page file; the digits are the page number.
PAGE_FILE_GLOB = "page_*.json"
PAGE_FILE_NUMBER = r"page_(\d+)\.json$"


# Spark names files itself: a page it has written has its number in the folder.
PAGE_FOLDER_NUMBER = r"/page_no=(\d+)/[^/]*$"


def _page_number() -> Column:
    in_name = F.regexp_extract(F.col("_metadata.file_name"), PAGE_FILE_NUMBER, 1)
    in_folder = F.regexp_extract(F.col("_metadata.file_path"), PAGE_FOLDER_NUMBER, 1)
    return F.coalesce(in_name.try_cast("long"), in_folder.try_cast("long")).alias("page_no")


def read_page_files(
    spark: SparkSession, folder: str, spec: ProductSpec, name_filter: str = PAGE_FILE_GLOB
) -> DataFrame:
    """Read a run folder of page files: ``page_no``, the record array, ``more`` and ``error``.

    The number is in the file's name, or in a ``page_no=`` folder around it.
    """
    # A name filter lists the folder once; a glob in the path would list every match by itself.
    return parse_documents(read_numbered(spark, folder, name_filter), spec)


def read_numbered(spark: SparkSession, folder: str, name_filter: str = PAGE_FILE_GLOB) -> DataFrame:
    """Page files as whole documents, each with the number in its name or folder, or NULL."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=name_filter)
    return files.select(_page_number(), F.col("value").alias("document"))


def read_documents(spark: SparkSession, path: str, name_filter: str = "*.json") -> DataFrame:
    """Read the whole documents of a folder, or one file, as text: ``page_no`` and ``document``.

    A file that is not named like a page (a single fixture, say) is page 1.
    """
    numbered = read_numbered(spark, path, name_filter)
    return numbered.withColumn("page_no", F.coalesce("page_no", F.lit(1).cast("long")))


def parse_documents(documents: DataFrame, spec: ProductSpec) -> DataFrame:
    """Parse ``document`` to ``records``, the JSON texts of the records, ``more`` and ``error``.

    The page is taken apart into the texts of its records, whatever they hold, so what one page looks
    like cannot change another. Fractions are written at double precision. Text that is no JSON has no
    records; other columns pass through.
    """
    light = F.from_json(
        "document",
        f"{_quoted(spec.records_field)} array<string>, {_quoted(spec.more_flag)} string, error string",
    )
    parsed = documents.withColumn("_page", light)
    kept = [c for c in documents.columns if c != "document"]
    return parsed.select(
        *kept,
        F.col(f"_page.{_quoted(spec.records_field)}").alias("records"),
        _is_true(F.col(f"_page.{_quoted(spec.more_flag)}")).alias("more"),
        F.col("_page.error").alias("error"),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _is_true(flag: Column) -> Column:
    return F.coalesce(F.lower(flag) == "true", F.lit(False))


#: A page with more distinct values of the scoped field than this is never skipped.
SCOPE_VALUES = 64


def page_statistics(documents: DataFrame, spec: ProductSpec, scope: bool = False) -> DataFrame:
    """Add ``n_records`` (NULL without a record array), ``more`` and ``error`` to page documents.

    The records are only counted: their fields are skipped by the parser, not built. With ``scope``
    the scoped field is read too, and its distinct values on the page are added as ``scope_values``,
    with ``scope_path`` for where they were found; both are NULL where there are too many.
    """
    path = spec.scope_path if scope else None
    leaf = "_skipped string"
    if path:
        *outer, name = path.split(".")
        leaf = f"{_quoted(name)} string"
        for parent in reversed(outer):
            leaf = f"{_quoted(parent)} struct<{leaf}>"
    light = F.from_json(
        "document",
        f"{_quoted(spec.records_field)} array<struct<{leaf}>>, {_quoted(spec.more_flag)} string, "
        "error string",
    )
    records = F.col(f"_page.{_quoted(spec.records_field)}")
    columns = [
        *documents.columns,
        F.when(records.isNotNull(), F.size(records).cast("long")).alias("n_records"),
        _is_true(F.col(f"_page.{_quoted(spec.more_flag)}")).alias("more"),
        F.col("_page.error").alias("error"),
    ]
    if scope:
        values = F.lit(None).cast("array<string>")
        if path:
            at = lambda r: reduce(lambda v, part: v[part], path.split("."), r)
            values = F.array_distinct(F.transform(records, at))
        columns.append(values.alias("_values"))
    counted = documents.withColumn("_page", light).select(*columns)
    if not scope:
        return counted
    few = F.size("_values") <= SCOPE_VALUES
    return counted.withColumns(
        {
            "scope_path": F.when(few, F.lit(path)).cast("string"),
            "scope_values": F.when(few, F.col("_values")),
        }
    ).drop("_values")


def out_of_scope(spec: ProductSpec) -> Column:
    """Whether ``scope_path`` and ``scope_values`` show that no record of a page is in scope.

    False wherever that is not known: for pages landed without the columns, under another path, or
    with too many values.
    """
    if spec.scope_path is None:
        return F.lit(False)
    none = ~F.exists("scope_values", spec.text_in_scope)
    return F.coalesce((F.col("scope_path") == spec.scope_path) & none, F.lit(False))


def page_audit(statistics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Audit pages in one aggregate, per run when ``by`` names the run columns.

    Paging goes on while a page says there is more and is not empty. A complete run therefore has
    page numbers 1..n without gaps or repeats, and exactly one page that ends the paging, the
    last one. All of it is expressed with aggregates that combine map-side, so no run is ever
    gathered or sorted in one task.
    """
    goes_on = F.col("more") & (F.coalesce(F.col("n_records"), F.lit(0)) > 0)
    counts = statistics.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.sum("n_records"), F.lit(0)).cast("long").alias("rows_in"),
        F.count_if(F.col("error").isNotNull()).alias("error_pages"),
        F.count_if(F.col("error").isNull() & F.col("n_records").isNull()).alias("shapeless_pages"),
        F.count_if(~goes_on).alias("ending_pages"),
        F.min("page_no").alias("first_page"),
        F.max("page_no").alias("last_page"),
        F.count_distinct("page_no").alias("distinct_pages"),
        F.max(F.when(~goes_on, F.col("page_no"))).alias("last_ending_page"),
    )
    gap_free = (
        (F.col("first_page") == 1)
        & (F.col("last_page") == F.col("pages"))
        & (F.col("distinct_pages") == F.col("pages"))
    )
    ends_once = (F.col("ending_pages") == 1) & (F.col("last_ending_page") == F.col("last_page"))
    return counts.select(
        *by,
        "pages",
        "rows_in",
        "error_pages",
        "shapeless_pages",
        F.coalesce(gap_free & ends_once, F.lit(False)).alias("is_complete"),
    )


def sound_page() -> Column:
    """Whether a page's statistics are those of a page with a record array and no error."""
    return F.col("error").isNull() & F.col("n_records").isNotNull()


#: Page numbers in one part of a run, when its gaps are looked for.
PAGES_PER_PART = 4096


def missing_pages(statistics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The ranges of page numbers a run lacks, ``first_missing`` and ``last_missing``, per run.

    Between and before the pages there are, every number counts. After the last page one range
    without an end is missing while that page says there is more. An error page, and a page without a
    record array, counts as missing. Numbers are looked at in parts of a fixed size, then the parts'
    ends among each other, so a run of any number of pages is spread over tasks: the second step has
    one row for each part.
    """
    by = list(by)
    sound = sound_page() & F.coalesce(F.col("page_no") >= 1, F.lit(False))
    goes_on = F.col("more") & (F.coalesce(F.col("n_records"), F.lit(0)) > 0)
    # what is no page stands in for a page 0 with more to come, so that its run is not overlooked;
    # copies of a page are one, and of copies that differ one that ends the paging decides
    pages = (
        statistics.select(
            *by,
            F.when(sound, F.col("page_no")).otherwise(0).alias("page_no"),
            F.when(sound, goes_on).otherwise(True).alias("goes_on"),
        )
        .groupBy(*by, "page_no")
        .agg(F.bool_and("goes_on").alias("goes_on"))
        .withColumn("part", F.floor(F.col("page_no") / PAGES_PER_PART))
    )
    inner = Window.partitionBy(*by, "part").orderBy("page_no")
    within = pages.select(*by, F.lag("page_no").over(inner).alias("before"), F.col("page_no").alias("after"))
    parts = pages.groupBy(*by, "part").agg(
        F.min("page_no").alias("first"),
        F.max("page_no").alias("last"),
        F.max_by("goes_on", "page_no").alias("goes_on"),
    )
    outer = Window.partitionBy(*by).orderBy("part")
    ends = parts.select(
        *by,
        F.coalesce(F.lag("last").over(outer), F.lit(0).cast("long")).alias("before"),
        F.col("first").alias("after"),
        F.when(F.lead("first").over(outer).isNull() & F.col("goes_on"), F.col("last")).alias("open"),
    )
    between = within.unionByName(ends.drop("open")).filter(F.col("after") > F.col("before") + 1)
    closed = between.select(
        *by, (F.col("before") + 1).alias("first_missing"), (F.col("after") - 1).alias("last_missing")
    )
    beyond = ends.filter(F.col("open").isNotNull()).select(
        *by, (F.col("open") + 1).alias("first_missing"), F.lit(None).cast("long").alias("last_missing")
    )
    return closed.unionByName(beyond)


def in_missing_pages(documents: DataFrame, statistics: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose ``page_no`` lies in a range ``missing_pages`` finds for the one
    run of ``statistics``, however many ranges there are.

    Those ranges hold every number from 1 up to the highest sound page that is no sound page, and all
    numbers beyond that page while it says there is more. So a join on the page number and one
    aggregate find them, where a join of numbers with ranges would pair every page with every range.
    """
    sound = sound_page() & F.coalesce(F.col("page_no") >= 1, F.lit(False))
    goes_on = F.col("more") & (F.coalesce(F.col("n_records"), F.lit(0)) > 0)
    pages = (
        statistics.select(
            F.when(sound, F.col("page_no")).otherwise(0).alias("page_no"),
            F.when(sound, goes_on).otherwise(True).alias("goes_on"),
        )
        .groupBy("page_no")
        .agg(F.bool_and("goes_on").alias("goes_on"))
    )
    last = pages.agg(
        F.max("page_no").alias("last_page"), F.max_by("goes_on", "page_no").alias("last_goes_on")
    )
    candidates = documents.filter(F.coalesce(F.col("page_no") >= 1, F.lit(False)))
    lacking = candidates.join(pages.filter(F.col("page_no") >= 1).select("page_no"), "page_no", "left_anti")
    within = (F.col("page_no") <= F.col("last_page")) | F.col("last_goes_on")
    return lacking.crossJoin(F.broadcast(last)).filter(F.coalesce(within, F.lit(False))).select(*documents.columns)


#: Ranges named in a refusal; ``missing_pages`` has them all.
RANGES_NAMED = 20


def missing_ranges(statistics: DataFrame) -> list[tuple[int, int | None]]:
    """The first ranges one run lacks, in order, as numbers."""
    found = missing_pages(statistics).orderBy("first_missing").limit(RANGES_NAMED + 1)
    return [(row["first_missing"], row["last_missing"]) for row in found.collect()]


def _named(ranges: Sequence[tuple[int, int | None]]) -> str:
    texts = [
        f"{first} and on" if last is None else str(first) if first == last else f"{first}-{last}"
        for first, last in ranges[:RANGES_NAMED]
    ]
    return ", ".join(texts) + (", ..." if len(ranges) > RANGES_NAMED else "")


def require_complete(audit: Row, missing: Sequence[tuple[int, int | None]] = ()) -> None:
    """Raise unless the one audit row describes a complete, well-formed, non-empty batch.

    ``missing`` are the ranges to name in the refusal.
    """
    lacking = f"; missing: {_named(missing)}" if missing else ""
    if audit["error_pages"]:
        raise LandingError(f"{audit['error_pages']} page(s) carry an error payload{lacking}", missing)
    if audit["shapeless_pages"]:
        raise LandingError(f"{audit['shapeless_pages']} page(s) have no record array{lacking}", missing)
    if not audit["is_complete"] and missing:
        raise LandingError(f"page numbers have gaps or the last page says there is more{lacking}", missing)
    if not audit["rows_in"]:
        raise LandingError("there is no record on any page")
    if not audit["is_complete"]:
        raise LandingError("page numbers have gaps or the last page says there is more")


def is_acceptable(audit: Row) -> bool:
    """Whether ``require_complete`` lets the batch pass."""
    return bool(
        audit["is_complete"] and audit["rows_in"] and not audit["error_pages"] and not audit["shapeless_pages"]
    )
