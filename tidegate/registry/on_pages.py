"""Operators on page documents. Spark packs the orders table into pages of 1,000 records first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.flatten import flatten, flatten_table
from tidegate.operators.ledger import run_ledger
from tidegate.operators.route import quarantine_split, routed
from tidegate.plans.chapters import CHAPTERS
from tidegate.plans.silver import silver_of
from tidegate.registry.base import register, table
from tidegate.session import scratch_path
from tidegate.sources.pages import (
    missing_pages,
    page_audit,
    page_statistics,
    parse_documents,
    read_documents,
    read_page_files,
)
from tidegate.spec import Field, OrderBy, ProductSpec

PAGE_SIZE = 1000
RUN_ID = "run_20260102T030405Z"
INGESTED_AT = "2026-01-02T03:04:05+00:00"

POINTS_SQL = """
flat AS (
  SELECT concat('C-', o_custkey) AS chapter_id, concat('Chapter ', o_orderpriority) AS chapter_name,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'unknown' WHEN '2-HIGH' THEN ''
         WHEN '3-MEDIUM' THEN NULL ELSE concat('City ', o_custkey) END AS city,
    CASE o_orderstatus WHEN 'F' THEN 'CA' WHEN 'O' THEN 'OR' ELSE 'NV' END AS state,
    o_totalprice / 1000 - 250 AS longitude,
    CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN NULL
         ELSE CAST(o_custkey % 181 - 90 AS DOUBLE) END AS latitude,
    o_orderkey AS source_object_id
  FROM orders
),
routed AS (
  SELECT *, CASE WHEN state NOT IN ('CA', 'OR', 'WA') THEN 'OUT_OF_SCOPE'
    WHEN longitude IS NULL OR longitude < -180 OR longitude > 180
      OR latitude IS NULL OR latitude < -90 OR latitude > 90 THEN 'QUARANTINED'
    ELSE 'SURVIVOR' END AS route
  FROM flat
),
silver AS (
  SELECT *, city IS NULL OR city = '' OR upper(city) = 'UNKNOWN' AS no_city FROM routed
  WHERE route = 'SURVIVOR'
  QUALIFY row_number() OVER (PARTITION BY chapter_id
    ORDER BY source_object_id DESC NULLS LAST, chapter_name ASC NULLS FIRST) = 1
)"""


def point_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested records with padded text, placeholders, and wrong or missing values."""
    priority, status, customer = (
        F.col("o_orderpriority"),
        F.col("o_orderstatus"),
        F.col("o_custkey"),
    )
    city = (
        F.when(priority == "1-URGENT", F.lit(" unknown "))
        .when(priority == "2-HIGH", F.lit("   "))
        .when(priority != "3-MEDIUM", F.concat(F.lit("City "), customer.cast("string")))
    )
    state = F.when(status == "F", F.lit(" ca ")).when(status == "O", F.lit("OR")).otherwise(
        F.lit("nv ")
    )
    not_measured = F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    latitude = F.when(not_measured, F.lit("not measured")).otherwise(
        (customer % 181 - 90).cast("string")
    )
    record = F.struct(
        F.struct(
            F.col("o_orderkey").alias("OBJECTID"),
            F.concat(F.lit("Chapter "), priority, F.lit(" ")).alias("University_Chapter"),
            city.alias("City"),
            state.alias("State"),
            F.concat(F.lit(" C-"), customer.cast("string")).alias("ChapterID"),
            F.lit("a person's name").alias("MEVR_RD"),
        ).alias("attributes"),
        F.struct((F.col("o_totalprice") / 1000 - 250).alias("x"), latitude.alias("y")).alias(
            "geometry"
        ),
    )
    page_no = F.expr(f"o_orderkey div {PAGE_SIZE}") + 1
    return table(spark, sf_dir, "orders").select(
        page_no.alias("page_no"), priority.alias("run_id"), record.alias("feature")
    )


def page_documents(records: DataFrame, *by: str) -> DataFrame:
    """Pack records into page documents; a page never holds more than ``PAGE_SIZE`` records."""
    last_page = records.agg(F.max("page_no")).scalar()
    more = F.col("page_no") < last_page
    return (
        records.groupBy(*by, "page_no")
        .agg(F.collect_list("feature").alias("features"))
        .select(
            *by,
            "page_no",
            F.to_json(F.struct("features", more.alias("exceededTransferLimit"))).alias("document"),
        )
    )


def detailed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with attributes the spec does not name: a number, and a person's name under
    a forbidden name in other case, nested in an array and next to something that may be shown."""
    person = F.struct(F.lit("a person's name").alias("mevr_rd"), F.lit("by mail").alias("reached"))
    records = point_records(spark, sf_dir)
    rank = F.expr("feature.attributes.OBJECTID % 7")
    return records.withColumn(
        "feature",
        F.col("feature")
        .withField("attributes.Rank", rank)
        .withField("attributes.Contacts", F.array(F.struct(F.array(person).alias("people")))),
    )


def flat_points(spark: SparkSession, sf_dir: str, detailed: bool = False) -> DataFrame:
    records = detailed_records(spark, sf_dir) if detailed else point_records(spark, sf_dir)
    documents = page_documents(records)
    return flatten(parse_documents(documents, CHAPTERS), CHAPTERS)


def lineage(run_id: str = RUN_ID) -> dict[str, Column]:
    return {
        "ingest_run_id": F.lit(run_id),
        "ingested_at_utc": F.lit(INGESTED_AT).cast("timestamp"),
    }


@register(
    f"""WITH {POINTS_SQL}
SELECT chapter_id, chapter_name, city, state, longitude, latitude, source_object_id FROM flat"""
)
def page_explode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_points(spark, sf_dir).select(*CHAPTERS.field_columns)


@register(
    """SELECT o_orderkey // 1000 + 1 AS page_no, count(*) AS n_records,
       o_orderkey // 1000 < (SELECT max(o_orderkey) // 1000 FROM orders) AS more
FROM orders GROUP BY o_orderkey // 1000"""
)
def page_statistics_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = page_documents(point_records(spark, sf_dir))
    return page_statistics(documents, CHAPTERS).select("page_no", "n_records", "more")


@register(
    """SELECT count(DISTINCT o_orderkey // 1000) AS pages, count(*) AS rows_in, 0::BIGINT AS error_pages,
       0::BIGINT AS shapeless_pages, true AS is_complete FROM orders"""
)
def page_audit_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = page_documents(point_records(spark, sf_dir))
    return page_audit(page_statistics(documents, CHAPTERS))


@register(
    """WITH pages AS (
  SELECT o_orderpriority AS run_id, o_orderkey // 1000 + 1 AS page_no, count(*) AS n,
         (SELECT max(o_orderkey) // 1000 + 1 FROM orders) AS last_page
  FROM orders GROUP BY ALL),
seeded AS (
  SELECT run_id, page_no, page_no < last_page OR run_id = '3-MEDIUM' AS more,
    run_id = '5-LOW' AND page_no = last_page AS is_error,
    CASE WHEN run_id IN ('4-NOT SPECIFIED', '5-LOW') AND page_no = last_page THEN NULL ELSE n END AS n
  FROM pages),
judged AS (
  SELECT *, CASE WHEN is_error THEN false ELSE more AND coalesce(n, 0) > 0 END AS goes_on FROM seeded)
SELECT run_id, count(*) AS pages, coalesce(sum(n), 0)::BIGINT AS rows_in,
  count(*) FILTER (is_error) AS error_pages,
  count(*) FILTER (n IS NULL AND NOT is_error) AS shapeless_pages,
  min(page_no) = 1 AND max(page_no) = count(*) AND count(*) FILTER (NOT goes_on) = 1
    AND max(page_no) FILTER (NOT goes_on) IS NOT DISTINCT FROM max(page_no) AS is_complete
FROM judged GROUP BY run_id"""
)
def page_audit_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five runs, one per priority. The last page of one carries an error, of one has no records
    array, and of one still says there is more."""
    documents = page_documents(point_records(spark, sf_dir), "run_id")
    last_page = documents.agg(F.max("page_no")).scalar()
    is_last = F.col("page_no") == last_page
    run = F.col("run_id")
    text = (
        F.when(is_last & (run == "5-LOW"), F.lit('{"error": {"code": 400}}'))
        .when(is_last & (run == "4-NOT SPECIFIED"), F.lit('{"objectIdFieldName": "OBJECTID"}'))
        .when(
            is_last & (run == "3-MEDIUM"),
            F.replace(
                "document",
                F.lit('"exceededTransferLimit":false'),
                F.lit('"exceededTransferLimit":true'),
            ),
        )
        .otherwise(F.col("document"))
    )
    return page_audit(page_statistics(documents.withColumn("document", text), CHAPTERS), ["run_id"])


@register(
    """WITH pages AS (
  SELECT o_orderpriority AS run_id, o_orderkey // 20 + 1 AS page_no,
    o_orderkey // 20 < (SELECT max(o_orderkey) // 20 FROM orders) OR o_orderpriority = '3-MEDIUM' AS more
  FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderkey // 20 % 50 = 7)
    AND NOT (o_orderpriority = '2-HIGH' AND o_orderkey // 20 < 3) GROUP BY ALL),
stepped AS (
  SELECT run_id, page_no, more, coalesce(lag(page_no) OVER w, 0) AS before, lead(page_no) OVER w AS next_page
  FROM pages WINDOW w AS (PARTITION BY run_id ORDER BY page_no))
SELECT run_id, before + 1 AS first_missing, page_no - 1 AS last_missing FROM stepped WHERE page_no > before + 1
UNION ALL SELECT run_id, page_no + 1, NULL FROM stepped WHERE next_page IS NULL AND more"""
)
def page_gaps_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page ranges each of five runs lacks: one has holes all over, one begins late, and the last
    page of one says there is more. Small pages make some runs lack others by themselves."""
    records = point_records(spark, sf_dir).withColumn(
        "page_no", F.expr("feature.attributes.OBJECTID div 20") + 1
    )
    run, number = F.col("run_id"), F.col("page_no") - 1
    lost = ((run == "5-LOW") & (number % 50 == 7)) | ((run == "2-HIGH") & (number < 3))
    documents = page_documents(records, "run_id").filter(~lost)
    endless = F.replace(
        "document", F.lit('"exceededTransferLimit":false'), F.lit('"exceededTransferLimit":true')
    )
    text = F.when(run == "3-MEDIUM", endless).otherwise(F.col("document"))
    return missing_pages(page_statistics(documents.withColumn("document", text), CHAPTERS), ["run_id"])


SILVER_OF_PAGES_SQL = f"""WITH {POINTS_SQL}
SELECT chapter_id, chapter_name, city, state, longitude, latitude, source_object_id,
       CASE WHEN no_city THEN 'WARNING' ELSE 'OK' END AS dq_status,
       CASE WHEN no_city THEN 'MISSING_OR_UNKNOWN_CITY' ELSE '' END AS warnings,
       '{RUN_ID}' AS ingest_run_id, TIMESTAMP '2026-01-02 03:04:05' AS ingested_at
FROM silver"""


def _silver_of(flat: DataFrame) -> DataFrame:
    return silver_of(flat, CHAPTERS, lineage()).withColumns(
        {
            "warnings": F.array_join("dq_warnings", ","),
            "ingested_at": F.col("ingested_at_utc").cast("timestamp_ntz"),
        }
    ).drop("dq_warnings", "ingested_at_utc")


@register(SILVER_OF_PAGES_SQL)
def pages_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_of(flat_points(spark, sf_dir))


def _page_files(spark: SparkSession, sf_dir: str) -> str:
    """All pages as files, one document a file, in folders named after the page."""
    folder = scratch_path(spark, "page-files")
    documents = page_documents(point_records(spark, sf_dir)).select("page_no", "document")
    documents.write.partitionBy("page_no").text(folder)
    return folder


@register(SILVER_OF_PAGES_SQL)
def page_files_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page-file source, audited and transformed."""
    pages = read_page_files(spark, _page_files(spark, sf_dir), CHAPTERS, "*.txt")
    return _silver_of(flatten(pages, CHAPTERS))


@register(
    """SELECT o_orderkey // 1000 + 1 AS page_no, count(*) AS n_records FROM orders
GROUP BY o_orderkey // 1000"""
)
def page_files_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page file with its number and the size of its record array."""
    pages = read_page_files(spark, _page_files(spark, sf_dir), CHAPTERS, "*.txt")
    return pages.select("page_no", F.size("records").cast("long").alias("n_records"))


@register(
    """SELECT o_orderkey // 1000 + 1 AS page_no, count(*) AS n_records FROM orders
GROUP BY o_orderkey // 1000"""
)
def whole_document_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files read as whole documents, counted without building their records."""
    documents = read_documents(spark, _page_files(spark, sf_dir), "*.txt")
    return page_statistics(documents, CHAPTERS).select("page_no", "n_records")


@register(
    f"""WITH {POINTS_SQL}
SELECT chapter_id, state, longitude, latitude, source_object_id,
       'INVALID_COORDINATES' AS quarantine_reason,
       CAST(source_object_id AS VARCHAR) AS payload_id,
       CASE WHEN latitude IS NULL THEN 'not measured'
            ELSE CAST(CAST(latitude AS BIGINT) AS VARCHAR) END AS payload_y,
       source_object_id % 7 AS payload_rank, 'BIGINT' AS payload_rank_type, 'by mail' AS payload_reached,
       false AS has_personal_data
FROM routed WHERE route = 'QUARANTINED'"""
)
def pages_to_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evidence is the whole record, attributes the spec does not name included, with numbers as
    numbers, but for what it must not hold."""
    rejected = quarantine_split(flat_points(spark, sf_dir, detailed=True), CHAPTERS)
    seen = rejected.withColumn("_seen", F.parse_json("raw_payload"))
    rank = F.variant_get("_seen", "$.attributes.Rank", "variant")
    return seen.select(
        "chapter_id",
        "state",
        "longitude",
        "latitude",
        "source_object_id",
        "quarantine_reason",
        F.get_json_object("raw_payload", "$.attributes.OBJECTID").alias("payload_id"),
        F.get_json_object("raw_payload", "$.geometry.y").alias("payload_y"),
        F.variant_get(rank, "$", "long").alias("payload_rank"),
        F.schema_of_variant(rank).alias("payload_rank_type"),
        F.variant_get("_seen", "$.attributes.Contacts[0].people[0].reached", "string").alias(
            "payload_reached"
        ),
        F.col("raw_payload").contains("person").alias("has_personal_data"),
    )


NESTED = ProductSpec(
    fields=(Field("order_key", "o_orderkey", "bigint"),),
    key=("order_key",),
    order=(OrderBy("order_key"),),
    contract=(("order_key", "bigint"),),
    redact=("held.by_region.north.clerk",),
    forbidden_columns=("SECRET",),
    lineage={},
)


@register(
    f"""WITH {POINTS_SQL}
SELECT 'pages' AS source, count(*) AS n_payloads, 0::BIGINT AS n_leaking, count(*) AS n_with_siblings
FROM routed WHERE route = 'QUARANTINED'
UNION ALL SELECT 'table', count(*), 0, count(*) FROM orders"""
)
def hidden_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forbidden names in structs, arrays, maps and variants, in other case than declared: no payload
    of pages or of a table shows their values, and all show what is next to them."""
    secret, open_ = F.lit("a person's name").alias("Secret"), F.lit("by mail").alias("reached")
    clerk = F.struct(F.lit("a person's name").alias("clerk"), F.col("o_orderstatus").alias("status"))
    nested = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit("a person's name").alias("secret"),
        F.struct(
            F.array(F.struct(secret, open_)).alias("people"),
            F.create_map(F.lit("SECRET"), F.lit("a person's name"), F.lit("kept"), F.lit("x")).alias("pairs"),
            F.create_map(F.lit("north"), clerk).alias("by_region"),
            F.parse_json(F.lit('{"list": [{"sEcret": "a person\'s name", "kept": 1}]}')).alias("loose"),
        ).alias("held"),
    )
    of_table = flatten_table(nested, NESTED, {}).select(F.lit("table").alias("source"), "raw_payload")
    rejected = quarantine_split(flat_points(spark, sf_dir, detailed=True), CHAPTERS)
    payloads = of_table.unionByName(rejected.select(F.lit("pages").alias("source"), "raw_payload"))
    text = F.col("raw_payload")
    kept = text.contains('"reached":"by mail"') & (
        (F.col("source") == "pages")
        | (text.contains('"kept":1') & text.contains('"kept":"x"') & text.contains('"status":'))
    )
    return payloads.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_payloads"),
        F.count_if(text.contains("person")).alias("n_leaking"),
        F.count_if(kept).alias("n_with_siblings"),
    )


POINTS_LEDGER_SQL = f"""WITH {POINTS_SQL}
SELECT (SELECT count(*) FROM routed) AS rows_in,
  (SELECT count(*) FROM routed WHERE route = 'OUT_OF_SCOPE') AS rows_out_of_scope,
  (SELECT count(*) FROM routed WHERE route = 'QUARANTINED') AS rows_quarantined,
  (SELECT count(*) FROM routed WHERE route = 'SURVIVOR') - (SELECT count(*) FROM silver) AS rows_deduped,
  (SELECT count(*) FROM silver WHERE no_city) AS rows_warned,
  (SELECT count(*) FROM silver WHERE NOT no_city) AS rows_ok,
  (SELECT count(*) FROM silver) AS rows_silver"""


@register(POINTS_LEDGER_SQL)
def pages_to_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages are parsed once: the routed rows are staged, and both sides count those."""
    rows, staged = routed(flat_points(spark, sf_dir), CHAPTERS), scratch_path(spark, "routed")
    rows.write.parquet(staged)
    kept = spark.read.schema(rows.schema).parquet(staged)
    return run_ledger(kept, silver_of(kept, CHAPTERS, lineage()))
