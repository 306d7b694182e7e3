"""Operators that write: each works in a fresh folder of the shared scratch root and returns what
it reads back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.errors import LandingError
from tidegate.lake import Lake
from tidegate.operators.contract import contract_projection
from tidegate.operators.history import extend_history, first_history, publications, row_history
from tidegate.operators.landing import land_documents, write_documents
from tidegate.operators.merge import change_totals, changes_by_bucket, compared_buckets
from tidegate.operators.quarantine import read_quarantine, write_quarantine
from tidegate.operators.route import quarantine_split
from tidegate.operators.runs import append_run, read_runs, summary_frame
from tidegate.operators.snapshots import SnapshotTable
from tidegate.plans.chapters import CHAPTERS
from tidegate.operators.flatten import flatten
from tidegate.plans.pipeline import run_folder, run_landed, run_pages
from tidegate.plans.publish import derived_ledger, publish_gold, register_views
from tidegate.plans.silver import silver_of, transform
from tidegate.registry.base import register, table
from tidegate.registry.on_pages import (
    POINTS_LEDGER_SQL,
    POINTS_SQL,
    RUN_ID,
    flat_points,
    lineage,
    page_documents,
    point_records,
)
from tidegate.registry.on_tables import (
    LEDGER_SQL,
    LINES,
    SILVER_SQL,
    flat_lines,
    ledger_lines,
    silver_lines,
)
from tidegate.session import scratch_path
from tidegate.sources.pages import in_missing_pages, page_audit, page_statistics, parse_documents
from tidegate.sources.runs import (
    LandedRun,
    find_run,
    landed_runs,
    read_landed_documents,
    read_landed_in_scope,
    write_sidecar,
)
from tidegate.streaming import land_stream

LINES_BY_RUN = LINES.with_changes(lineage={"ingest_run_id": "string"})
STARTED_AT = datetime.fromisoformat("2026-01-02T03:04:05+00:00")


def _lake(spark: SparkSession) -> Lake:
    return Lake(scratch_path(spark, "lake"), "points")


@register(
    """SELECT o_orderkey // 1000 + 1 AS page_no, count(*) AS n_records FROM orders
GROUP BY o_orderkey // 1000"""
)
def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the pages as a run, twice under the same id, and read the run back."""
    lake = _lake(spark)
    documents = page_documents(point_records(spark, sf_dir))
    for _ in range(2):
        land_documents(spark, documents, lake, CHAPTERS, RUN_ID, STARTED_AT)
    landed = read_landed_documents(spark, lake, find_run(spark, lake, RUN_ID))
    return page_statistics(landed, CHAPTERS).select("page_no", "n_records")


@register(
    """SELECT o_orderkey // 1000 + 1 AS page_no, count(*) AS n_records,
  (SELECT count(DISTINCT o_orderkey // 1000) FROM orders WHERE o_orderkey // 1000 % 3 <> 1) AS pages_kept
FROM orders GROUP BY o_orderkey // 1000"""
)
def landing_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch without every third page is refused and kept; landing the pages the refusals name, as
    often as there are more of them, completes it."""
    lake = _lake(spark)
    documents = page_documents(point_records(spark, sf_dir))
    fetched = documents.filter((F.col("page_no") - 1) % 3 != 1)
    attempt, pages_kept = None, None
    while True:
        try:
            run = land_documents(
                spark, fetched, lake, CHAPTERS, RUN_ID, STARTED_AT, keep_refused=True, completes=attempt
            )
            break
        except LandingError as refusal:
            attempt = refusal.attempt
            refused = spark.read.parquet(f"{lake.bronze}/{attempt}")
            if pages_kept is None:
                pages_kept = refused.count()
            # a refusal names the first ranges only; all that the refused batch lacks is fetched at once
            fetched = in_missing_pages(documents, refused)
    landed = page_statistics(read_landed_documents(spark, lake, run), CHAPTERS)
    return landed.select("page_no", "n_records", F.lit(pages_kept).cast("long").alias("pages_kept"))


PAGE_BY_STATE = "o_orderkey // 1000 * 3 + CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END"


@register(
    f"""WITH {POINTS_SQL}, pages AS (
  SELECT {PAGE_BY_STATE} AS page_no, any_value(o_orderstatus) AS status FROM orders GROUP BY 1)
SELECT s.*, (SELECT count(*) FROM pages) AS pages_landed,
  (SELECT count(*) FROM pages WHERE status IN ('F', 'O')) AS pages_parsed,
  (SELECT count(*) FROM routed WHERE route = 'OUT_OF_SCOPE') AS rows_skipped
FROM (SELECT chapter_id, chapter_name, state, longitude, latitude, source_object_id FROM silver) s"""
)
def scope_skipped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of one state each: those out of scope are known from what landing noted of them and are
    not parsed. Silver is that of all pages."""
    lake = _lake(spark)
    state = F.trim("feature.attributes.State")
    place = F.when(state == "ca", 1).when(state == "OR", 2).otherwise(3)
    records = point_records(spark, sf_dir).withColumn("page_no", (F.col("page_no") - 1) * 3 + place)
    # landed as they are: pages of a state may be lacking, which the audit would refuse
    counted = page_statistics(page_documents(records).select("page_no", "document"), CHAPTERS, scope=True)
    write_documents(counted, f"{lake.bronze}/pages")
    run = LandedRun(RUN_ID, "2026-01-02", STARTED_AT.isoformat(), None, None, None, 0, 0, "pages")
    documents, rows_skipped = read_landed_in_scope(spark, lake, run, CHAPTERS)
    silver = silver_of(flatten(parse_documents(documents, CHAPTERS), CHAPTERS), CHAPTERS, lineage())
    return silver.select(
        "chapter_id",
        "chapter_name",
        "state",
        "longitude",
        "latitude",
        "source_object_id",
        F.lit(read_landed_documents(spark, lake, run).count()).cast("long").alias("pages_landed"),
        F.lit(documents.count()).cast("long").alias("pages_parsed"),
        F.lit(rows_skipped).cast("long").alias("rows_skipped"),
    )


@register(
    """SELECT o_orderkey // 1000 + 1 AS page_no, count(*) AS n_records, 'stream_00000000' AS run_id
FROM orders GROUP BY o_orderkey // 1000"""
)
def stream_landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land page documents from a stream; a second trigger finds nothing new."""
    lake = _lake(spark)
    arrived, checkpoint = scratch_path(spark, "arrived"), scratch_path(spark, "stream")
    write_documents(page_documents(point_records(spark, sf_dir)), arrived)
    for _ in range(2):
        stream = spark.readStream.schema("page_no long, document string").parquet(arrived)
        land_stream(stream, lake, CHAPTERS, checkpoint).awaitTermination()
    runs = landed_runs(spark, lake)
    pages = read_landed_documents(spark, lake, find_run(spark, lake, "stream_00000000"))
    counted = page_statistics(pages, CHAPTERS).select("page_no", "n_records")
    # a second trigger that landed anything would be a second run and be named here
    named = F.array_join(F.sort_array(F.collect_set("run_id")), ",").alias("run_id")
    return counted.withColumn("run_id", F.lit(runs.agg(named).first()["run_id"]))


@register(
    f"""{LEDGER_SQL}
SELECT rows_in, rows_out_of_scope, rows_quarantined, rows_deduped, rows_warned, rows_ok, rows_silver
FROM ledger"""
)
def transform_table_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and quarantine of a columnar source written; the ledger of that run."""
    lake = _lake(spark)
    run = {"ingest_run_id": F.lit("r1")}
    flat = flat_lines(spark, sf_dir)
    counts = transform(spark, flat, LINES_BY_RUN, lake, "r1", run, stage=False)
    return summary_frame(spark, counts)


@register(
    f"""{LEDGER_SQL}
SELECT 'lines' AS run_id, rows_in, rows_quarantined, NULL::BIGINT AS rows_landed FROM ledger
UNION ALL SELECT 'orders', NULL, NULL, count(*) FROM orders"""
)
def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two finished runs with different columns appended to the run table."""
    lake = _lake(spark)
    lines = ledger_lines(spark, sf_dir).select("rows_in", "rows_quarantined").first().asDict()
    append_run(spark, lake, {"run_id": "lines", **lines})
    append_run(spark, lake, {"run_id": "orders", "rows_landed": table(spark, sf_dir, "orders").count()})
    return read_runs(spark, lake)


@register(
    f"""WITH {SILVER_SQL}
SELECT flag AS ingest_run_id, reason AS quarantine_reason, order_key, line, price
FROM routed WHERE route = 'QUARANTINED'"""
)
def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per flag, the first of them written twice; all runs read back."""
    lake = _lake(spark)
    for run_id in ("A", "N", "A"):
        mine = flat_lines(spark, sf_dir).filter(F.col("flag") == run_id)
        rejected = quarantine_split(mine, LINES_BY_RUN)
        write_quarantine(rejected.withColumn("ingest_run_id", F.lit(run_id)), lake, run_id)
    return read_quarantine(spark, lake, LINES_BY_RUN).select(
        "ingest_run_id", "quarantine_reason", "order_key", "line", "price"
    )


@register(
    f"""WITH {SILVER_SQL}
SELECT order_key, line, flag, port, price, shipped_at, dq_status FROM silver"""
)
def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a part of the product, then all of it; readers see the newest snapshot."""
    published = SnapshotTable(spark, _lake(spark).gold)
    gold = contract_projection(silver_lines(spark, sf_dir), LINES).drop("dq_warnings")
    published.publish(gold.filter(F.col("flag") == "A"), "run_1")
    published.publish(gold, "run_2")
    return published.read()


@register(f"WITH {SILVER_SQL} SELECT order_key, line, price FROM silver WHERE flag = 'A'")
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two publications; the first run's snapshot is still there."""
    published = SnapshotTable(spark, _lake(spark).gold)
    gold = contract_projection(silver_lines(spark, sf_dir), LINES).select(
        "order_key", "line", "price", "flag"
    )
    published.publish(gold.filter(F.col("flag") == "A"), "run_1")
    published.publish(gold, "run_2")
    return published.as_of_run("run_1").drop("flag")


WHOLE_RUN_SQL = f"""SELECT l.*, s.* FROM ({POINTS_LEDGER_SQL}) l, (
  WITH {POINTS_SQL}
  SELECT count(*) AS rows_gold, count(*) FILTER (state = 'CA') AS rows_gold_ca,
    count(*) FILTER (state = 'OR') AS rows_gold_or, count(*) FILTER (state = 'WA') AS rows_gold_wa
  FROM silver) s"""


@register(WHOLE_RUN_SQL)
def whole_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed, audited, transformed, gated and published; the recorded run."""
    lake = _lake(spark)
    run_pages(spark, CHAPTERS, lake, page_documents(point_records(spark, sf_dir)), RUN_ID)
    runs = read_runs(spark, lake)
    return runs.select(*(name for name in runs.columns if name.startswith("rows_")))


@register(WHOLE_RUN_SQL)
def run_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, and the same run again from its landed pages: still one row in the run table."""
    lake = _lake(spark)
    run_pages(spark, CHAPTERS, lake, page_documents(point_records(spark, sf_dir)), RUN_ID)
    run_landed(spark, CHAPTERS, lake, RUN_ID)
    runs = read_runs(spark, lake)
    return runs.select(*(name for name in runs.columns if name.startswith("rows_")))


@register(WHOLE_RUN_SQL)
def run_folder_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run kept as page files with a sidecar, found by its id among the dated folders; an older
    folder of the same run is there too and must not be read."""
    lake = _lake(spark)
    documents = page_documents(point_records(spark, sf_dir)).select("page_no", "document")
    counts = page_audit(page_statistics(documents, CHAPTERS)).first()
    for day in ("2026-01-02", "2026-01-01"):
        folder = f"{lake.bronze}/ingest_date={day}/run_id={RUN_ID}"
        pages = documents if day == "2026-01-02" else documents.filter("page_no < 0")
        pages.write.partitionBy("page_no").text(folder)
        described = (day, f"{day}T03:04:05+00:00", "files", None, None, counts["pages"], counts["rows_in"])
        write_sidecar(spark, folder, LandedRun(RUN_ID, *described))
    run_folder(spark, CHAPTERS, lake, lake.bronze, RUN_ID, name_filter="*.txt")
    runs = read_runs(spark, lake)
    return runs.select(*(name for name in runs.columns if name.startswith("rows_")))


@register(
    f"""WITH {POINTS_SQL}
SELECT state, count(*) AS n_chapters, max(source_object_id) AS newest FROM silver GROUP BY state"""
)
def consumer_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer's SQL over the registered views of a published run."""
    lake = _lake(spark)
    run_pages(spark, CHAPTERS, lake, page_documents(point_records(spark, sf_dir)), RUN_ID)
    register_views(spark, CHAPTERS, lake, "consumer_")
    return spark.sql(
        """SELECT g.state, count(*) AS n_chapters, max(s.source_object_id) AS newest
        FROM consumer_gold g JOIN consumer_silver s ON g.chapter_id = s.chapter_id
        GROUP BY g.state"""
    )


@register(
    f"""WITH {POINTS_SQL}
SELECT (SELECT count(*) FROM flat) AS rows_in,
  (SELECT count(*) FROM routed WHERE route = 'QUARANTINED') AS rows_quarantined,
  (SELECT count(*) FROM silver WHERE no_city) AS rows_warned,
  (SELECT count(*) FROM silver WHERE NOT no_city) AS rows_ok,
  (SELECT count(*) FROM silver) AS rows_silver"""
)
def ledger_derived_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    documents = page_documents(point_records(spark, sf_dir))
    land_documents(spark, documents, lake, CHAPTERS, RUN_ID, STARTED_AT)
    landed = read_landed_documents(spark, lake, find_run(spark, lake, RUN_ID))
    flat = flatten(parse_documents(landed, CHAPTERS), CHAPTERS)
    transform(spark, flat, CHAPTERS, lake, RUN_ID, lineage())
    derived = derived_ledger(spark, CHAPTERS, lake, RUN_ID)
    return summary_frame(spark, derived)


@register(
    f"""WITH {POINTS_SQL}, second AS (
  SELECT *, city IS NULL OR city = '' OR upper(city) = 'UNKNOWN' AS no_city FROM routed
  WHERE route = 'SURVIVOR' AND state = 'CA'
  QUALIFY row_number() OVER (PARTITION BY chapter_id
    ORDER BY source_object_id DESC NULLS LAST, chapter_name ASC NULLS FIRST) = 1),
report AS (
  SELECT CASE WHEN o.chapter_id IS NULL THEN 'INSERT' WHEN n.chapter_id IS NULL THEN 'DELETE'
    WHEN o.chapter_name = n.chapter_name AND o.city IS NOT DISTINCT FROM n.city
     AND o.state = n.state AND o.longitude = n.longitude AND o.latitude = n.latitude
     AND o.no_city = n.no_city THEN 'UNCHANGED' ELSE 'UPDATE' END AS action
  FROM silver o FULL JOIN second n ON o.chapter_id = n.chapter_id)
SELECT count(*) FILTER (action = 'INSERT') AS rows_inserted,
  count(*) FILTER (action = 'UPDATE') AS rows_updated,
  count(*) FILTER (action = 'DELETE') AS rows_deleted,
  count(*) FILTER (action = 'UNCHANGED') AS rows_unchanged,
  count(*) FILTER (action <> 'DELETE') AS rows_gold
FROM report"""
)
def merge_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish two runs with merge semantics; the second extract lacks a state, so its chapters
    vanish from the product or go back to an older record."""
    lake = _lake(spark)
    flat = flat_points(spark, sf_dir)
    transform(spark, flat, CHAPTERS, lake, "run_1", lineage("run_1"))
    publish_gold(spark, CHAPTERS, lake, "run_1", merge=True)
    only_one_state = flat.filter(F.col("state") == "CA")
    transform(spark, only_one_state, CHAPTERS, lake, "run_2", lineage("run_2"))
    published = publish_gold(spark, CHAPTERS, lake, "run_2", merge=True)
    wanted = ("rows_inserted", "rows_updated", "rows_deleted", "rows_unchanged", "rows_gold")
    counts = {name: published[name] for name in wanted}
    return summary_frame(spark, counts)


@register(
    f"""WITH {SILVER_SQL}, second AS (
  SELECT order_key, line, flag, port, CASE WHEN order_key BETWEEN 1000 AND 1020 THEN price + 1 ELSE price END
    AS price, shipped_at, dq_status FROM silver WHERE order_key NOT BETWEEN 2000 AND 2010
  UNION ALL SELECT -order_key, line, flag, port, price, shipped_at, dq_status FROM silver
  WHERE order_key BETWEEN 3000 AND 3010),
report AS (
  SELECT CASE WHEN o.order_key IS NULL THEN 'INSERT' WHEN n.order_key IS NULL THEN 'DELETE'
    WHEN o.price = n.price THEN 'UNCHANGED' ELSE 'UPDATE' END AS action
  FROM silver o FULL JOIN second n ON o.order_key = n.order_key AND o.line = n.line)
SELECT action, count(*) AS n_rows FROM report GROUP BY action"""
)
def merge_by_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots that differ in a few keys: rows of equal buckets are counted, not joined."""
    columns = ("order_key", "line", "flag", "port", "price", "shipped_at", "dq_status")
    old = silver_lines(spark, sf_dir).select(*columns)
    key = F.col("order_key")
    price = F.when(key.between(1000, 1020), F.col("price") + 1).otherwise(F.col("price"))
    new = old.filter(~key.between(2000, 2010)).withColumn("price", price)
    new = new.unionByName(old.filter(key.between(3000, 3010)).withColumn("order_key", -key))
    tables = [SnapshotTable(spark, _lake(spark).gold) for _ in range(2)]
    for snapshots, rows in zip(tables, (old, new)):
        snapshots.publish(rows, "run")
    old, new = (snapshots.read() for snapshots in tables)
    buckets = 4096
    path = scratch_path(spark, "buckets")
    compared_buckets(old, new, LINES.key, buckets).write.parquet(path)
    known = spark.read.parquet(path)
    return change_totals(changes_by_bucket(old, new, LINES.key, buckets, known), known)


HISTORY_SQL = f"""WITH {SILVER_SQL}, seen AS (
  SELECT 1 AS step, order_key, line, price, dq_status FROM silver WHERE order_key % 5 <> 1
  UNION ALL SELECT 2, order_key, line, CASE WHEN order_key % 7 = 2 THEN price + 1 ELSE price END, dq_status
  FROM silver WHERE order_key % 5 <> 2
  UNION ALL SELECT 3, order_key, line, price, dq_status FROM silver WHERE order_key % 11 <> 3),
stepped AS (
  SELECT *, CASE WHEN lag(step) OVER w = step - 1 AND lag(price) OVER w IS NOT DISTINCT FROM price
    AND lag(dq_status) OVER w IS NOT DISTINCT FROM dq_status THEN 0 ELSE 1 END AS starts
  FROM seen WINDOW w AS (PARTITION BY order_key, line ORDER BY step)),
islands AS (
  SELECT *, sum(starts) OVER (PARTITION BY order_key, line ORDER BY step) AS island FROM stepped),
intervals AS (
  SELECT order_key, line, any_value(price) AS price, any_value(dq_status) AS dq_status,
    min(step) AS first, max(step) AS last FROM islands GROUP BY order_key, line, island)"""


def three_publications(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    """Three publications of a product: keys are missing from each, and prices differ in the second."""
    rows = silver_lines(spark, sf_dir).select("order_key", "line", "price", "dq_status")
    key = F.col("order_key")
    table = SnapshotTable(spark, _lake(spark).gold)
    table.publish(rows.filter(key % 5 != 1), "run_1")
    dearer = F.when(key % 7 == 2, F.col("price") + 1).otherwise(F.col("price"))
    table.publish(rows.filter(key % 5 != 2).withColumn("price", dearer), "run_2")
    table.publish(rows.filter(key % 11 != 3), "run_3")
    return table


@register(
    f"""{HISTORY_SQL}
SELECT order_key, line, price, dq_status, 'run_' || first AS from_run,
  CASE WHEN last < 3 THEN 'run_' || (last + 1) END AS to_run FROM intervals"""
)
def row_history_of_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Since which publication each row has its values, and from which on it has not."""
    return row_history(publications(three_publications(spark, sf_dir)), LINES.key)


@register(
    f"""{HISTORY_SQL}
SELECT order_key, line, price, dq_status, 'run_' || first AS from_run,
  CASE WHEN last < 3 THEN 'run_' || (last + 1) END AS to_run FROM intervals"""
)
def row_history_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history, kept as a table and extended by one publication at a time."""
    kept = None
    for run_id, rows in publications(three_publications(spark, sf_dir)):
        if kept is None:
            kept = first_history(rows, run_id, LINES.key)
        else:
            kept = extend_history(kept, rows, run_id, LINES.key)
        path = scratch_path(spark, "history")
        kept.write.parquet(path)
        kept = spark.read.schema(kept.schema).parquet(path)
    return kept


@register(f"WITH {SILVER_SQL} SELECT order_key, line, price FROM silver WHERE flag = 'A'")
def snapshot_as_of_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publications, read as of a moment between them."""
    table = SnapshotTable(spark, _lake(spark).gold)
    gold = contract_projection(silver_lines(spark, sf_dir), LINES).select("order_key", "line", "price", "flag")
    table.publish(gold.filter(F.col("flag") == "A"), "run_1")
    between = datetime.now(timezone.utc)
    table.publish(gold, "run_2")
    return table.as_of_time(between).drop("flag")
