"""Operators on columnar tables.

The tables hold no NULL, blank text or NaN, so the dirt the rules look for is derived from their
columns, by the same expressions in Spark and in SQL.
"""

from __future__ import annotations

from datetime import date, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import (
    annotate,
    blank_or_literal,
    normalised,
    outside_range,
    quarantine_reason,
    run_id_of,
    typed,
)
from tidegate.functions.rules import any_failed
from tidegate.operators.contract import contract_assertions, contract_projection, freshness, overlap
from tidegate.operators.dedupe import latest_wins
from tidegate.operators.flatten import flatten_table
from tidegate.operators.freshness import publication_calendar
from tidegate.operators.gates import gate_metrics, group_counts
from tidegate.operators.ledger import disposition_counts, run_ledger
from tidegate.operators.merge import (
    change_counts,
    change_report,
    merge_snapshot,
    merge_upsert,
    repeated_keys,
)
from tidegate.operators.quarantine import quarantined_by_run
from tidegate.operators.route import quarantine_split, route, routed, scope_filter, survivors
from tidegate.operators.runs import newest_first, union_ledgers
from tidegate.plans.silver import silver_of
from tidegate.registry.base import register, table
from tidegate.sources.runs import newest_run
from tidegate.spec import BlankOrLiteral, Field, OrderBy, OutsideRange, ProductSpec, Rule

# ------------------------------------------------------------------ product over lineitem

LINES = ProductSpec(
    fields=(
        Field("order_key", "l_orderkey", "bigint"),
        Field("line", "l_linenumber", "int"),
        # Stored as clean codes, so it is left alone and the scan can filter by it.
        Field("flag", "l_returnflag", normalise=()),
        Field("port", "ship_port"),
        Field("discount", "l_discount", "double"),
        Field("tax", "l_tax", "double"),
        Field("price", "l_extendedprice", "double"),
        Field("shipped_at", "l_shipdate", "timestamp_ntz"),
        Field("supplier", "l_suppkey", "bigint"),
    ),
    key=("order_key", "line"),
    order=(OrderBy("shipped_at", descending=True, nulls_last=True), OrderBy("price")),
    contract=(
        ("order_key", "bigint"),
        ("line", "int"),
        ("flag", "string"),
        ("port", "string"),
        ("price", "double"),
        ("shipped_at", "timestamp_ntz"),
        ("dq_status", "string"),
        ("dq_warnings", "array<string>"),
    ),
    scope=("flag", ("A", "N")),
    hard_rules=(
        OutsideRange("DISCOUNT_OUT_OF_RANGE", (("discount", 0.0, 0.09),)),
        OutsideRange("TAX_OUT_OF_RANGE", (("tax", 0.0, 0.07),)),
    ),
    soft_rules=(
        BlankOrLiteral("MISSING_PORT", "port", ("UNKNOWN",)),
        Rule("HIGH_PRICE", lambda: F.col("price") > 90000.0),
    ),
    group="flag",
    expected_groups=("A", "N", "X"),
    required_groups=("A",),
    lineage={},
)

FLAT_SQL = """
flat AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line, l_returnflag AS flag,
         trim(CASE WHEN l_quantity >= 49 THEN NULL WHEN l_quantity >= 48 THEN '  unKnown '
                   WHEN l_quantity >= 47 THEN '   ' ELSE concat(' PORT ', l_suppkey, ' ') END) AS port,
         l_discount AS discount, l_tax AS tax, l_extendedprice AS price,
         l_shipdate AS shipped_at, l_suppkey AS supplier
  FROM lineitem
)"""
ROUTED_SQL = f"""{FLAT_SQL},
routed AS (
  SELECT *,
    CASE WHEN NOT coalesce(flag IN ('A', 'N'), false) THEN 'OUT_OF_SCOPE'
         WHEN reason IS NOT NULL THEN 'QUARANTINED' ELSE 'SURVIVOR' END AS route
  FROM (
    SELECT *,
      CASE WHEN discount IS NULL OR coalesce(isnan(discount), false) OR discount < 0 OR discount > 0.09
             THEN 'DISCOUNT_OUT_OF_RANGE'
           WHEN tax IS NULL OR coalesce(isnan(tax), false) OR tax < 0 OR tax > 0.07
             THEN 'TAX_OUT_OF_RANGE' END AS reason
    FROM flat)
)"""
SILVER_SQL = f"""{ROUTED_SQL},
latest AS (
  SELECT * FROM routed WHERE route = 'SURVIVOR'
  QUALIFY row_number() OVER (
    PARTITION BY order_key, line
    ORDER BY shipped_at DESC NULLS LAST, price ASC NULLS FIRST, flag NULLS FIRST, port NULLS FIRST,
             discount NULLS FIRST, tax NULLS FIRST, supplier NULLS FIRST) = 1
),
silver AS (
  SELECT order_key, line, flag, port, price, shipped_at, discount, tax, supplier,
    CASE WHEN no_port OR high THEN 'WARNING' ELSE 'OK' END AS dq_status,
    concat_ws(',', CASE WHEN no_port THEN 'MISSING_PORT' END, CASE WHEN high THEN 'HIGH_PRICE' END)
      AS warnings
  FROM (SELECT *, port IS NULL OR trim(port) = '' OR upper(trim(port)) = 'UNKNOWN' AS no_port,
               coalesce(price > 90000.0, true) AS high FROM latest)
)"""


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a text column that is missing, a placeholder or blank for large quantities."""
    quantity = F.col("l_quantity")
    port = (
        F.when(quantity >= 49, F.lit(None).cast("string"))
        .when(quantity >= 48, F.lit("  unKnown "))
        .when(quantity >= 47, F.lit("   "))
        .otherwise(F.concat(F.lit(" PORT "), F.col("l_suppkey").cast("string"), F.lit(" ")))
    )
    return table(spark, sf_dir, "lineitem").withColumn("ship_port", port)


def flat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_table(line_items(spark, sf_dir), LINES, {})


def silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_of(flat_lines(spark, sf_dir), LINES)


def _with_warning_text(df: DataFrame) -> DataFrame:
    """Arrays as text, so that both engines print them alike."""
    return df.withColumn("warnings", F.array_join("dq_warnings", ",")).drop("dq_warnings")


# ------------------------------------------------------------------ scope, rules and the split


@register(f"WITH {FLAT_SQL} SELECT order_key, line, flag, price FROM flat WHERE flag IN ('A', 'N')")
def scope_filter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope_filter(flat_lines(spark, sf_dir), LINES).select("order_key", "line", "flag", "price")


CUSTOMER_SQL = """
seeded AS (
  SELECT c_custkey,
    CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'FURNITURE' THEN CAST('NaN' AS DOUBLE)
                      ELSE c_acctbal END AS balance,
    CASE c_mktsegment WHEN 'BUILDING' THEN ' unknown ' WHEN 'HOUSEHOLD' THEN '  '
                      WHEN 'FURNITURE' THEN NULL ELSE c_mktsegment END AS segment
  FROM customer
),
judged AS (
  SELECT c_custkey,
    balance IS NULL OR coalesce(isnan(balance), false) OR balance < -500 OR balance > 9000 AS bad_balance,
    segment IS NULL OR trim(segment) = '' OR upper(trim(segment)) = 'UNKNOWN' AS bad_segment
  FROM seeded
)"""
BALANCE = OutsideRange("BALANCE_OUT_OF_RANGE", (("balance", -500.0, 9000.0),))
SEGMENT = BlankOrLiteral("MISSING_SEGMENT", "segment")


def seeded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(segment == "MACHINERY", F.lit(None).cast("double"))
        .when(segment == "FURNITURE", F.lit(float("nan")))
        .otherwise(F.col("c_acctbal"))
        .alias("balance"),
        F.when(segment == "BUILDING", F.lit(" unknown "))
        .when(segment == "HOUSEHOLD", F.lit("  "))
        .when(segment == "FURNITURE", F.lit(None).cast("string"))
        .otherwise(segment)
        .alias("segment"),
    )


@register(f"WITH {CUSTOMER_SQL} SELECT c_custkey, bad_balance FROM judged")
def hard_rule_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = outside_range(F.col("balance"), -500.0, 9000.0)
    return seeded_customers(spark, sf_dir).select("c_custkey", bad.alias("bad_balance"))


@register(f"WITH {CUSTOMER_SQL} SELECT c_custkey, bad_segment FROM judged")
def soft_rule_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = blank_or_literal(F.col("segment"))
    return seeded_customers(spark, sf_dir).select("c_custkey", bad.alias("bad_segment"))


@register(
    f"""WITH {CUSTOMER_SQL}
SELECT c_custkey, bad_balance AS is_quarantined,
       CASE WHEN bad_balance THEN 'BALANCE_OUT_OF_RANGE' END AS quarantine_reason,
       CASE WHEN bad_segment THEN 'WARNING' ELSE 'OK' END AS dq_status,
       CASE WHEN bad_segment THEN 'MISSING_SEGMENT' ELSE '' END AS warnings
FROM judged"""
)
def dq_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    annotated = annotate(seeded_customers(spark, sf_dir), (BALANCE,), (SEGMENT,))
    return _with_warning_text(annotated).drop("balance", "segment")


@register(
    f"""WITH {CUSTOMER_SQL}
SELECT bad_balance AS is_quarantined, count(*) AS n_rows FROM judged GROUP BY 1"""
)
def hard_rule_split_is_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = seeded_customers(spark, sf_dir).select(any_failed((BALANCE,)).alias("is_quarantined"))
    kept = judged.filter("is_quarantined").unionByName(judged.filter("NOT is_quarantined"))
    return kept.groupBy("is_quarantined").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    f"""WITH {ROUTED_SQL}
SELECT order_key, line, flag, port, discount, price, shipped_at, supplier,
       reason AS quarantine_reason, CAST(supplier AS VARCHAR) AS payload_supplier
FROM routed WHERE route = 'QUARANTINED'"""
)
def quarantine_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quarantine_split(flat_lines(spark, sf_dir), LINES)
    return rejected.select(
        "order_key",
        "line",
        "flag",
        "port",
        "discount",
        "price",
        "shipped_at",
        "supplier",
        "quarantine_reason",
        F.get_json_object("raw_payload", "$.l_suppkey").alias("payload_supplier"),
    )


@register(
    f"""WITH {ROUTED_SQL}
SELECT order_key, line, flag, port, price, shipped_at FROM routed WHERE route = 'SURVIVOR'"""
)
def survivors_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(flat_lines(spark, sf_dir), LINES).select(
        "order_key", "line", "flag", "port", "price", "shipped_at"
    )


@register(f"WITH {ROUTED_SQL} SELECT route, reason, count(*) AS n_rows FROM routed GROUP BY ALL")
def route_counts_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The reason is worked out for every row here, as in the SQL, not only for quarantined ones.
    judged = flat_lines(spark, sf_dir).select(
        route(LINES).alias("route"), quarantine_reason(LINES.hard_rules).alias("reason")
    )
    return judged.groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    f"""WITH {ROUTED_SQL}
SELECT reason AS ingest_run_id, flag AS quarantine_reason, count(*) AS n_rows
FROM routed WHERE route = 'QUARANTINED' GROUP BY ALL"""
)
def quarantine_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two text columns stand in for the run and the reason of a quarantine of many runs.
    rejected = quarantine_split(flat_lines(spark, sf_dir), LINES).select(
        F.col("quarantine_reason").alias("ingest_run_id"), F.col("flag").alias("quarantine_reason")
    )
    return quarantined_by_run(rejected)


# ------------------------------------------------------------------ deduplication


@register(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice ASC NULLS FIRST,
           l_partkey NULLS FIRST, l_suppkey NULLS FIRST) = 1"""
)
def dedupe_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    order = (OrderBy("l_shipdate", True, True), OrderBy("l_extendedprice"))
    return latest_wins(rows, ["l_orderkey", "l_linenumber"], order)


@register(
    """SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_partkey END AS part_key,
       l_orderkey, l_linenumber, l_shipdate, l_extendedprice
FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_partkey END
  ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice ASC NULLS FIRST,
           l_orderkey NULLS FIRST, l_linenumber NULLS FIRST) = 1"""
)
def dedupe_hot_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all rows has no key; they collapse to one row like any other key's."""
    key = F.when(F.col("l_returnflag") != "R", F.col("l_partkey"))
    rows = table(spark, sf_dir, "lineitem").select(
        key.alias("part_key"), "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    order = (OrderBy("l_shipdate", True, True), OrderBy("l_extendedprice"))
    return latest_wins(rows, ["part_key"], order)


# ------------------------------------------------------------------ silver, ledger, gates


@register(
    f"""WITH {SILVER_SQL}
SELECT order_key, line, flag, port, price, shipped_at, supplier, dq_status, warnings FROM silver"""
)
def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_warning_text(silver_lines(spark, sf_dir)).drop("discount", "tax")


LEDGER_SQL = f"""WITH {SILVER_SQL},
before AS (
  SELECT count(*) AS rows_in,
    count(*) FILTER (route = 'OUT_OF_SCOPE') AS rows_out_of_scope,
    count(*) FILTER (route = 'QUARANTINED') AS rows_quarantined,
    count(*) FILTER (route = 'SURVIVOR') AS rows_surviving
  FROM routed),
after AS (
  SELECT count(*) FILTER (dq_status = 'WARNING') AS rows_warned,
         count(*) FILTER (dq_status = 'OK') AS rows_ok, count(*) AS rows_silver
  FROM silver),
ledger AS (
  SELECT rows_in, rows_out_of_scope, rows_quarantined,
         rows_surviving - rows_silver AS rows_deduped, rows_warned, rows_ok, rows_silver
  FROM before, after)"""


def ledger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_lines(spark, sf_dir)
    return run_ledger(routed(flat, LINES), silver_of(flat, LINES))


@register(f"{LEDGER_SQL} SELECT * FROM ledger")
def ledger_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_lines(spark, sf_dir)


@register(
    f"""{LEDGER_SQL}
SELECT disposition, n_rows FROM (
  UNPIVOT (SELECT rows_out_of_scope AS OUT_OF_SCOPE, rows_quarantined AS QUARANTINED,
                  rows_deduped AS DUPLICATE, rows_warned AS WARNING, rows_ok AS OK FROM ledger)
  ON OUT_OF_SCOPE, QUARANTINED, DUPLICATE, WARNING, OK INTO NAME disposition VALUE n_rows)"""
)
def ledger_by_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disposition_counts(ledger_lines(spark, sf_dir))


@register(
    f"""WITH {SILVER_SQL}
SELECT count(*) AS rows_silver,
  count(*) FILTER (NOT coalesce(dq_status IN ('OK', 'WARNING'), false)) AS rows_bad_status,
  count(*) FILTER (flag = 'A') AS rows_group_a, count(*) FILTER (flag = 'N') AS rows_group_n,
  count(*) FILTER (flag = 'X') AS rows_group_x
FROM (SELECT flag, CASE WHEN tax > 0.065 THEN NULL WHEN tax > 0.055 THEN 'ODD' ELSE dq_status END
        AS dq_status FROM silver)"""
)
def gate_metrics_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates over a silver with missing and unexpected statuses, both counted as bad."""
    tax = F.col("tax")
    status = F.when(tax > 0.065, F.lit(None)).when(tax > 0.055, "ODD").otherwise(F.col("dq_status"))
    return gate_metrics(silver_lines(spark, sf_dir).withColumn("dq_status", status), LINES)


@register(
    """SELECT wanted AS o_orderstatus, count(o_orderkey) AS n_rows
FROM (VALUES ('F'), ('O'), ('Z')) AS w(wanted) LEFT JOIN orders ON o_orderstatus = wanted
GROUP BY wanted"""
)
def group_counts_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_counts(spark, table(spark, sf_dir, "orders"), "o_orderstatus", ("F", "O", "Z"))


@register("SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY o_orderstatus")
def group_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ contract


@register(
    f"""WITH {SILVER_SQL}
SELECT order_key, line, flag, port, price, shipped_at, dq_status, warnings FROM silver"""
)
def contract_projection_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_warning_text(contract_projection(silver_lines(spark, sf_dir), LINES))


@register(
    f"""WITH {ROUTED_SQL},
published AS (
  SELECT order_key, line, flag, discount, tax,
    CASE WHEN tax > 0.065 THEN NULL WHEN port IS NULL OR trim(port) = '' THEN 'WARNING'
         ELSE 'OK' END AS dq_status,
    CASE WHEN port IS NULL THEN 1 ELSE 0 END AS n_warnings, reason
  FROM routed),
keys AS (SELECT count(*) - count(DISTINCT (order_key, line)) AS repeated_key FROM published)
SELECT count(*) AS rows_checked, any_value(repeated_key) AS repeated_key,
  count(*) FILTER (order_key IS NULL OR line IS NULL) AS null_key,
  count(*) FILTER (reason IS NOT NULL) AS hard_rule_broken,
  count(*) FILTER (dq_status IS NULL) AS status_outside_domain,
  count(*) FILTER (coalesce(dq_status = 'OK', false) <> (n_warnings = 0)) AS warnings_disagree,
  count(*) FILTER (flag NOT IN ('A', 'N')) AS out_of_scope
FROM published, keys"""
)
def contract_assertions_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every guarantee is broken by some of these rows: nothing was filtered or deduplicated."""
    port = F.col("port")
    status = (
        F.when(F.col("tax") > 0.065, F.lit(None).cast("string"))
        .when(port.isNull() | (F.trim(port) == ""), F.lit("WARNING"))
        .otherwise(F.lit("OK"))
    )
    empty = F.array().cast("array<string>")
    warnings = F.when(port.isNull(), F.array(F.lit("MISSING_PORT"))).otherwise(empty)
    published = flat_lines(spark, sf_dir).withColumns({"dq_status": status, "dq_warnings": warnings})
    return contract_assertions(published, LINES)


@register(
    """SELECT event_type, max(ts) AS newest, count(DISTINCT user_id) AS n_runs FROM events
GROUP BY event_type"""
)
def freshness_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(F.max("ts").alias("newest"), F.count_distinct("user_id").alias("n_runs"))
    )


@register(
    """WITH log AS (SELECT ts FROM events WHERE event_type = 'error' AND user_id % 9 = 0),
days AS (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-03-10', INTERVAL 1 DAY))::DATE AS day),
served AS (SELECT ts::DATE AS day, min(ts) AS first_published_at_utc FROM log GROUP BY 1)
SELECT day, first_published_at_utc,
  CASE WHEN first_published_at_utc IS NULL THEN 'MISSING'
       WHEN first_published_at_utc > day + INTERVAL 6 HOUR THEN 'LATE' ELSE 'ON_TIME' END AS freshness
FROM days LEFT JOIN served USING (day)"""
)
def publication_calendar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some events taken for publications due at six: days on time, late days and days without any."""
    event = table(spark, sf_dir, "events")
    log = event.filter((F.col("event_type") == "error") & (F.col("user_id") % 9 == 0))
    log = log.select(F.col("ts").alias("published_at_utc"))
    return publication_calendar(log, date(2023, 12, 25), date(2024, 3, 10), time(6))


@register(
    """SELECT max(ts) AS newest_ingested_at_utc,
  count(DISTINCT CASE WHEN event_type <> 'error' THEN event_type END) AS n_runs,
  count(*) FILTER (event_type = 'error') AS rows_without_run
FROM events"""
)
def snapshot_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = F.when(F.col("event_type") != "error", F.col("event_type"))
    events = table(spark, sf_dir, "events").select(
        F.col("ts").alias("ingested_at_utc"), run.alias("ingest_run_id")
    )
    return freshness(events)


@register(
    f"""WITH {SILVER_SQL}
SELECT count(*) AS n_overlapping FROM routed q
WHERE route = 'QUARANTINED'
  AND EXISTS (SELECT 1 FROM silver s WHERE s.order_key = q.order_key AND s.line = q.line)"""
)
def quarantine_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows whose key is published all the same, by another row with that key."""
    flat = flat_lines(spark, sf_dir)
    return overlap(quarantine_split(flat, LINES), silver_of(flat, LINES), LINES.key)


# ------------------------------------------------------------------ merge

EXTRACT_SQL = """
extract_rows AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line, l_suppkey AS supplier,
         l_extendedprice AS price, l_shipdate AS shipped_at FROM lineitem),
old AS (
  SELECT * FROM extract_rows WHERE shipped_at < TIMESTAMP '2000-01-01'
  QUALIFY row_number() OVER (PARTITION BY order_key, line ORDER BY shipped_at DESC NULLS LAST,
    price ASC NULLS FIRST, supplier NULLS FIRST) = 1),
new AS (
  SELECT * FROM extract_rows WHERE shipped_at >= TIMESTAMP '1997-01-01'
  QUALIFY row_number() OVER (PARTITION BY order_key, line ORDER BY shipped_at DESC NULLS LAST,
    price ASC NULLS FIRST, supplier NULLS FIRST) = 1)"""
REPORT_SQL = f"""WITH {EXTRACT_SQL},
report AS (
  SELECT coalesce(n.order_key, o.order_key) AS order_key, coalesce(n.line, o.line) AS line,
    CASE WHEN o.order_key IS NULL THEN 'INSERT' WHEN n.order_key IS NULL THEN 'DELETE'
         WHEN o.supplier IS NOT DISTINCT FROM n.supplier AND o.price IS NOT DISTINCT FROM n.price
          AND o.shipped_at IS NOT DISTINCT FROM n.shipped_at THEN 'UNCHANGED'
         ELSE 'UPDATE' END AS action
  FROM old o FULL JOIN new n ON o.order_key = n.order_key AND o.line = n.line)"""


def extracts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of overlapping shipping periods, each deduplicated to the latest shipment."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("shipped_at"),
    )
    order = (OrderBy("shipped_at", True, True), OrderBy("price"))
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    old = rows.filter(F.col("shipped_at") < at("2000-01-01"))
    new = rows.filter(F.col("shipped_at") >= at("1997-01-01"))
    return latest_wins(old, LINES.key, order), latest_wins(new, LINES.key, order)


@register(f"{REPORT_SQL} SELECT order_key, line, action FROM report")
def merge_change_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_report(*extracts(spark, sf_dir), LINES.key, assume_unique=True)


@register(f"{REPORT_SQL} SELECT action, count(*) AS n_rows FROM report GROUP BY action")
def merge_change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_counts(merge_change_report(spark, sf_dir))


@register(f"WITH {EXTRACT_SQL} SELECT * FROM new")
def merge_snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_snapshot(*extracts(spark, sf_dir), LINES.key, assume_unique=True)


@register(
    f"""WITH {EXTRACT_SQL}
SELECT * FROM old o
WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.order_key = o.order_key AND n.line = o.line)
UNION ALL SELECT * FROM new"""
)
def merge_upsert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(*extracts(spark, sf_dir), LINES.key, assume_unique=True)


@register(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def merge_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------------ text, typing, run ids


@register(
    """SELECT p_partkey, upper(trim(concat('  ', p_brand, ' '))) AS brand,
       trim(concat(' ', p_name)) AS name, CAST(p_size AS VARCHAR) AS size_text FROM part"""
)
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("p_brand"), F.lit(" "))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        normalised(padded, ("trim", "upper")).alias("brand"),
        normalised(F.concat(F.lit(" "), F.col("p_name")), ("trim",)).alias("name"),
        normalised(F.col("p_size"), ("trim",)).alias("size_text"),
    )


@register(
    """SELECT event_id,
  CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value END AS measured,
  CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_key
FROM events"""
)
def try_cast_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    value = F.when(kind == "error", "abc").when(kind == "signup", "").otherwise(
        F.col("value").cast("string")
    )
    user = F.when(kind == "error", "n/a").otherwise(F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id", typed(value, "double").alias("measured"), typed(user, "bigint").alias("user_key")
    )


@register(
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.k') AS k_text FROM events"""
)
def json_payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ProductSpec(
        fields=(
            Field("event_id", "event_id", "bigint"),
            Field("k", "props.k", "bigint"),
            Field("k_text", "props.k"),
        ),
        key=("event_id",),
        order=(OrderBy("k"),),
        contract=(("event_id", "bigint"),),
        lineage={},
    )
    parsed = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k string").alias("props")
    )
    return flatten_table(parsed, spec, {}).select(*spec.field_columns)


@register("SELECT event_id, strftime(ts, 'run_%Y%m%dT%H%M%SZ') AS run_id FROM events")
def run_id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", run_id_of(F.col("ts")).alias("run_id"))


# ------------------------------------------------------------------ runs and consumers


@register(
    """SELECT event_type AS run_id, strftime(max(ts), '%Y-%m-%d') AS ingest_date,
       max(event_id) AS newest_event FROM events GROUP BY event_type"""
)
def latest_run_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a landing of its type; the newest date wins, then the highest event."""
    landings = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"),
        F.col("event_id").alias("newest_event"),
    )
    return newest_run(landings, "ingest_date", "newest_event")


@register(
    """SELECT strftime(ts, '%Y-%m-%d') AS run_id, count(*) AS rows_in, max(ts) AS finished_at_utc,
       NULL::BIGINT AS rows_gold FROM events GROUP BY 1
UNION ALL BY NAME
SELECT strftime(o_orderdate, '%Y-%m-%d') AS run_id, count(*) AS rows_gold FROM orders GROUP BY 1"""
)
def ledger_schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_id"))
    orders = table(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("run_id")
    )
    return union_ledgers(
        events.agg(F.count(F.lit(1)).alias("rows_in"), F.max("ts").alias("finished_at_utc")),
        orders.agg(F.count(F.lit(1)).alias("rows_gold")),
    )


@register(
    """SELECT event_type AS run_id, ts AS finished_at_utc, event_id FROM events
ORDER BY ts DESC, event_type DESC LIMIT 20"""
)
def runs_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run_id"), F.col("ts").alias("finished_at_utc"), "event_id"
    )
    return newest_first(events, 20)


@register(
    f"""WITH {SILVER_SQL}
SELECT order_key, line, flag, price, dq_status FROM silver ORDER BY order_key, line LIMIT 100"""
)
def gold_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumers' look at the product: SQL over a view, ordered, the first hundred."""
    gold = contract_projection(silver_lines(spark, sf_dir), LINES)
    return spark.sql(
        "SELECT order_key, line, flag, price, dq_status FROM {gold} ORDER BY order_key, line LIMIT 100",
        gold=gold,
    )
