from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from samples import LEDGER, PAGES, PUBLISHED, documents, flat_rows, ids, number_of, page, record

from tidegate.errors import ContractError, GateError
from tidegate.operators.contract import (
    contract_assertions,
    contract_projection,
    freshness,
    overlap,
    require_contract,
    require_contract_schema,
)
from tidegate.operators.dedupe import latest_wins
from tidegate.operators.gates import gate_metrics, group_counts, require_publishable
from tidegate.operators.ledger import (
    disposition_counts,
    require_all_read,
    require_balanced,
    run_ledger,
)
from tidegate.operators.merge import (
    change_counts,
    change_report,
    merge_snapshot,
    merge_upsert,
    repeated_keys,
)
from tidegate.operators.route import quarantine_split, routed, scope_filter
from tidegate.operators.runs import newest_first, summary_frame, union_ledgers
from tidegate.plans.chapters import CHAPTERS
from tidegate.plans.silver import silver_of
from tidegate.spec import OrderBy

ORDER = (OrderBy("v", descending=True, nulls_last=True), OrderBy("name"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scope_comes_before_quarantine(spark):
    flat = flat_rows(spark)
    assert {r["state"] for r in scope_filter(flat, CHAPTERS).collect()} == {"CA", "OR", "WA"}
    assert {r["chapter_id"] for r in quarantine_split(flat, CHAPTERS).collect()} == ids("QUARANTINED")


def test_null_state_is_out_of_scope(spark):
    flat = flat_rows(spark, [page(record(1, "X", None), record(2, "CA-2", "CA"))])
    assert [r["chapter_id"] for r in scope_filter(flat, CHAPTERS).collect()] == ["CA-2"]
    counts = {r["route"]: r["count"] for r in routed(flat, CHAPTERS).groupBy("route").count().collect()}
    assert counts == {"OUT_OF_SCOPE": 1, "SURVIVOR": 1}


def test_quarantine_columns_reason_and_payload(spark):
    rows = quarantine_split(flat_rows(spark), CHAPTERS).collect()
    assert rows[0].asDict().keys() == set(CHAPTERS.quarantine_columns)
    for row in rows:
        assert row["quarantine_reason"] == "INVALID_COORDINATES"
        assert row["ingest_run_id"] == "run_test"
        assert row["chapter_id"] in row["raw_payload"]


def test_payload_is_built_for_quarantined_rows_only(spark):
    rows = routed(flat_rows(spark), CHAPTERS).collect()
    assert all((r["raw_payload"] is not None) == (r["route"] == "QUARANTINED") for r in rows)
    assert "StructsToJson" not in plan_of(silver_of(flat_rows(spark), CHAPTERS))


def test_bad_duplicate_does_not_shadow_a_good_record(spark):
    flat = flat_rows(spark, [page(record(1, "CA-1", "CA", name="good"), record(9, "CA-1", "CA", x=999))])
    silver = silver_of(flat, CHAPTERS).collect()
    assert [(r["chapter_name"], r["source_object_id"]) for r in silver] == [("good", 1)]


def test_latest_wins(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("a", None, "n"),
            ("b", None, "p"), ("b", None, None),
            ("c", 5, "q"),
        ],
        "k string, v int, name string",
    )
    rows = {r["k"]: (r["v"], r["name"]) for r in latest_wins(df, ["k"], ORDER).collect()}
    assert rows == {"a": (3, "y"), "b": (None, None), "c": (5, "q")}


def test_null_keys_collapse_by_default_and_can_be_quarantined(spark):
    flat = flat_rows(spark, [page(record(1, None, "CA"), record(2, None, "CA"), record(3, "CA-3", "CA"))])
    assert sorted(r["source_object_id"] for r in silver_of(flat, CHAPTERS).collect()) == [2, 3]
    strict = CHAPTERS.with_changes(null_key="quarantine")
    assert [r["source_object_id"] for r in silver_of(flat, strict).collect()] == [3]
    rejected = quarantine_split(flat, strict).collect()
    assert {r["quarantine_reason"] for r in rejected} == {"MISSING_KEY"} and len(rejected) == 2


def test_exact_ties_do_not_depend_on_partitioning(spark):
    df = spark.range(200).select(
        F.lit("k").alias("k"), F.lit(1).alias("v"), F.lit("n").alias("name"), F.col("id").alias("extra")
    )
    picked = {
        latest_wins(df.repartition(n), ["k"], ORDER).first()["extra"] for n in (1, 3, 7)
    }
    assert picked == {0}


def test_hot_key_reaches_its_reducer_as_one_row_per_task(spark):
    df = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") < 10000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("v"),
        F.lit("n").alias("name"),
    )
    out = latest_wins(df, ["k"], ORDER)
    plan = plan_of(out)
    assert plan.index("Partial") > plan.index("Exchange")  # below the exchange
    assert out.count() == 20001
    assert out.filter("k = 'hot'").first()["v"] == 9999


def test_ledger_of_the_sample(spark):
    flat = flat_rows(spark)
    ledger = run_ledger(routed(flat, CHAPTERS), silver_of(flat, CHAPTERS))
    row = ledger.first().asDict()
    assert row == LEDGER
    require_balanced(row)
    rows_in = LEDGER["rows_in"]
    require_all_read(rows_in, rows_in)
    assert {r["disposition"]: r["n_rows"] for r in disposition_counts(ledger).collect()} == {
        outcome: number_of(outcome) for outcome in ("OUT_OF_SCOPE", "QUARANTINED", "DUPLICATE", "WARNING", "OK")
    }
    with pytest.raises(ContractError):
        require_all_read(rows_in, rows_in + 1)
    with pytest.raises(ContractError):
        require_balanced(row | {"rows_ok": row["rows_ok"] + 1})


def test_gates(spark):
    silver = silver_of(flat_rows(spark), CHAPTERS)
    row = gate_metrics(silver, CHAPTERS).first()
    assert (row["rows_silver"], row["rows_bad_status"]) == (len(PUBLISHED), 0)
    states = [key[0] for key in PUBLISHED]
    assert [row[f"rows_group_{g}"] for g in ("ca", "or", "wa")] == [states.count(s) for s in "COW"]
    require_publishable(row, CHAPTERS)


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda s: s.filter("false"), "nothing to publish"),
        (lambda s: s.withColumn("dq_status", F.lit("BAD")), "none of"),
        (lambda s: s.withColumn("dq_status", F.lit(None).cast("string")), "none of"),
        (lambda s: s.withColumn("state", F.lit("OR")), "required state: CA"),
    ],
)
def test_gates_refuse(spark, change, message):
    silver = change(silver_of(flat_rows(spark), CHAPTERS))
    with pytest.raises(GateError, match=message):
        require_publishable(gate_metrics(silver, CHAPTERS).first(), CHAPTERS)


def test_group_counts_fill_zeros(spark):
    df = spark.createDataFrame([("CA",), ("CA",), ("XX",), (None,)], "state string")
    rows = {r["state"]: r["n_rows"] for r in group_counts(spark, df, "state", ("CA", "OR")).collect()}
    assert rows == {"CA": 2, "OR": 0}


def test_contract_schema(spark):
    gold = contract_projection(silver_of(flat_rows(spark), CHAPTERS), CHAPTERS)
    require_contract_schema(gold, CHAPTERS)
    assert gold.columns == list(CHAPTERS.contract_columns)
    for wrong in (
        gold.drop("city"),
        gold.select(*reversed(gold.columns)),
        gold.withColumn("longitude", F.col("longitude").cast("float")),
        gold.withColumn("MEVR_RD", F.lit("x")),
    ):
        with pytest.raises(ContractError):
            require_contract_schema(wrong, CHAPTERS)


def test_silver_columns(spark):
    assert silver_of(flat_rows(spark), CHAPTERS).columns == [
        "chapter_id", "chapter_name", "city", "state", "longitude", "latitude", "dq_status",
        "dq_warnings", "source_object_id", "ingest_run_id", "ingested_at_utc",
    ]


def test_contract_assertions_count_every_violation(spark):
    gold = contract_projection(silver_of(flat_rows(spark), CHAPTERS), CHAPTERS)
    require_contract(gold, CHAPTERS)
    one = gold.limit(1)
    bad = gold
    for name, value in (
        ("longitude", F.lit(float("nan"))),
        ("dq_status", F.lit("WARNING")),
        ("dq_status", F.lit("ODD")),
        ("state", F.lit("NV")),
        ("chapter_id", F.lit(None).cast("string")),
    ):
        clean = one.withColumn("dq_warnings", F.array().cast("array<string>"))
        bad = bad.union(clean.withColumn(name, value))
    row = contract_assertions(bad, CHAPTERS).first().asDict()
    assert row["rows_checked"] == len(PUBLISHED) + 5
    assert row["hard_rule_broken"] == 1
    assert row["status_outside_domain"] == 1
    assert row["out_of_scope"] == 1
    assert row["null_key"] == 1
    assert row["repeated_key"] == 4
    with pytest.raises(ContractError):
        require_contract(bad, CHAPTERS)


def test_freshness_and_overlap(spark):
    flat = flat_rows(spark)
    silver = silver_of(flat, CHAPTERS)
    row = freshness(silver).first()
    assert (row["n_runs"], row["rows_without_run"]) == (1, 0)
    assert overlap(quarantine_split(flat, CHAPTERS), silver, ["chapter_id"]).first()[0] == 0
    assert overlap(silver, silver, ["chapter_id"]).first()[0] == len(PUBLISHED)


OLD = [("a", 1), ("b", 2), ("c", None), ("d", 4), (None, 5)]
NEW = [("a", 1), ("b", 3), ("c", None), ("e", 6), (None, 5), (None, 7)]


def snapshots(spark):
    return (
        spark.createDataFrame(OLD, "k string, v int"),
        spark.createDataFrame(NEW, "k string, v int"),
    )


def test_change_report(spark):
    old, new = snapshots(spark)
    report = change_report(old, new, ["k"])
    rows = sorted((r["k"] or "", r["action"]) for r in report.collect())
    assert rows == [
        ("", "DELETE"), ("", "INSERT"), ("", "INSERT"),
        ("a", "UNCHANGED"), ("b", "UPDATE"), ("c", "UNCHANGED"), ("d", "DELETE"), ("e", "INSERT"),
    ]
    counts = {r["action"]: r["n_rows"] for r in change_counts(report).collect()}
    assert counts == {"INSERT": 3, "DELETE": 2, "UPDATE": 1, "UNCHANGED": 2}


def test_merge_snapshot_and_upsert(spark):
    old, new = snapshots(spark)
    key = lambda df: sorted((r["k"] or "", r["v"] or 0) for r in df.collect())
    assert key(merge_snapshot(old, new, ["k"])) == key(new)
    assert key(merge_upsert(old, new, ["k"])) == sorted(
        [("d", 4), ("", 5)] + [(k or "", v or 0) for k, v in NEW]
    )
    twice = new.union(new.filter("k = 'a'"))
    assert [r["k"] for r in repeated_keys(twice, ["k"]).collect()] == ["a"]
    with pytest.raises(ContractError):
        merge_snapshot(old, twice, ["k"])
    with pytest.raises(ContractError):
        merge_upsert(old, twice, ["k"])
    for pair in ((old, twice), (twice, old)):
        with pytest.raises(ContractError, match="more than once"):
            change_report(*pair, ["k"])


def test_null_keys_do_not_enter_the_join(spark):
    old = spark.range(0, 8000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v")
    )
    report = change_report(old, old, ["k"])
    counts = {r["action"]: r["n_rows"] for r in change_counts(report).collect()}
    assert counts == {"UNCHANGED": 4000, "DELETE": 4000, "INSERT": 4000}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Keyless rows stay in their own partitions: no reducer gets more than its share.
        sizes = report.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert sizes <= 1100
        latest = latest_wins(old, ["k"], (OrderBy("v"),))
        joined = change_report(latest, latest, ["k"], assume_unique=True)
        # The join reuses the partitioning that deduplication left behind.
        assert plan_of(joined).count("Exchange hashpartitioning") <= 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_ties_on_a_map_column(spark):
    rows = spark.sql("SELECT 1 AS k, 1 AS v, map('a', n) AS m FROM VALUES (2), (1), (3) AS t(n)")
    found = {latest_wins(rows.repartition(n), ["k"], (OrderBy("v"),)).first()["m"]["a"] for n in (1, 3)}
    assert found == {1}


def test_ledgers_with_different_columns(spark):
    a = summary_frame(spark, {"run_id": "r1", "rows_in": 5, "finished_at_utc": "2026-01-01"})
    b = summary_frame(spark, {"run_id": "r2", "rows_gold": 4, "finished_at_utc": "2026-01-02"})
    both = union_ledgers(a, b)
    assert {r["run_id"]: (r["rows_in"], r["rows_gold"]) for r in both.collect()} == {
        "r1": (5, None), "r2": (None, 4),
    }
    assert [r["run_id"] for r in newest_first(both).collect()] == ["r2", "r1"]
    assert newest_first(both, 1).count() == 1


def test_several_pages_keep_the_highest_object_id(spark):
    pages = [page(record(n, "CA-1", "CA", name=f"n{n}"), more=n < 3) for n in (1, 2, 3)]
    assert silver_of(flat_rows(spark, pages), CHAPTERS).first()["chapter_name"] == "n3"
    assert isinstance(documents(spark, PAGES).schema, StructType)
