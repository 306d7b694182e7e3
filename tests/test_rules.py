from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidegate.functions import annotate, blank_or_literal, outside_range, run_id_at, run_id_of
from tidegate.functions.rules import any_failed, quarantine_reason, warnings_array
from tidegate.operators.route import quarantine_split, routed, survivors
from tidegate.plans.chapters import CHAPTERS
from tidegate.spec import BlankOrLiteral, Field, OrderBy, OutsideRange, ProductSpec, Rule


BOUNDS = [(0.0, 1.0), (-180.0, 180.0), (2.5, 2.5)]


@pytest.mark.parametrize(("low", "high"), BOUNDS)
def test_a_range_includes_its_ends_and_nothing_beyond(spark, low, high):
    middle = (low + high) / 2
    inside = [low, high, middle]
    outside = [low - 0.25, high + 0.25, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(x,) for x in inside + outside], "reading double")
    verdicts = df.select(outside_range(F.col("reading"), low, high).alias("bad")).collect()
    assert [row["bad"] for row in verdicts] == [False] * len(inside) + [True] * len(outside)


def test_text_that_is_no_number_is_out_of_every_range(spark):
    df = spark.createDataFrame([("7",), ("seven",), (" ",)], "raw string")
    typed = df.select(outside_range(F.col("raw").try_cast("double"), 0, 10).alias("bad"))
    assert [row["bad"] for row in typed.collect()] == [False, True, True]


def test_only_blank_text_and_the_literal_itself_are_blank(spark):
    literal = "unknown"
    padded = [pad + word + pad for word in (literal, literal.title(), literal.upper()) for pad in ("", "  ")]
    kept = [literal + "s", "not " + literal, "\t", "0"]
    df = spark.createDataFrame([(x,) for x in [None, "", " " * 7, *padded, *kept]], "label string")
    verdicts = [row["bad"] for row in df.select(blank_or_literal(F.col("label")).alias("bad")).collect()]
    assert verdicts == [True] * (3 + len(padded)) + [False] * len(kept)


def test_annotations_follow_the_rules_of_any_spec(spark):
    hard = (Rule("TOO_COLD", lambda: F.col("kelvin") < 0),)
    soft = (BlankOrLiteral("NO_LABEL", "label"),)
    rows = [(i, kelvin, label) for i, (kelvin, label) in enumerate(
        (kelvin, label) for kelvin in (-1, 0, 300) for label in ("probe", None)
    )]
    df = spark.createDataFrame(rows, "id int, kelvin int, label string")
    for row in annotate(df, hard, soft).collect():
        assert row["is_quarantined"] is (row["kelvin"] < 0)
        assert row["quarantine_reason"] == ("TOO_COLD" if row["kelvin"] < 0 else None)
        assert row["dq_warnings"] == ([] if row["label"] else ["NO_LABEL"])
        assert row["dq_status"] == ("OK" if row["label"] else "WARNING")


def test_several_rules_keep_their_order(spark):
    hard = (Rule("H1", lambda: F.col("a") < 0), Rule("H2", lambda: F.col("b") < 0))
    soft = (BlankOrLiteral("S1", "t"), Rule("S2", lambda: F.col("a") > 10))
    df = spark.createDataFrame(
        [(-1, -1, "x"), (1, -1, "x"), (11, 1, None), (1, 1, "x"), (None, 1, "x")],
        "a int, b int, t string",
    )
    rows = df.select(quarantine_reason(hard).alias("h"), warnings_array(soft).alias("s")).collect()
    assert [r["h"] for r in rows] == ["H1", "H2", None, None, "H1"]
    assert [r["s"] for r in rows] == [[], [], ["S1", "S2"], [], ["S2"]]


def test_null_verdict_never_loses_a_row(spark):
    spec = ProductSpec(
        fields=(Field("k", "k"), Field("a", "a", "int")),
        key=("k",),
        order=(OrderBy("a"),),
        contract=(("k", "string"),),
        hard_rules=(Rule("NEGATIVE", lambda: F.col("a") < 0),),
        lineage={},
    )
    df = spark.createDataFrame(
        [("x", 1), ("y", None), ("z", -1)], "k string, a int"
    ).withColumn("raw_payload", F.lit("{}"))
    split = df.filter(any_failed(spec.hard_rules)), df.filter(~any_failed(spec.hard_rules))
    assert [s.count() for s in split] == [2, 1]
    assert quarantine_split(df, spec).count() + survivors(df, spec).count() == 3
    assert {r["route"] for r in routed(df, spec).collect()} == {"QUARANTINED", "SURVIVOR"}


def test_rules_stay_in_generated_code(spark):
    df = spark.range(5).select(
        F.col("id").cast("double").alias("longitude"),
        F.col("id").cast("double").alias("latitude"),
        F.col("id").cast("string").alias("city"),
    )
    annotated = annotate(df, CHAPTERS.hard_rules, CHAPTERS.soft_rules)
    plan = annotated._jdf.queryExecution().executedPlan().toString()
    assert plan.startswith("*(1) Project")


def test_run_ids(spark):
    row = spark.sql("select timestamp'2026-01-02 03:04:05' t").select(run_id_of(F.col("t")).alias("r"))
    assert row.first()["r"] == "run_20260102T030405Z"
    east = timezone(timedelta(hours=9))
    assert run_id_at(datetime(2026, 1, 2, 12, 4, 5, tzinfo=east)) == "run_20260102T030405Z"
    with pytest.raises(ValueError):
        run_id_at(datetime(2026, 1, 2))


def test_spec_refuses_contradictions():
    base = dict(fields=(Field("a", "a"),), key=("a",), order=(OrderBy("a"),), contract=(("a", "string"),))
    ProductSpec(**base)
    for wrong in (
        {"null_key": "drop"},
        {"key": ()},
        {"required_groups": ("x",)},
        {"expected_groups": ("x",)},
        {"forbidden_columns": ("a",)},
        {"group": "a", "expected_groups": ("CA", "ca")},
        {"payload_paths": ("person.name",), "forbidden_columns": ("name",)},
        {"payload_paths": ("a.b",)},
        {"contract": (("a", "string"), ("b", "string"))},
        {"order": (OrderBy("b"),)},
        {"key": ("b",)},
        {"scope": ("b", ("x",))},
        {"group": "b"},
        {"hard_rules": (BlankOrLiteral("R", "a"),), "soft_rules": (BlankOrLiteral("R", "a"),)},
    ):
        with pytest.raises(ValueError):
            ProductSpec(**(base | wrong))
    assert OutsideRange("c", (("a", 0, 1),)).code == "c"
