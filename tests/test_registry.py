"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tidegate.registry import ORACLES, QUERIES
from tools.check_oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    row = entry.entry(spark).first().asDict()
    assert row["rows_in"] == sum(
        row[f"rows_{part}"] for part in ("out_of_scope", "quarantined", "deduped", "warned", "ok")
    )


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_ledger_of_a_known_classification(spark):
    """Counts taken step by step by another engine on the same table."""
    from pyspark.sql import functions as F

    from tidegate.operators.flatten import flatten_table
    from tidegate.operators.ledger import disposition_counts, run_ledger
    from tidegate.operators.route import routed
    from tidegate.plans.silver import silver_of
    from tidegate.registry.on_tables import LINES, line_items
    from tidegate.spec import Rule

    spec = LINES.with_changes(
        hard_rules=(Rule("DISCOUNT", lambda: F.col("discount") >= 0.1),),
        soft_rules=(Rule("ORDER", lambda: F.col("order_key") % 50 == 0),),
    )
    flat = flatten_table(line_items(spark, "/root/testdata/sf0.01"), spec)
    ledger = run_ledger(routed(flat, spec), silver_of(flat, spec))
    assert {r["disposition"]: r["n_rows"] for r in disposition_counts(ledger).collect()} == {
        "OUT_OF_SCOPE": 20046,
        "QUARANTINED": 1917,
        "DUPLICATE": 6103,
        "WARNING": 605,
        "OK": 31329,
    }
