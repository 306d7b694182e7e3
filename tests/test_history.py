"""Row history, buckets, one winner of several writers, quarantine by attempt, run table types."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, time, timedelta, timezone
from threading import Barrier

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import flat_rows

from tidegate import storage
from tidegate.errors import GateError, TidegateError
from tidegate.operators.freshness import publication_calendar, require_fresh
from tidegate.operators.history import extend_history, first_history, publications, row_history
from tidegate.operators.merge import buckets_for, compared_buckets, rows_of_changed
from tidegate.operators.quarantine import read_quarantine, write_quarantine
from tidegate.operators.route import quarantine_split
from tidegate.operators.runs import append_run, read_runs
from tidegate.operators.snapshots import SnapshotTable
from tidegate.plans.chapters import CHAPTERS

SCHEMA = "k int, part string, v int, w string"
SNAPSHOT = st.dictionaries(
    st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from(["a", None])),
    st.tuples(st.one_of(st.none(), st.integers(0, 1)), st.sampled_from(["x", None])),
    max_size=4,
)


def model(snapshots):
    """Intervals, one key at a time."""
    found = []
    for key in {key for snapshot in snapshots for key in snapshot}:
        open_since, value = None, None
        for at, snapshot in enumerate([*snapshots, {}]):
            last = at == len(snapshots)
            here = snapshot.get(key, "absent")
            if open_since is not None and (last or here != value):
                found.append((*key, *value, f"r{open_since}", None if last else f"r{at}"))
                open_since = None
            if not last and here != "absent" and open_since is None:
                open_since, value = at, here
    return sorted(map(repr, found))


@settings(
    deadline=None, derandomize=True, database=None, max_examples=12,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(snapshots=st.lists(SNAPSHOT, min_size=1, max_size=4))
def test_history_equals_the_model(spark, snapshots):
    frames = [
        (f"r{at}", spark.createDataFrame([(*k, *v) for k, v in snapshot.items()], SCHEMA))
        for at, snapshot in enumerate(snapshots)
    ]
    key = ["k", "part"]
    whole = row_history(frames, key)
    assert sorted(map(repr, map(tuple, whole.collect()))) == model(snapshots)
    kept = first_history(frames[0][1], "r0", key)
    for run_id, frame in frames[1:]:
        kept = extend_history(kept, frame, run_id, key)
    assert kept.columns == whole.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == model(snapshots)


def test_history_of_a_table_and_of_what_was_expired(spark, lake):
    table = SnapshotTable(spark, lake.gold)
    for run, n in (("a", 2), ("b", 3), ("c", 1)):
        table.publish(spark.range(n), run)
    found = row_history(publications(table), ["id"], [])
    assert {tuple(r) for r in found.collect()} == {(0, "a", None), (1, "a", "c"), (2, "b", "c")}
    table.expire(keep=2)
    assert [run for run, _ in publications(table)] == ["b", "c"]
    with pytest.raises(ValueError):
        row_history([], ["id"])


def test_as_of_a_time(spark, lake):
    table = SnapshotTable(spark, lake.gold)
    table.publish(spark.range(1), "a")
    between = datetime.now(timezone.utc)
    table.publish(spark.range(2), "b")
    assert table.as_of_time(between).count() == 1
    assert table.as_of_time(between + timedelta(hours=1)).count() == 2
    with pytest.raises(TidegateError):
        table.as_of_time(between - timedelta(hours=1))
    with pytest.raises(ValueError):
        table.as_of_time(datetime(2026, 1, 1))


def test_of_writers_between_the_same_steps_one_wins(spark, lake, monkeypatch):
    """Both have read the log before either writes to it."""
    tables = [SnapshotTable(spark, lake.gold) for _ in range(3)]
    written = [table.write(spark.range(n), f"r{n}") for n, table in enumerate(tables, 1)]
    together = Barrier(3)
    newest = SnapshotTable._newest

    def read_then_wait(self, condition=None):
        found = newest(self, condition)
        together.wait(60)
        return found

    monkeypatch.setattr(SnapshotTable, "_newest", read_then_wait)

    def commit(table, entry):
        try:
            return table.commit(entry)
        except TidegateError:
            return None

    with ThreadPoolExecutor(3) as pool:
        results = list(pool.map(commit, tables, written))
    monkeypatch.undo()
    assert sorted(results, key=str) == [1, None, None]
    winner = results.index(1)
    assert [r["run_id"] for r in tables[0].history().collect()] == [f"r{winner + 1}"]
    assert tables[0].read().count() == winner + 1
    assert tables[0].publish(spark.range(9), "next") == 2


def test_a_claim_of_a_dead_writer_can_be_released(spark, lake):
    table = SnapshotTable(spark, lake.gold)
    table.publish(spark.range(1), "a")
    assert storage.claim(spark, table._claim(2)) and not storage.claim(spark, table._claim(2))
    with pytest.raises(TidegateError, match="claimed"):
        table.publish(spark.range(2), "b")
    assert table.release() and not table.release()
    assert table.publish(spark.range(2), "b") == 2


def test_only_changed_buckets_are_joined(spark):
    old = spark.range(2000).withColumn("v", F.lit("x"))
    new = old.withColumn("v", F.when(F.col("id") == 77, "y").otherwise(F.col("v"))).filter("id <> 1234")
    known = compared_buckets(old, new, ["id"], 256)
    assert known.filter("is_changed").count() == 2
    joined = [rows_of_changed(side, ["id"], 256, known).count() for side in (old, new)]
    assert joined[0] == joined[1] + 1 and joined[0] < 40
    assert known.filter("NOT is_changed").agg(F.sum("n_rows")).first()[0] + joined[1] == 1999
    again = compared_buckets(old, old.repartition(7), ["id"], 256)
    assert again.filter("is_changed").count() == 0
    # a value that moves from one column to another, and a row that is there twice
    pairs = spark.createDataFrame([(1, None, "a")], "id int, p string, q string")
    moved = spark.createDataFrame([(1, "a", None)], "id int, p string, q string")
    for other in (moved, pairs.union(pairs)):
        assert compared_buckets(pairs, other, ["id"], 4).filter("is_changed").count() == 1


def test_digests_take_maps_and_nested_columns(spark):
    rows = spark.range(5).select(
        "id", F.create_map(F.lit("a"), F.col("id")).alias("m"), F.array(F.struct("id")).alias("l")
    )
    changed = rows.withColumn("m", F.create_map(F.lit("a"), F.col("id") + 1))
    assert compared_buckets(rows, rows, ["id"], 4).filter("is_changed").count() == 0
    assert compared_buckets(rows, changed, ["id"], 1).filter("is_changed").count() == 1


def test_the_number_of_buckets_is_bounded():
    assert [buckets_for(n) for n in (0, 10**6, 10**13)] == [64, 100, 1 << 20]


def test_a_failed_quarantine_write_leaves_the_earlier_evidence(spark, lake):
    rejected = quarantine_split(flat_rows(spark, run_id="r1"), CHAPTERS)
    write_quarantine(rejected, lake, "r1")
    before = read_quarantine(spark, lake, CHAPTERS, "r1").count()
    broken = rejected.withColumn("city", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        write_quarantine(broken, lake, "r1")
    assert before and read_quarantine(spark, lake, CHAPTERS, "r1").count() == before
    assert read_quarantine(spark, lake, CHAPTERS).count() == before
    write_quarantine(rejected.limit(0), lake, "r1")
    assert read_quarantine(spark, lake, CHAPTERS).count() == 0
    assert len(storage.glob(spark, f"{lake.quarantine_run('r1')}/attempt=*")) == 1


def test_a_summary_column_has_one_type_whatever_its_values(spark, lake):
    append_run(spark, lake, {"run_id": "a", "attempt": None, "rows_in": None})
    append_run(spark, lake, {"run_id": "b", "attempt": 2, "rows_in": 3})
    append_run(spark, lake, {"run_id": "c", "attempt": True, "rows_in": 4, "pages": 5})
    append_run(spark, lake, {"run_id": "b", "attempt": 3, "rows_in": 9})
    found = {r["run_id"]: (r["attempt"], r["rows_in"], r["pages"]) for r in read_runs(spark, lake).collect()}
    assert found == {"a": (None, None, None), "b": ("3", 9, None), "c": ("true", 4, 5)}


def test_a_key_lookup_skips_what_cannot_hold_the_key(spark, lake):
    """Rows a scan hands on after it has looked at the statistics of sorted and of unsorted files."""
    rows = spark.range(0, 40_000, 1, 8).select((F.col("id") * 7919 % 40_000).alias("id"), F.rand(1).alias("v"))
    read = {}
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        for name, sort_by in (("sorted", ["id"]), ("unsorted", [])):
            table = SnapshotTable(spark, f"{lake.gold}/{name}")
            table.publish(rows, "run", sort_by=sort_by)
            wanted = table.read().filter(F.col("id") == 12_345)
            assert wanted.count() == 1 and len(wanted.collect()) == 1
            scan = wanted._jdf.queryExecution().executedPlan().collectLeaves().head()
            read[name] = scan.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert read["unsorted"] == 40_000 and read["sorted"] <= 20_000


def test_calendar_and_deadline(spark):
    log = spark.createDataFrame(
        [("2026-01-01 05:59:59",), ("2026-01-01 09:00:00",), ("2026-01-03 06:00:00",), ("2026-01-04 06:00:01",)],
        "at string",
    ).select(F.col("at").cast("timestamp").alias("published_at_utc"))
    calendar = publication_calendar(log, date(2025, 12, 31), date(2026, 1, 5), time(6))
    assert {r["day"].day: r["freshness"] for r in calendar.collect()} == {
        31: "MISSING", 1: "ON_TIME", 2: "MISSING", 3: "ON_TIME", 4: "LATE", 5: "MISSING",
    }
    at = lambda *parts: datetime(*parts, tzinfo=timezone.utc)
    require_fresh(log, at(2026, 1, 2, 5), time(6))  # yesterday's is still the newest due
    require_fresh(log, at(2026, 1, 4, 7), time(6))  # late, but there
    for moment in (at(2026, 1, 2, 6), at(2026, 1, 5, 7), at(2025, 12, 30)):
        with pytest.raises(GateError, match="is due"):
            require_fresh(log, moment, time(6))
    with pytest.raises(ValueError):
        require_fresh(log, datetime(2026, 1, 2), time(6))
