from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from samples import CASES, LEDGER, PAGES, PUBLISHED, documents, flat_rows, ids, page, record

from tidegate import storage
from tidegate.errors import ContractError, GateError, LandingError, TidegateError
from tidegate.lake import Lake
from tidegate.operators.flatten import flatten_table
from tidegate.operators.landing import land_documents
from tidegate.operators.quarantine import quarantined_by_run, read_quarantine, write_quarantine
from tidegate.operators.route import quarantine_split
from tidegate.operators.runs import newest_first, read_runs
from tidegate.operators.snapshots import SnapshotTable
from tidegate.plans import publish_gold, run_folder, run_landed, run_pages, silver_of, transform
from tidegate.plans.chapters import CHAPTERS
from tidegate.plans.publish import derived_ledger, register_views
from tidegate.session import scale_settings, scratch_root
from tidegate.sources import find_run, landed_runs, read_landed_documents
from tidegate.streaming import land_new_pages


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("run") / "lake"), "points")
    summary = run_pages(spark, CHAPTERS, lake, documents(spark), "run_1", source="sample")
    return lake, summary


def gold_rows(spark, lake):
    return {r["chapter_id"]: r for r in SnapshotTable(spark, lake.gold).read().collect()}


def test_summary_counts(finished):
    _, summary = finished
    assert {name: summary[name] for name in LEDGER} == LEDGER
    by_state = {state: len([key for key in PUBLISHED if key[0] == state[0]]) for state in ("CA", "OR", "WA")}
    assert summary["rows_gold"] == len(PUBLISHED) == sum(by_state.values())
    assert {state: summary[f"rows_gold_{state.lower()}"] for state in by_state} == by_state


def test_gold_has_the_contract_and_the_latest_of_each_key(spark, finished):
    lake, _ = finished
    assert SnapshotTable(spark, lake.gold).read().dtypes == list(CHAPTERS.contract)
    rows = gold_rows(spark, lake)
    assert set(rows) == PUBLISHED
    assert {rows[key]["chapter_name"] for key in ("C-50", "W-40")} == {"Third", "College 40"}
    for key, row in rows.items():
        warned = key in ids("WARNING")
        assert row["dq_status"] == ("WARNING" if warned else "OK")
        assert row["dq_warnings"] == ["MISSING_OR_UNKNOWN_CITY"] * warned


def test_every_rejected_record_is_kept_whole(spark, finished):
    lake, _ = finished
    rows = {r["chapter_id"]: r for r in read_quarantine(spark, lake, CHAPTERS).collect()}
    assert set(rows) == ids("QUARANTINED")
    assert {(r["quarantine_reason"], r["ingest_run_id"]) for r in rows.values()} == {("INVALID_COORDINATES", "run_1")}
    for outcome, rejected in CASES:
        if outcome == "QUARANTINED":
            shown = {k: v for k, v in rejected["attributes"].items() if k != "MEVR_RD"}
            payload = json.loads(rows[rejected["attributes"]["ChapterID"]]["raw_payload"])
            assert payload == {"attributes": shown, "geometry": rejected["geometry"]}


def test_bronze_is_verbatim(spark, finished):
    lake, _ = finished
    landed = read_landed_documents(spark, lake, find_run(spark, lake, "run_1"))
    assert {r["page_no"]: json.loads(r["document"]) for r in landed.collect()} == dict(enumerate(PAGES, 1))


def test_landed_row_groups_hold_few_documents(spark, lake):
    pages = [page(record(n, f"CA-{n}", "CA"), more=n < 450) for n in range(1, 451)]
    run = land_documents(spark, documents(spark, pages).coalesce(1), lake, CHAPTERS, "run_1")
    files = storage.glob(spark, f"{lake.bronze}/{run.folder}/*.parquet")
    found = [pq.ParquetFile(file.removeprefix("file:")).metadata for file in files]
    sizes = [m.row_group(i).num_rows for m in found for i in range(m.num_row_groups)]
    assert sum(sizes) == 450 and max(sizes) <= 200


def test_run_table_and_views(spark, finished):
    lake, _ = finished
    register_views(spark, CHAPTERS, lake, "t_")
    assert spark.sql("select * from t_gold order by chapter_id limit 100").first()["chapter_id"] == min(PUBLISHED)
    assert spark.sql("select run_id from t_runs order by finished_at_utc desc").first()[0] == "run_1"
    assert spark.sql("select count(*) from t_quarantine where ingest_run_id = 'run_1'").first()[0] == LEDGER["rows_quarantined"]
    assert newest_first(read_runs(spark, lake)).first()["source"] == "sample"


def test_derived_ledger(spark, finished):
    lake, _ = finished
    derived = derived_ledger(spark, CHAPTERS, lake, "run_1")
    assert derived == {name: LEDGER[name] for name in derived} and len(derived) == 5


def test_repeating_a_run_converges(spark, lake):
    first = run_pages(spark, CHAPTERS, lake, documents(spark), "run_1")
    again = run_landed(spark, CHAPTERS, lake, "run_1")
    assert {k: first[k] for k in LEDGER} == {k: again[k] for k in LEDGER}
    assert read_quarantine(spark, lake, CHAPTERS).count() == LEDGER["rows_quarantined"]
    assert len(gold_rows(spark, lake)) == len(PUBLISHED)
    assert landed_runs(spark, lake).count() == 1


def test_direct_and_staged_transform_agree(spark, tmp_path):
    flat = flat_rows(spark)
    results = []
    for name, stage in (("a", True), ("b", False)):
        lake = Lake(str(tmp_path / name), "points")
        counts = transform(spark, flat, CHAPTERS, lake, "run_1", stage=stage)
        silver = SnapshotTable(spark, lake.silver).read().collect()
        rejected = read_quarantine(spark, lake, CHAPTERS).collect()
        results.append((counts, sorted(map(str, silver)), sorted(map(str, rejected))))
    assert results[0] == results[1]
    assert results[0][0] == LEDGER
    assert not storage.glob(spark, f"{scratch_root(spark)}/tidegate/routed-*")


def test_everything_out_of_scope(spark, lake):
    flat = flat_rows(spark, [page(record(1, "NV-1", "NV"))])
    counts = transform(spark, flat, CHAPTERS, lake, "run_1")
    assert counts["rows_out_of_scope"] == 1 and counts["rows_silver"] == 0
    with pytest.raises(GateError, match="nothing to publish"):
        publish_gold(spark, CHAPTERS, lake, "run_1")


@pytest.mark.parametrize("stage", [True, False])
def test_everything_quarantined(spark, lake, stage):
    flat = flat_rows(spark, [page(record(1, "CA-1", "CA", x=999), record(2, "CA-2", "CA", x=999))])
    counts = transform(spark, flat, CHAPTERS, lake, "run_1", stage=stage)
    assert counts["rows_quarantined"] == 2 and counts["rows_silver"] == 0
    assert SnapshotTable(spark, lake.silver).read().count() == 0


@pytest.mark.parametrize("stage", [True, False])
def test_a_retried_task_is_counted_once(spark, lake, stage, tmp_path):
    """One task fails after it has handed out its rows; its second attempt must not add to them."""
    marker = tmp_path / "failed"

    def fail_first_attempt(frames):
        from pyspark import TaskContext

        yield from frames
        context = TaskContext.get()
        if context.partitionId() == 1 and context.attemptNumber() == 0:
            marker.touch()
            raise RuntimeError("lost task")

    flat = flat_rows(spark).repartition(3)
    flaky = flat.mapInPandas(fail_first_attempt, flat.schema)
    assert transform(spark, flaky, CHAPTERS, lake, "run_1", stage=stage) == LEDGER
    assert marker.exists()
    assert SnapshotTable(spark, lake.silver).read().count() == len(PUBLISHED)
    assert read_quarantine(spark, lake, CHAPTERS).count() == LEDGER["rows_quarantined"]


def test_verified_publish_refuses_a_broken_silver(spark, lake):
    silver = silver_of(flat_rows(spark, run_id="run_1"), CHAPTERS)
    table = SnapshotTable(spark, lake.silver)
    table.publish(silver, "run_1")
    publish_gold(spark, CHAPTERS, lake, "run_1", verify=True)
    again = silver_of(flat_rows(spark, run_id="run_2"), CHAPTERS)
    table.publish(again.union(again), "run_2")
    with pytest.raises(ContractError, match="repeated_key"):
        publish_gold(spark, CHAPTERS, lake, "run_2", verify=True)
    with pytest.raises(ContractError, match="more than once"):
        publish_gold(spark, CHAPTERS, lake, "run_2", merge=True)
    assert len(gold_rows(spark, lake)) == len(PUBLISHED)


def test_a_clean_repeat_empties_the_runs_quarantine(spark, lake):
    write_quarantine(quarantine_split(flat_rows(spark, run_id="r1"), CHAPTERS), lake, "r1")
    write_quarantine(quarantine_split(flat_rows(spark, run_id="r2"), CHAPTERS), lake, "r2")
    clean = flat_rows(spark, [page(record(1, "CA-1", "CA"))], run_id="r2")
    write_quarantine(quarantine_split(clean, CHAPTERS), lake, "r2")
    rows = quarantined_by_run(read_quarantine(spark, lake, CHAPTERS)).collect()
    assert [(r["ingest_run_id"], r["n_rows"]) for r in rows] == [("r1", LEDGER["rows_quarantined"])]


def test_quarantine_read_prunes_to_the_run(spark, lake):
    write_quarantine(quarantine_split(flat_rows(spark, run_id="r1"), CHAPTERS), lake, "r1")
    assert read_quarantine(spark, lake, CHAPTERS, "r1").count() == LEDGER["rows_quarantined"]
    assert read_quarantine(spark, lake, CHAPTERS, "r9").count() == 0
    mine = read_quarantine(spark, lake, CHAPTERS).filter(F.col("ingest_run_id") == "r1")
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_run_id" in plan


def test_vanished_chapter_leaves_gold_and_merge_counts_changes(spark, lake):
    run_pages(spark, CHAPTERS, lake, documents(spark), "run_1")
    pages = [page(record(40, "W-40", "WA"), record(60, "C-50", "CA", name="Newer"), record(61, "O-61", "OR"))]
    summary = run_pages(spark, CHAPTERS, lake, documents(spark, pages), "run_2", merge=True)
    assert set(gold_rows(spark, lake)) == {"W-40", "C-50", "O-61"}
    assert [summary[f"rows_{a}"] for a in ("inserted", "updated", "deleted", "unchanged")] == [
        1, 1, len(PUBLISHED) - 2, 1,
    ]
    runs = read_runs(spark, lake)
    assert {r["run_id"]: r["rows_deleted"] for r in runs.collect()} == {"run_1": None, "run_2": len(PUBLISHED) - 2}


def test_snapshots_stay_readable(spark, lake):
    table = SnapshotTable(spark, lake.gold)
    with pytest.raises(TidegateError):
        table.read()
    for version in (1, 2, 3):
        assert table.publish(spark.range(version), f"run_{min(version, 2)}") == version
    assert table.read().count() == 3
    assert table.as_of_version(1).count() == 1
    assert table.as_of_run("run_1").count() == 1 and table.as_of_run("run_2").count() == 3
    assert [r["version"] for r in table.history().orderBy("version").collect()] == [1, 2, 3]
    assert table.expire(keep=2) == 1 and table.expire(keep=2) == 0
    assert table.as_of_version(2).count() == 2
    with pytest.raises(TidegateError):
        table.as_of_run("run_9")


def test_failed_write_leaves_the_live_snapshot(spark, lake):
    table = SnapshotTable(spark, lake.gold)
    table.publish(spark.range(2), "run_1")
    broken = spark.range(4).select(F.raise_error(F.lit("boom")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        table.publish(broken, "run_2")
    assert table.read().count() == 2
    assert table.publish(spark.range(5), "run_2") == 2


def test_refused_publish_keeps_gold_and_records_no_run(spark, lake):
    run_pages(spark, CHAPTERS, lake, documents(spark), "run_1")
    only_or = [page(record(1, "OR-1", "OR"))]
    with pytest.raises(GateError, match="CA"):
        run_pages(spark, CHAPTERS, lake, documents(spark, only_or), "run_2")
    assert len(gold_rows(spark, lake)) == len(PUBLISHED)
    assert [r["run_id"] for r in read_runs(spark, lake).collect()] == ["run_1"]


def test_refused_landing_keeps_the_earlier_one(spark, lake):
    land_documents(spark, documents(spark), lake, CHAPTERS, "run_1")
    for bad in ([page()], [{"error": {"code": 1}}], [{"x": 1}]):
        with pytest.raises(LandingError):
            land_documents(spark, documents(spark, bad), lake, CHAPTERS, "run_1")
    run = find_run(spark, lake, "run_1")
    assert run.rows_in == len(CASES) and read_landed_documents(spark, lake, run).count() == 2
    with pytest.raises(LandingError):
        find_run(spark, lake, "run_9")


def test_landing_again_replaces_and_the_newest_date_wins(spark, lake):
    day = [datetime(2026, 1, d, 5, tzinfo=timezone.utc) for d in (1, 2)]
    one = [page(record(1, "CA-1", "CA"))]
    land_documents(spark, documents(spark), lake, CHAPTERS, "run_1", day[0])
    land_documents(spark, documents(spark, one), lake, CHAPTERS, "run_1", day[0])
    assert find_run(spark, lake, "run_1").rows_in == 1
    assert len(storage.glob(spark, f"{lake.bronze}/ingest_date=*/run_id=*/attempt=*")) == 1
    land_documents(spark, documents(spark), lake, CHAPTERS, "run_1", day[1])
    run = find_run(spark, lake, "run_1")
    assert (run.ingest_date, run.rows_in) == ("2026-01-02", len(CASES))
    assert run.ingested_at_utc.startswith("2026-01-02T05:00:00")
    assert len(storage.glob(spark, f"{lake.bronze}/ingest_date=*/run_id=*/attempt=*")) == 2


def test_run_kept_as_page_files(spark, lake, tmp_path):
    folder = tmp_path / "bronze" / "ingest_date=2026-01-01" / "run_id=r1"
    folder.mkdir(parents=True)
    for number, body in enumerate(PAGES, 1):
        (folder / f"page_{number:04d}.json").write_text(json.dumps(body))
    described = dict(run_id="r1", ingest_date="2026-01-01", ingested_at_utc="2026-01-01T05:00:00+00:00",
                     source="live", pages=2, rows_in=len(CASES))
    (folder / "_ingest_metadata.json").write_text(json.dumps(described))
    summary = run_folder(spark, CHAPTERS, lake, str(tmp_path / "bronze"), "r1")
    assert {name: summary[name] for name in LEDGER} == LEDGER
    row = gold_rows(spark, lake)["W-40"]
    assert row["ingest_run_id"] == "r1"
    at = SnapshotTable(spark, lake.gold).read().select(F.date_format("ingested_at_utc", "yyyy-MM-dd HH:mm"))
    assert at.first()[0] == "2026-01-01 05:00"
    described["rows_in"] += 1
    (folder / "_ingest_metadata.json").write_text(json.dumps(described))
    with pytest.raises(LandingError):
        run_folder(spark, CHAPTERS, lake, str(tmp_path / "bronze"), "r1")


@pytest.mark.parametrize(
    ("pages", "rows_in"),
    [
        ({1: page(record(1, "CA-1", "CA"), more=True), 3: {"error": {"code": 500}}}, 1),
        ({1: {"error": {"code": 500}}}, 0),
    ],
)
def test_a_bad_folder_leaves_silver_as_it_is(spark, lake, tmp_path, pages, rows_in):
    run_pages(spark, CHAPTERS, lake, documents(spark), "before")
    folder = tmp_path / "bronze" / "ingest_date=2026-01-01" / "run_id=r1"
    folder.mkdir(parents=True)
    for number, body in pages.items():
        (folder / f"page_{number:04d}.json").write_text(json.dumps(body))
    described = dict(run_id="r1", ingest_date="2026-01-01", ingested_at_utc="2026-01-01T05:00:00+00:00",
                     source="live", pages=len(pages), rows_in=rows_in)
    (folder / "_ingest_metadata.json").write_text(json.dumps(described))
    with pytest.raises(LandingError):
        run_folder(spark, CHAPTERS, lake, str(tmp_path / "bronze"), "r1")
    assert {r["run_id"] for r in SnapshotTable(spark, lake.silver).history().collect()} == {"before"}


def test_stream_lands_each_file_once(spark, lake, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    for number, body in enumerate(PAGES, 1):
        (incoming / f"page_{number:04d}.json").write_text(json.dumps(body, indent=1))
    checkpoint = str(tmp_path / "checkpoint")

    def trigger():
        land_new_pages(spark, str(incoming), lake, CHAPTERS, checkpoint).awaitTermination()

    trigger()
    trigger()
    runs = landed_runs(spark, lake).collect()
    assert [(r["run_id"], r["rows_in"]) for r in runs] == [("stream_00000000", len(CASES))]
    summary = run_landed(spark, CHAPTERS, lake, "stream_00000000")
    assert summary["rows_gold"] == len(PUBLISHED)


def test_silver_matches_the_lazy_plan(spark, finished):
    lake, _ = finished
    lazy = silver_of(flat_rows(spark), CHAPTERS).drop("ingest_run_id", "ingested_at_utc")
    stored = SnapshotTable(spark, lake.silver).read().drop("ingest_run_id", "ingested_at_utc")
    assert lazy.exceptAll(stored).count() == 0 and stored.exceptAll(lazy).count() == 0


def test_scale_settings():
    small, large = scale_settings(0, 8), scale_settings(10 * 2**40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * 2**20)
    assert large["spark.sql.shuffle.partitions"] == "20480"
    assert large["spark.sql.files.maxPartitionBytes"] == str(512 * 2**20)


def test_local_scratch_is_shared_where_named(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_short_read_is_noticed_before_anything_is_published(spark, lake):
    with pytest.raises(ContractError, match=f"{len(CASES) + 1} were landed"):
        transform(spark, flat_rows(spark), CHAPTERS, lake, "run_1", rows_landed=len(CASES) + 1)
    assert not SnapshotTable(spark, lake.silver).exists()
    assert not storage.exists(spark, lake.quarantine)


def test_landing_records_the_scope_as_where_clause(spark, lake):
    land_documents(spark, documents(spark), lake, CHAPTERS, "run_1")
    land_documents(spark, documents(spark), lake, CHAPTERS, "run_2", where_clause="State = 'CA'")
    assert find_run(spark, lake, "run_1").where_clause is None
    assert find_run(spark, lake, "run_2").where_clause == "State = 'CA'"


def test_publishing_reads_the_silver_of_the_run_it_names(spark, lake):
    run_pages(spark, CHAPTERS, lake, documents(spark), "run_1")
    with pytest.raises(TidegateError):
        publish_gold(spark, CHAPTERS, lake, "run_never_existed")
    silver = SnapshotTable(spark, lake.silver)
    silver.publish(silver.read(), "run_2")  # rows of another run under this run's name
    with pytest.raises(GateError):
        publish_gold(spark, CHAPTERS, lake, "run_2")
    assert {r["run_id"] for r in SnapshotTable(spark, lake.gold).history().collect()} == {"run_1"}


def test_a_repeated_run_is_one_row_of_the_run_table(spark, lake):
    run_pages(spark, CHAPTERS, lake, documents(spark), "run_1")
    run_landed(spark, CHAPTERS, lake, "run_1")
    assert [r["run_id"] for r in read_runs(spark, lake).collect()] == ["run_1"]


def test_of_two_writers_the_later_is_refused(spark, lake):
    first, second = SnapshotTable(spark, lake.gold), SnapshotTable(spark, lake.gold)
    a, b = first.write(spark.range(5), "a"), second.write(spark.range(2), "b")
    first.commit(a)
    with pytest.raises(TidegateError):
        second.commit(b)
    assert SnapshotTable(spark, lake.gold).read().count() == 5


def test_forbidden_and_redacted_columns_of_a_table_stay_out_of_the_payload(spark):
    spec = CHAPTERS.with_changes(redact=("nest.secret",))
    nest = F.struct(F.lit("s3").alias("secret"), F.lit("ok").alias("open"))
    paths = {field.path.split(".")[0] for field in spec.fields}
    columns = {name: F.lit(None).cast("string") for name in paths}
    table = spark.range(1).select(*(c.alias(n) for n, c in columns.items()), nest.alias("nest"), F.lit("a person").alias("MEVR_RD"))
    spec = spec.with_changes(
        fields=tuple(replace(f, path=f.path.split(".")[0]) for f in spec.fields), payload_paths=()
    )
    text = flatten_table(table, spec).first()["raw_payload"]
    assert "person" not in text and "s3" not in text and '"open":"ok"' in text
