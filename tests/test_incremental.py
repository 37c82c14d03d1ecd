"""Loads in several steps against loads at once: commits, buckets, states, rejects."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from bundlelake.operators import gold as G
from bundlelake.operators import states
from bundlelake.operators.bronze import latest_copies, to_bronze
from bundlelake.operators.silver import flatten_all
from bundlelake.plans.incremental import read_current, read_rejects, run_load
from bundlelake.schemas import GOLD, RUN_LOG
from bundlelake.sinks import buckets as store
from bundlelake.sources import bundles as B
from bundlelake.sources import tables as sources
from bundlelake.streaming.ingest import stream_deliveries, streamed_documents
from tests import samples as S

DAYS = [f"2024-02-0{k}T00:00:00+00:00" for k in range(1, 9)]


def put(folder, name, content, at):
    """A landed file with a modification time of its own."""
    path = os.path.join(folder, name)
    data = content if isinstance(content, bytes) else (content if isinstance(content, str) else json.dumps(content)).encode()
    with open(path, "wb") as out:
        out.write(data)
    os.utime(path, (at, at))


def rows(frame):
    return sorted(map(str, frame.collect()))


def visit(key, patient, hours, cls="AMB"):
    return {
        "resourceType": "Encounter", "id": key, "status": "finished", "class": {"code": cls},
        "subject": {"reference": f"Patient/{patient}"},
        "period": {"start": "2024-01-01T00:00:00Z", "end": f"2024-01-01T{hours:02d}:00:00Z"},
    }


def rebuilt(spark, root):
    return G.build_all(flatten_all(read_current(spark, root, "bronze")), "now")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Three loads; the second breaks off before each of its stages first."""
    folder = tmp_path_factory.mktemp("land ing")
    landing, root = str(folder), str(tmp_path_factory.mktemp("lake") / "root")
    put(landing, "one.json", S.bundle("b-1", S.record("p-100")), 1000)
    put(landing, "none.json", "", 1000)
    put(landing, "cut.json", '{"resourceType": "Bundle", "entry": [', 1000)
    put(landing, "bare.json", S.record("p-100")[0], 1000)
    put(landing, "odd.json.gz", gzip.compress(b"x" * 5000)[:30], 1000)
    put(landing, "visits.json", S.bundle("b-v", [visit("v1", "p-100", 23), visit("v2", "p-9", 5), visit("v3", "p-8", 1)]), 1000)
    load = lambda run, day, **o: run_load(spark, landing, root, run, day, pattern="*.json*", **o)
    first = load("r1", DAYS[0], buckets=4).collect()
    before = store.latest(spark, root)
    put(landing, "late.json", S.bundle("b-2", S.record("p-200")), 1000)  # as new as the newest
    put(landing, "again.json", S.bundle("b-a", [visit("v1", "p-100", 2), visit("v2", "p-7", 6, "IMP"), visit("v3", "p-8", 1)]), 2000)
    for stage in ("bronze", "silver", "gold", "commit"):
        with pytest.raises(RuntimeError):
            load("r2", DAYS[1], stop_before=stage)
        assert store.latest(spark, root) == before
    failed = sources.read_table(spark, f"{root}/log/pipeline_run_log", RUN_LOG).filter("run_id = 'r2'").collect()
    load("r2", DAYS[1])
    return {"landing": landing, "root": root, "first": first, "before": before, "failed": failed, "load": load}


def test_a_broken_load_is_done_again_and_equals_one_load(spark, lake):
    docs = B.read_documents(spark, lake["landing"], "*.json*", skip_unreadable=True)
    found = B.explode_resources(B.parse_bundles(docs), DAYS[1])
    later = F.when(F.col("source_file").rlike("again|late"), DAYS[1]).otherwise(DAYS[0])
    full = latest_copies(to_bronze(found.withColumn("ingestion_timestamp", later), "x"))
    keys = ["resource_type", "resource_id", "version_id", "raw_json"]
    assert rows(read_current(spark, lake["root"], "bronze").select(keys)) == rows(full.select(keys))


def test_states_equal_a_rebuild(spark, lake):
    for name, table in rebuilt(spark, lake["root"]).items():
        assert rows(read_current(spark, lake["root"], f"gold_{name}").drop("gold_created_at")) == rows(table.drop("gold_created_at")), name
    visits = {r.patient_id: r for r in read_current(spark, lake["root"], "gold_patient_encounter_summary").collect()}
    assert visits["p-7"].total_encounters == 1 and "p-9" not in visits  # its only visit went to p-7
    assert visits["p-100"].total_encounters == 4 and visits["p-100"].min_los_hours <= 2.0
    assert visits["p-200"].full_name and visits["p-7"].full_name is None


def test_a_committed_run_and_an_empty_one_change_nothing(spark, lake):
    before, kept = store.latest(spark, lake["root"]), rows(read_current(spark, lake["root"], "bronze"))
    log = {r.stage: (r.status, r.records) for r in lake["load"]("r2", DAYS[2]).collect()}
    assert log["commit"][0] == "SUCCESS"
    assert [(r.stage, r.records) for r in lake["load"]("r3", DAYS[2]).collect()] == [("ingest", 0)]
    assert store.latest(spark, lake["root"]) == before and rows(read_current(spark, lake["root"], "bronze")) == kept


def test_unchanged_buckets_keep_their_files(spark, lake):
    after = store.latest(spark, lake["root"])
    changed = {b for b, run in after.parts["bronze"].items() if run == "r2"}
    assert changed and {r for r in after.parts["bronze"].values()} <= {"r1", "r2"}
    for b, run in lake["before"].parts["bronze"].items():
        if b not in changed:
            assert after.parts["bronze"][b] == run
    names = read_current(spark, lake["root"], "bronze").inputFiles()
    assert all(f"bucket={b}" in "".join(names) for b in after.parts["bronze"])


def test_added_rows_are_written_once(spark, lake):
    """The rows a run brings are not stored beside a second copy of them."""
    state = store.latest(spark, lake["root"])
    for table in ("bronze", "silver_encounter"):
        at = f"{lake['root']}/current/{table}/run_id=r1"
        stored = spark.read.parquet(at).filter("kind <> 'removed'").count()
        assert stored == spark.read.parquet(f"{at}/kind=added").count() > 0
    assert set(state.kinds["bronze"]) == set(state.parts["bronze"])


def test_a_large_bucket_is_dealt_out_to_several_tasks(spark, tmp_path, monkeypatch):
    """Neither merging nor writing a bucket waits for one task that holds all of it; the rows are the same."""
    landing = tmp_path / "in"
    landing.mkdir()
    visits = [visit(f"v{k}", f"p-{k % 7}", k % 24) for k in range(200)] + [visit("", "p-1", 3), visit("v5", "p-1", 5)]
    put(str(landing), "one.json", S.bundle("b-1", visits), 1000)
    found = {}
    for rows_each in (10, 1_000_000):
        monkeypatch.setattr(store, "PART_ROWS", rows_each)
        root = str(tmp_path / f"lake-{rows_each}")
        run_load(spark, str(landing), root, "r1", DAYS[0], buckets=1, checks=False)
        files = len(read_current(spark, root, "bronze").inputFiles())
        tables = ("bronze", "silver_encounter", *[f"gold_{n}" for n in GOLD])
        found[rows_each] = files, {t: rows(read_current(spark, root, t)) for t in tables}
    assert found[10][1] == found[1_000_000][1] and len(found[10][1]["bronze"]) == 201
    monkeypatch.setattr(store, "PART_ROWS", 10)
    parts = spark.range(200).select(store.part_of(200, 1, "id").alias("part")).groupBy("part").count().collect()
    assert len(parts) == 20 and max(r["count"] for r in parts) < 30


def test_a_change_without_removals_reads_no_source(spark):
    layout, ddl = G.BILLS, "patient_id string, claim_id string, claim_type string, total_amount double, created_date string"
    come = [(f"p{k % 3}", f"c{k}", "professional", 1.0 * k, "2024-01-01") for k in range(9)]
    added, none = spark.createDataFrame(come, ddl), spark.createDataFrame([], ddl)
    old = states.fresh(layout, spark.createDataFrame(come[:4], ddl))
    trap = added.withColumn("claim_id", F.raise_error(F.lit("read")).cast("string"))
    state = states.updated(layout, old, states.delta(layout, added, none), trap, removals=False)
    again = states.updated(layout, old, states.delta(layout, added, none), added)
    assert rows(state.select(*layout.columns())) == rows(again.select(*layout.columns()))


def test_buckets_of_older_commits_are_read_whole(spark, tmp_path):
    """An older commit says nothing of kinds: the rows under ``current`` are all, added ones included."""
    root, kinds = str(tmp_path), [("a", "current"), ("b", "current"), ("b", "added")]
    old = spark.createDataFrame(kinds, "x string, kind string").withColumn("bucket", F.lit(0))
    old.write.partitionBy("kind", "bucket").parquet(f"{root}/current/t/run_id=r1")
    state = store.State(parts={"t": {0: "r1"}})
    assert rows(store.read(spark, root, state, "t", "x string")) == ["Row(x='a')", "Row(x='b')"]
    fresh = spark.createDataFrame([("c", "added", 0)], "x string, kind string, bucket int")
    store.write(fresh, root, state, "t", "r2", {0})
    store.commit(spark, root, state, "r2", spark.createDataFrame([], "source_key string, source_file string"))
    assert rows(store.read(spark, root, store.latest(spark, root), "t", "x string")) == ["Row(x='c')"]


def test_current_rows_are_read_without_a_shuffle(spark, lake):
    for table in ("bronze", "silver_encounter", "gold_patient_condition_profile"):
        plan = read_current(spark, lake["root"], table)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan


def test_rejects_have_four_reasons(spark, lake):
    found = {os.path.basename(r.source_file): r.reason for r in read_rejects(spark, lake["root"], "r1").collect()}
    assert found == {
        "none.json": B.EMPTY_FILE, "cut.json": B.MALFORMED, "bare.json": B.NOT_A_BUNDLE, "odd.json.gz": B.UNREADABLE,
    }


def test_stages_are_counted_and_failures_logged(lake):
    log = {r.stage: (r.status, r.records) for r in lake["first"]}
    assert log["ingest"] == log["bronze"] == log["validate"] == ("SUCCESS", 22)
    assert log["current"] == log["silver"] == ("SUCCESS", 22)
    assert {(r.stage, r.status) for r in lake["failed"]} == {
        *[(s, "SUCCESS") for s in ("ingest", "bronze", "validate", "quality", "current", "silver", "gold")],
        ("commit", "FAILED"),
    }


def test_a_full_load_starts_over(spark, lake, tmp_path):
    root = str(tmp_path / "full")
    run_load(spark, lake["landing"], root, "f1", DAYS[0], mode="full", pattern="*.json*", buckets=2)
    once = rows(read_current(spark, root, "bronze").select("resource_id", "raw_json"))
    run_load(spark, lake["landing"], root, "f2", DAYS[1], mode="full", pattern="*.json*")
    assert rows(read_current(spark, root, "bronze").select("resource_id", "raw_json")) == once
    assert {r for parts in store.latest(spark, root).parts.values() for r in parts.values()} == {"f2"}
    with pytest.raises(ValueError):
        run_load(spark, lake["landing"], root, "f3", DAYS[1], mode="some")


def test_a_load_of_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(str(tmp_path / "in"), "cut.json", "{", 1000)
    root = str(tmp_path / "lake")
    log = {r.stage: r.records for r in run_load(spark, str(tmp_path / "in"), root, "r1", DAYS[0]).collect()}
    assert log["ingest"] == 0 and log["commit"] == 1
    assert read_current(spark, root, "bronze").count() == 0
    assert all(read_current(spark, root, f"gold_{n}").count() == 0 for n in GOLD)


def test_states_under_random_changes(spark):
    """Rows that come and go in any order, against the state of what is left."""
    import random

    pick, layout = random.Random(7), G.BILLS
    ddl = "patient_id string, claim_id string, claim_type string, total_amount double, created_date string"
    held, state = [], spark.createDataFrame([], layout.ddl)
    for _ in range(3):
        gone = [held.pop(pick.randrange(len(held))) for _ in range(min(len(held), 12))]
        come = [
            (f"p{pick.randrange(5)}", f"c{pick.random()}", pick.choice(["professional", "institutional"]),
             pick.choice([None, 1e25, float(pick.randrange(-9, 9))]), f"2024-01-{pick.randrange(1, 9):02d}")
            for _ in range(20)
        ]
        held += come
        source = spark.createDataFrame(held, ddl)
        change = states.delta(layout, spark.createDataFrame(come, ddl), spark.createDataFrame(gone, ddl))
        old = spark.createDataFrame(state.collect(), layout.ddl)
        state = states.updated(layout, old, change, source)
        assert rows(state.select(*layout.columns())) == rows(states.fresh(layout, source).select(*layout.columns()))


def test_a_stream_keeps_rejects_and_passes_over_repeats(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "lake")
    landing.mkdir()
    put(str(landing), "one.json", S.bundle("b-1", S.record("p-100")), 1_000_000)
    put(str(landing), "cut.json", "{", 1_000_000)
    stream = lambda: stream_deliveries(spark, str(landing), root, "s", DAYS[0], DAYS[0][:10])
    stream()
    kept = sources.read_bronze(spark, root, dedup=False).count()
    assert kept == 19
    put(str(landing), "copy.json", S.bundle("b-1", S.record("p-100")), 1_000_100)  # the same text again
    put(str(landing), "two.json", S.bundle("b-2", S.record("p-200")), 1_000_100)
    stream()  # a new query from the checkpoint
    stream()  # without new files
    assert sources.read_bronze(spark, root, dedup=False).count() == 2 * kept
    lines = streamed_documents(spark, root, "s").collect()
    assert sorted(os.path.basename(r.source_file) for r in lines) == ["cut.json", "one.json", "two.json"]
    assert [r.reason for r in lines if r.reason] == [B.MALFORMED]


def test_a_stream_takes_files_in_small_batches_and_keeps_digests_on_disk(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for k, name in enumerate(("p-100", "p-200", "p-100")):  # the third text came before, in an earlier batch
        put(str(landing), f"{k}.json", S.bundle(f"b-{name}", S.record(name)), 1_000_000 + 100 * k)
    found = {}
    for size in (1, 1 << 20):
        root = str(tmp_path / f"lake-{size}")
        stream_deliveries(spark, str(landing), root, "s", DAYS[0], DAYS[0][:10], batch_bytes=size)
        lines = streamed_documents(spark, root, "s").select("source_file", "run_id").collect()
        kept = rows(sources.read_bronze(spark, root, dedup=False).select("resource_id", "raw_json"))
        found[size] = sorted(os.path.basename(r.source_file) for r in lines), kept
        assert len({r.run_id for r in lines}) == (2 if size == 1 else 1)
        stored = [f for _, _, files in os.walk(f"{root}/_checkpoints/deliveries/state/0/0") for f in files]
        assert any(f.endswith((".zip", ".changelog")) for f in stored) and not any(f.endswith(".delta") for f in stored)
    assert len(found[1][0]) == len(found[1 << 20][0]) == 2 and found[1][0] == ["0.json", "1.json"]
    assert found[1][1] == found[1 << 20][1]
