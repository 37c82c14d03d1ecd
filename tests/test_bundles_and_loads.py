import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bundlelake import session
from bundlelake.operators import incremental as I
from bundlelake.operators.bronze import latest_copies, to_bronze
from bundlelake.schemas import FILE_LEDGER, WATERMARK_LEDGER
from bundlelake.sinks.tables import append_ledger, write_bronze
from bundlelake.sources import bundles as B
from bundlelake.sources import tables as sources
from bundlelake.streaming.ingest import stream_bundles
from tests import samples as S

AT = "2024-01-15T10:00:00+00:00"


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for i in (1, 2, 3):
        doc = S.bundle(f"bundle-{i}", S.record(f"p-{i}00"))
        if i == 1:
            doc["entry"][2:2] = [{"fullUrl": "urn:x"}, {"resource": {}},
                                 {"resource": {"resourceType": "Device", "id": "d"}}]
        (folder / f"b{i}.json").write_text(json.dumps(doc, indent=2))
    (folder / "broken.json").write_text('{"resourceType": "Bundle", "entry": [')
    (folder / "blank.json").write_text("\n")
    (folder / "empty.json").write_text("")  # zero bytes: Spark does not list it
    (folder / "patient.json").write_text(json.dumps(S.record("p-100")[0]))
    (folder / "notes.txt").write_text("not for us")
    return str(folder)


def test_scan_and_rejects(spark, landing):
    parsed = B.parse_bundles(B.read_documents(spark, landing))
    found = B.explode_resources(parsed, AT)
    counts = {r.resource_type: r.resource_count for r in B.resource_summary(found).collect()}
    assert counts == {"Patient": 3, "Encounter": 9, "Condition": 15, "Observation": 24,
                      "Claim": 6, "total": 57}
    first = found.filter("bundle_id = 'bundle-1' AND entry_index = 0").first()
    assert first.full_url == "urn:uuid:p-100" and first.source_file.endswith("b1.json")
    rejects = {os.path.basename(r.source_file): r.reason for r in B.rejected(parsed).collect()}
    assert rejects == {"broken.json": B.MALFORMED, "blank.json": B.MALFORMED,
                       "patient.json": B.NOT_A_BUNDLE}


def test_report_and_limit(spark, landing):
    docs = B.read_documents(spark, landing)
    report = {r.bundle_id: r for r in B.ingestion_report(B.parse_bundles(docs)).collect()}
    row = report["bundle-1"]
    assert (row.total_entries, row.skipped_entries, row.observation_count) == (22, 3, 8)
    assert row.errors == ["Entry 2 has no 'resource' field", "Entry 3 has no 'resource' field"]
    limited = B.parse_bundles(docs, 4)
    cut = {r.bundle_id: r for r in B.ingestion_report(limited).collect()}
    assert {k: (r.total_entries, r.skipped_entries) for k, r in cut.items()} == {
        "bundle-1": (22, 20), "bundle-2": (19, 15), "bundle-3": (19, 15)}
    assert cut["bundle-2"].errors == ["15 entries past the limit were not read"]
    assert B.explode_resources(limited, AT).count() == 2 + 4 + 4


def test_a_bundle_is_parsed_once(spark, landing):
    parsed = B.parse_bundles(B.read_documents(spark, landing))
    for found in (B.explode_resources(parsed, AT), B.rejected(parsed), B.ingestion_report(parsed)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") + plan.count("JsonToStructs") == 1


def test_lines_equal_documents(spark, landing, tmp_path):
    docs = B.read_documents(spark, landing).filter("trim(value) NOT IN ('', '\n')")
    one_line = [" ".join(r.value.split()) for r in docs.collect()]
    (tmp_path / "all.json").write_text("\n".join(one_line) + "\n\n")
    lines = B.parse_bundles(B.read_documents(spark, str(tmp_path), one_per_line=True))
    columns = ["resource_type", "bundle_id", "full_url", "entry_index"]
    left = B.explode_resources(lines, AT).select(columns)
    right = B.explode_resources(B.parse_bundles(docs), AT).select(columns)
    assert left.exceptAll(right).count() == 0 and left.count() == right.count() == 57


def test_stream_equals_batch_and_restarts_add_nothing(spark, landing, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        stream_bundles(spark, landing, root, "s", AT, "2024-01-15")
    streamed = sources.read_bronze(spark, root)
    assert sources.read_bronze(spark, root, dedup=False).count() == 57
    found = B.explode_resources(B.parse_bundles(B.read_documents(spark, landing)), AT)
    rows = I.difference(latest_copies(to_bronze(found, "b")), streamed).collect()
    assert sum(r.left_rows for r in rows) == 57 and {r.unmatched_rows for r in rows} == {0}


def test_batches_before_and_after_a_stream_stay(spark, resources_of, landing, tmp_path):
    root = str(tmp_path)
    early, late = ({"resourceType": "Patient", "id": i} for i in ("early", "late"))
    write_bronze(to_bronze(resources_of(early), "a"), root, "2024-01-15")
    stream_bundles(spark, landing, root, "s", AT, "2024-01-15")
    write_bronze(to_bronze(resources_of(late), "b"), root, "2024-01-15")
    found = {r.resource_id for r in sources.read_bronze(spark, root, "Patient").collect()}
    assert found == {"early", "late", "p-100", "p-200", "p-300"}
    assert sources.read_bronze(spark, root, run_id="s").count() == 57


def test_only_a_missing_table_is_empty(spark, tmp_path):
    with pytest.raises(AnalysisException):
        sources.read_table(spark, str(tmp_path), "a int, a int")  # not a table: names repeat
    assert sources.read_table(spark, str(tmp_path / "none"), FILE_LEDGER).count() == 0


def test_pending_files_and_ledger(spark, landing, tmp_path):
    files = sources.list_files(spark, landing)
    assert files.count() == 6
    ledger = str(tmp_path / "ledger")
    assert sources.read_table(spark, ledger, FILE_LEDGER).count() == 0
    done = files.filter(F.col("path").endswith("b1.json")).select(
        "path", F.lit("2024-01-15").cast("timestamp_ntz").alias("processed_at"),
        F.lit("r").alias("pipeline_run_id"), F.lit(19).cast("long").alias("record_count"))
    append_ledger(done, ledger)
    append_ledger(done.withColumn("processed_at", F.lit("2024-01-16").cast("timestamp_ntz")), ledger)
    known = sources.read_table(spark, ledger, FILE_LEDGER)
    assert I.unprocessed(files, known).count() == 5
    latest = I.processed_files(known).collect()
    assert len(latest) == 1 and latest[0].processed_at.day == 16


def test_watermarks(spark, landing, tmp_path):
    path = str(tmp_path / "marks")
    files = sources.list_files(spark, landing).select(
        "path", F.lit("bundles").alias("source_key"),
        F.col("modified_at").cast("timestamp_ntz").alias("modified_at"))
    marks = lambda: I.current_watermarks(sources.read_table(spark, path, WATERMARK_LEDGER))
    pending = lambda: I.pending_files(files, marks())
    assert pending().count() == 6
    append_ledger(I.advanced_watermarks(files, files, "r1", "2099-01-01"), path)
    row = marks().first()
    assert (row.last_run_id, row.files_processed, row.full_load_needed) == ("r1", 6, False)
    assert pending().count() == 0
    append_ledger(I.advanced_watermarks(files.limit(0), files, "r2", "2099-01-02"), path)
    assert marks().first().last_processed.year == 2099
    append_ledger(I.reset_entry(files, "2099-01-03"), path)
    assert marks().first().full_load_needed and pending().count() == 6
    assert B.read_documents(spark, landing, newer_than="2099-01-01").count() == 0


def test_scratch_follows_the_session(spark, monkeypatch):
    before = spark.conf.get("spark.checkpoint.dir", None)
    one, two = session.scratch(spark, "x"), session.scratch(spark, "x")
    assert one != two
    if before:
        assert one.startswith(before.rstrip("/"))
