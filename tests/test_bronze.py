import json

from bundlelake.operators.bronze import copy_stats, latest_copies, latest_stored_copies, latest_versions, to_bronze
from bundlelake.schemas import BRONZE_COLUMNS
from bundlelake.sinks.tables import write_bronze
from bundlelake.sources.tables import read_bronze


def _versioned(version, **extra):
    return {"resourceType": "Patient", "id": "p-1", "meta": {"versionId": version}, **extra}


def test_projection_defaults_and_lineage(resources_of):
    bronze = to_bronze(resources_of({"resourceType": "Patient", "id": " p-9 "}), "run-7")
    assert tuple(bronze.columns) == BRONZE_COLUMNS
    row = bronze.first()
    assert (row.resource_id, row.version_id, row.last_updated) == ("p-9", "1", "")
    assert (row.ingestion_date, row.pipeline_run_id) == ("2024-01-15", "run-7")
    assert (row.source_file, row.bundle_id, row.full_url) == ("f.json", "b-1", "urn:0")


def test_private_keys_are_stripped_only_at_top_level(resources_of):
    plain = {"resourceType": "Claim", "id": "a", "total": {"value": 185.0, "_note": 1}}
    marked = {"resourceType": "Claim", "id": "b", "_birthDate": {"x": 1}, "total": {"value": 2.5}}
    rows = {r.resource_id: r.raw_json
            for r in to_bronze(resources_of(plain, marked), "r").collect()}
    assert rows["a"] == json.dumps(plain)
    assert json.loads(rows["b"]) == {"resourceType": "Claim", "id": "b", "total": {"value": 2.5}}


def test_newest_copy_wins_and_versions_survive(resources_of):
    found = resources_of(
        _versioned("1", gender="male"), _versioned("1", gender="female"),
        _versioned("2", gender="other"),
        stamps=["2024-01-01T00:00:00", "2024-01-02T00:00:00", "2024-01-01T00:00:00"],
    )
    bronze = to_bronze(found, "r")
    kept = latest_copies(bronze)
    genders = {json.loads(r.raw_json)["gender"] for r in kept.collect()}
    assert genders == {"female", "other"}
    assert latest_copies(kept).exceptAll(kept).count() == 0
    assert [json.loads(r.raw_json)["gender"] for r in latest_versions(bronze).collect()] == ["other"]
    stats = copy_stats(bronze).first()
    assert (stats.records_ingested, stats.records_written, stats.duplicates_removed) == (3, 2, 1)


def test_runs_append_and_repeats_replace(spark, resources_of, tmp_path):
    root = str(tmp_path)
    first = to_bronze(resources_of(_versioned("1")), "run-1")
    second = to_bronze(resources_of(_versioned("1"), _versioned("2")), "run-2")
    write_bronze(first, root, "2024-01-15")
    write_bronze(first, root, "2024-01-15")
    write_bronze(second, root, "2024-01-16")
    assert read_bronze(spark, root, dedup=False).count() == 3
    assert read_bronze(spark, root, "Patient").count() == 2
    assert read_bronze(spark, root, "Patient", "2024-01-15").count() == 1
    assert read_bronze(spark, root, "Claim").count() == 0


def test_missing_bronze_is_empty(spark, tmp_path):
    assert read_bronze(spark, str(tmp_path / "none")).columns == list(BRONZE_COLUMNS)


def test_stored_copies_are_found_by_narrow_rows(spark, resources_of, tmp_path):
    nameless = {"resourceType": "Patient", "gender": "male"}
    bronze = to_bronze(
        resources_of(
            _versioned("1", gender="male"), _versioned("1", gender="female"), _versioned("2"), nameless, nameless,
            stamps=["2024-01-01T00:00:00", "2024-01-02T00:00:00", *["2024-01-01T00:00:00"] * 3],
        ),
        "r",
    )
    stored = read_bronze(spark, write_bronze(bronze, str(tmp_path), "2024-01-15").rsplit("/", 1)[0], dedup=False)
    expected = sorted(latest_copies(stored).collect())
    assert len(expected) < stored.count() == 5
    for known in (1, 100):  # too many repeated identities to send, and few enough
        assert sorted(latest_stored_copies(stored, known).collect()) == expected
    sole = stored.filter("version_id = '2'")
    found = latest_stored_copies(sole)
    assert found.collect() == sole.collect()
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
