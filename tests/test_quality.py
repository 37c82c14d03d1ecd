import pytest

from bundlelake.operators import quality as Q
from tests import samples as S


@pytest.fixture(scope="module")
def batch(resources_of):
    good = [S.patient(f"p{i}", "A", "B", "C", "male", "1980-01-01") for i in range(3)]
    bad = S.patient("p0", "A", "B", "C", "", "1980-01-01")  # repeated id, empty gender
    visit = S.encounter("e", "p0", "AMB", "2023-01-02", "2023-01-01", period={})
    return resources_of(*good, bad, visit)


def test_outcomes(batch):
    rows = {(r.resource_type, r.rule_name): r for r in Q.rule_outcomes(batch).collect()}
    assert len(rows) == 4 + 6
    # An empty gender fails both completeness and conformity.
    assert rows["Patient", "patient_demographic_fields"].failed == 1
    assert rows["Patient", "patient_gender_codes"].failed == 1
    unique = rows["Patient", "resource_id_uniqueness"]
    assert (unique.passed, unique.failed, unique.total, unique.pass_rate) == (3, 1, 4, 0.75)
    # An empty object counts as present.
    assert rows["Encounter", "encounter_timing_fields"].failed == 0


def test_scores_and_gate(batch):
    outcomes = Q.rule_outcomes(batch)
    rows = {r.resource_type: r for r in Q.scores(outcomes).collect()}
    patient = rows["Patient"]
    assert (patient.completeness, patient.conformity) == (87.5, 75.0)
    assert (patient.consistency, patient.uniqueness) == (100.0, 75.0)
    expected = 0.35 * 87.5 + 0.25 * 75 + 0.2 * 100 + 0.2 * 75
    assert patient.quality_score == pytest.approx(expected, abs=0.005)
    assert rows["Encounter"].quality_score == 100.0
    strict = Q.scores(outcomes, 90)
    held = Q.gate(batch, strict, "quarantine").filter("NOT released").select("resource_type")
    assert {r[0] for r in held.collect()} == {"Patient"}
    assert Q.gate(batch, strict).filter("NOT released").count() == 0
    with pytest.raises(ValueError):
        Q.gate(batch, strict, "drop")


def test_details(batch):
    lines = {(r.rule_name, r.detail) for r in Q.rule_details(batch).collect()}
    assert ("patient_gender_codes", "id=p0: invalid gender=''") in lines
    assert ("patient_demographic_fields", "id=p0: field 'gender' missing or empty") in lines
    assert ("resource_id_uniqueness", "id=p0 appears 2 times") in lines


def test_details_stop_at_ten(resources_of):
    many = [S.observation(f"o{i:02d}", "p", status="DONE") for i in range(15)]
    rows = Q.rule_details(resources_of(*many)).collect()
    assert len(rows) == 10 and max(r.line for r in rows) == 10


def test_details_take_one_pass_and_keep_repeated_lines(spark, resources_of, tmp_path):
    same = S.observation("o1", "p", status="DONE")
    other = S.observation("o2", "p", status="DONE")
    resources_of(same, other, same).write.parquet(str(tmp_path / "found"))
    details = Q.rule_details(spark.read.parquet(str(tmp_path / "found")))
    found = {(r.rule_name, r.line, r.detail) for r in details.collect()}
    lines = [d for rule, _, d in sorted(found) if rule == "obs_status_codes"]
    assert lines == ["id=o1: invalid status='DONE'"] * 2 + ["id=o2: invalid status='DONE'"]
    assert ("resource_id_uniqueness", 1, "id=o1 appears 2 times") in found
    assert details._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
