import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bundlelake.operators import gold as G
from bundlelake.operators import quality as Q
from bundlelake.operators import validation as V
from bundlelake.operators import views as W
from bundlelake.operators.ranks import with_percent_rank
from bundlelake.plans.lakehouse import lazy_silver, run_full_load
from bundlelake.sources import tables as sources
from bundlelake.schemas import GOLD, SILVER
from tests import samples as S

RUN_AT = "2024-01-15T10:00:00+00:00"


@pytest.fixture(scope="module")
def everyone(resources_of):
    return resources_of(*S.everyone()).cache()


@pytest.fixture(scope="module")
def lake(spark, everyone, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    log = {r.stage: r.records for r in run_full_load(spark, everyone, root, "r1", RUN_AT).collect()}
    silver = {n: sources.read_silver(spark, root, n) for n in SILVER}
    gold = {n: sources.read_gold(spark, root, n) for n in GOLD}
    return root, log, silver, gold


def rows_by(frame, key="patient_id"):
    return {r[key]: r for r in frame.collect()}


def test_stage_log(lake):
    _, log, _, _ = lake
    assert log == {"ingest": 57, "validate": 57, "bronze": 57, "silver": 57, "gold": 18,
                   "warehouse": 132}


def test_samples_are_clean(everyone):
    assert V.issue_rows(V.validate(everyone)).filter("severity = 'ERROR'").count() == 0
    assert V.reference_issues(everyone).count() == 0
    assert {r.quality_score for r in Q.scores(Q.rule_outcomes(everyone)).collect()} == {100.0}


def test_encounter_summary(lake):
    rows = rows_by(lake[3]["patient_encounter_summary"])
    expected = {
        "p-100": (26.25, 72.0, 0.75, "2022-01-04T08:00:00", "2022-03-20T22:30:00"),
        "p-200": (23.5, 60.0, 2.0, "2022-04-06T13:00:00", "2022-06-15T01:00:00"),
        "p-300": (34.5, 98.0, 0.5, "2022-07-09T17:15:00", "2022-09-02T12:00:00"),
    }
    for pid, values in expected.items():
        r = rows[pid]
        assert (r.avg_los_hours, r.max_los_hours, r.min_los_hours, r.earliest_encounter_date,
                r.latest_encounter_date) == values
        assert (r.total_encounters, r.amb_encounters, r.imp_encounters, r.emer_encounters) == (3, 1, 1, 1)
    assert rows["p-100"].full_name == "Noor Haddad"


def test_condition_profile(lake):
    rows = rows_by(lake[3]["patient_condition_profile"])
    expected = {
        "p-100": (4, 3, "E10.9|G43.1|J45.20|N18.4", "2009-08-21", "2022-02-11"),
        "p-200": (4, 4, "I11.0|I25.10|J44.9|M05.79", "2008-04-04", "2022-05-01"),
        "p-300": (4, 3, "E13.65|F33.0|I11.9|L40.0", "2018-07-23", "2022-08-19"),
    }
    for pid, values in expected.items():
        r = rows[pid]
        assert (r.active_condition_count, r.chronic_condition_count, r.active_icd_codes,
                r.earliest_condition_onset, r.most_recent_condition_onset) == values
        assert r.total_conditions == 5 and r.has_chronic_condition


def test_patient_360_and_costs(lake):
    rows = rows_by(W.patient_360(lake[3]))
    expected = {"p-100": (9220.5, 4610.25, 3073.5), "p-200": (3060.0, 1530.0, 1020.0),
                "p-300": (5495.5, 2747.75, 1831.83)}
    for pid, values in expected.items():
        r = rows[pid]
        assert (r.total_billed, r.avg_claim_value, r.cost_per_encounter) == values
        assert r.risk_tier == "MEDIUM" and (r.professional_claims, r.institutional_claims) == (1, 1)
    tiers = [(r.patient_id, r.cost_percentile, r.cost_tier)
             for r in W.high_cost_patients(lake[3]).collect()]
    assert tiers == [("p-100", 1.0, "Top 25%"), ("p-300", 0.5, "Top 50%"), ("p-200", 0.0, "Bottom 50%")]


def test_disease_burden(lake):
    rows = rows_by(W.chronic_disease_burden(lake[3]), "condition_group")
    found = {g: (r.total_patient_occurrences, r.prevalence_pct) for g, r in rows.items()}
    assert found == {
        "Diabetes": (2, 66.7), "Hypertension": (2, 66.7), "Chronic Kidney Disease": (1, 33.3),
        "Rheumatoid Arthritis": (1, 33.3), "Depression": (1, 33.3), "Other": (5, 166.7)}


def test_utilization(lake):
    rows = W.encounter_utilization_summary(lake[3]).collect()
    assert len(rows) == 9 and {r.pct_of_monthly_volume for r in rows} == {100.0}
    for kind, months in {"AMB": ("01", "04", "08"), "IMP": ("02", "05", "09"),
                         "EMER": ("03", "06", "07")}.items():
        found = [(r.year_month, r.running_total_by_class) for r in rows if r.encounter_class == kind]
        assert found == [(f"2022-{m}", i + 1) for i, m in enumerate(months)]


def test_detail_views(lake):
    silver = lake[2]
    stays = W.encounter_detail(silver).collect()
    assert {(r.encounter_class, r.los_category) for r in stays} == {
        ("AMB", "short_stay"), ("EMER", "observation"), ("IMP", "inpatient")}
    days = W.condition_detail(silver).filter("condition_duration_days IS NOT NULL").collect()
    assert sorted(r.condition_duration_days for r in days) == [7, 14, 30]
    person = rows_by(W.patient_demographics(silver, "2024-06-30"))["p-100"]
    assert (person.age_years, person.gender_code, person.display_name) == (34, "F", "Noor Haddad")
    assert W.observation_detail(silver).first().category_label == "Laboratory"
    assert W.claim_detail(silver).count() == 6


def test_sanity_checks_and_sql(spark, lake):
    root, _, silver, gold = lake
    checks = dict(W.sanity_checks(silver, {"patient_encounter_summary": gold["patient_encounter_summary"]}).collect())
    assert checks["silver_observations_count"] == 24 and checks["patient_id_consistent"] == 1
    assert checks["gold_condition_profile_count"] == -1
    sources.register({**sources.zone_tables(spark, root), **W.all_views(silver, gold, "2024-06-30")})
    sql = "SELECT count(*) FROM vw_patient_360 v JOIN silver_patient p ON v.patient_id = p.patient_id"
    assert spark.sql(sql).first()[0] == 3


def test_undated_and_empty_inputs(resources_of):
    visit = S.encounter("e", "p", "AMB", "", "", period={})
    silver = lazy_silver(resources_of(visit), "r")
    assert G.monthly_utilization_trends(silver["encounter"], RUN_AT).count() == 0
    row = G.patient_encounter_summary(silver["patient"], silver["encounter"], RUN_AT).first()
    assert (row.total_encounters, row.avg_los_hours, row.earliest_encounter_date) == (1, None, None)
    assert row.full_name is None
    assert G.claims_financial_summary(silver["patient"], silver["claim"], RUN_AT).count() == 0


def test_no_id_no_patient(resources_of):
    nobody = [{"resourceType": "Patient", "name": [{"family": n}]} for n in ("Stone", "Rivers")]
    visit = S.encounter("e", "p", "AMB", "2023-01-01", "2023-01-01", subject=None)
    silver = lazy_silver(resources_of(*nobody, nobody[0], visit), "r")
    # the frame gives each resource a place of its own, so all three stay
    assert sorted(r.full_name for r in silver["patient"].collect()) == ["Rivers", "Stone", "Stone"]
    row = W.encounter_detail(silver).collect()
    assert [(r.patient_id, r.patient_name) for r in row] == [("", None)]
    total = G.patient_encounter_summary(silver["patient"], silver["encounter"], RUN_AT).first()
    assert (total.patient_id, total.full_name) == ("", None)


def test_run_keeps_its_validation(spark, lake):
    summary = spark.read.parquet(f"{lake[0]}/log/validation_summary")
    rows = {r.resource_type: (r.checked, r.valid, r.errors) for r in summary.collect()}
    assert rows["all"] == (57, 57, 0) and rows["Observation"] == (24, 24, 0)
    assert spark.read.parquet(f"{lake[0]}/log/validation_results").count() == 57


def test_quarantine_keeps_bad_types_out(spark, resources_of, tmp_path):
    twins = [S.patient("p", "A", "B", "C", "male", "1980-01-01")] * 4
    visit = S.encounter("e", "p", "AMB", "2023-01-01", "2023-01-01")
    log = run_full_load(spark, resources_of(*twins, visit), str(tmp_path), "r", RUN_AT, 90.0, "quarantine")
    counts = {r.stage: r.records for r in log.collect()}
    assert (counts["ingest"], counts["bronze"]) == (5, 1)


@pytest.mark.parametrize("buckets", [2, 7, 200])
def test_percent_rank_equals_plain_window(spark, buckets):
    rng = random.Random(buckets)
    # One value holds a third of all rows; some values are missing.
    values = [None if rng.random() < 0.02 else 5.0 if rng.random() < 1 / 3
              else round(rng.uniform(-50, 50), 1) for _ in range(600)]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, v2 double")
    plain = frame.select("id", F.percent_rank().over(
        Window.orderBy(F.asc_nulls_last("v2"))).alias("p"))
    found = with_percent_rank(frame, "v2", "p", buckets).select("id", "p")
    assert sorted(found.collect()) == sorted(plain.collect())


def test_percent_rank_of_one_row(spark):
    frame = spark.createDataFrame([(1, 2.0)], "id int, v2 double")
    assert with_percent_rank(frame, "v2", "p").first().p == 0.0


def test_sums_survive_bad_numbers(spark):
    from bundlelake.functions.rounding import exact_sum

    values = spark.createDataFrame([(1.5,), (1e25,), (float("nan"),), (None,), (2.0,)], "v double")
    assert values.agg(exact_sum(values["v"])).first()[0] == 1e25 + 3.5
    small = values.filter("v < 1e20")
    assert small.agg(exact_sum(small["v"])).first()[0] == 3.5
    none = values.filter("v IS NULL OR isnan(v)")
    assert none.agg(exact_sum(none["v"])).first()[0] is None


def test_extremes_and_sums_agree_on_odd_amounts(spark):
    """One large amount counts everywhere; what is no finite number counts nowhere."""
    rows = [("p", f"c{k}", v) for k, v in enumerate((10.0, 1e25, float("nan"), float("inf"), None))]
    claims = spark.createDataFrame(rows, "patient_id string, claim_id string, total_amount double")
    claims = claims.selectExpr("*", "'x' AS claim_type", "'2024-01-02' AS created_date")
    row = G.claims_financial_summary(None, claims, "now").first()
    assert (row.total_claims, row.total_billed, row.max_claim_value, row.min_claim_value) == (5, 1e25, 1e25, 10.0)
