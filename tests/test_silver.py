import datetime
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from bundlelake.functions.dates import wall_clock
from bundlelake.functions.rounding import half_even, hours_from_seconds
from bundlelake.operators.bronze import to_bronze
from bundlelake.operators.silver import flatten
from tests import samples as S


@pytest.fixture
def flat(resources_of):
    def make(*resources):
        kind = resources[0]["resourceType"]
        rows = flatten(to_bronze(resources_of(*resources), "r"), kind).collect()
        key = f"{kind.lower()}_id"
        return {r[key]: r.asDict() for r in rows}

    return make


def test_patient(flat):
    full = S.patient("p1", "Ines", "Pilar", "Vega", "male", "1969-09-14")
    odd = {"resourceType": "Patient", "id": "p2", "birthDate": "not-a-date",
           "name": [{"family": "Solo"}], "identifier": [{"value": "X"}],
           "address": [{"use": "work", "city": "Metropolis"}]}
    rows = flat(full, odd)
    row = rows["p1"]
    assert row["full_name"] == "Ines Vega" and row["middle_name"] == "Pilar"
    assert row["mrn"] == "M-p1" and row["birth_date"] == "1969-09-14" and row["active"]
    assert (row["city"], row["postal_code"], row["address_line2"]) == ("Harborview", "97000", "")
    assert (row["phone"], row["email"]) == ("555-0100", "a@example.org")
    assert (row["marital_status_code"], row["preferred_language"]) == ("M", "en-US")
    assert (row["source_file"], row["pipeline_run_id"]) == ("f.json", "r")
    row = rows["p2"]
    assert row["full_name"] == "Solo" and row["mrn"] == "X" and row["city"] == "Metropolis"
    assert row["birth_date"] is None and row["active"] is True and row["phone"] == ""


def test_encounter(flat):
    start, end = "2022-11-08T20:00:00Z", "2022-11-12T17:00:00Z"
    stay = {"hospitalization": {"admitSource": S.concept("emd"),
                                "dischargeDisposition": S.concept("home")},
            "serviceProvider": {"display": "Clinic"}, "reasonCode": [S.concept("44", "Why")]}
    rows = flat(
        S.encounter("full", "p1", "IMP", start, end, **stay),
        S.encounter("zoned", "p1", "AMB", "2023-01-01T10:00:00+05:30", "2023-01-01T10:00:00Z"),
        S.encounter("mixed", "p1", "AMB", "2023-01-01T10:00:00", "2023-01-01T11:00:00Z"),
        S.encounter("half", "p1", "AMB", "2023-01-01", "soon", subject={"reference": "p9"}),
        {"resourceType": "Encounter", "id": "bare"},
    )
    row = rows["full"]
    assert row["length_of_stay_hours"] == 93.0 and row["patient_id"] == "p1"
    assert row["period_start"] == "2022-11-08T20:00:00" and row["encounter_class"] == "IMP"
    assert (row["type_display"], row["reason_code"], row["reason_display"]) == ("Check up", "44", "Why")
    assert (row["admit_source_code"], row["discharge_disposition_code"]) == ("emd", "home")
    assert row["service_provider"] == "Clinic"
    assert rows["zoned"]["length_of_stay_hours"] == 5.5
    assert rows["zoned"]["period_start"] == "2023-01-01T10:00:00"
    assert rows["mixed"]["length_of_stay_hours"] is None
    assert rows["half"]["period_start"] == "2023-01-01T00:00:00"
    assert (rows["half"]["period_end"], rows["half"]["patient_id"]) == ("", "p9")
    assert rows["bare"]["length_of_stay_hours"] is None and rows["bare"]["status"] == ""


def test_condition(flat):
    rows = flat(
        S.condition("a", "p1", "E11.9", "Diabetes", "active", "2013-04-10"),
        S.condition("b", "p1", "J06.9", None, "resolved", "2022-12-05T08:00:00Z", "2022-12-19"),
        {"resourceType": "Condition", "id": "c"},
    )
    assert rows["a"]["is_active"] is True and rows["a"]["condition_display"] == "Diabetes"
    assert rows["b"]["is_active"] is False and rows["b"]["condition_display"] == "Dx"
    assert (rows["b"]["onset_date"], rows["b"]["abatement_date"]) == ("2022-12-05", "2022-12-19")
    assert rows["c"]["is_active"] is None and rows["c"]["patient_id"] == ""


def test_observation(flat):
    rows = flat(
        S.observation("a", "p1"),
        S.observation("b", "p1", "high", encounter={"reference": "loose"}),
        S.observation("c", "p1", "12.5", effectiveDateTime="2024/01/15 10:30"),
    )
    row = rows["a"]
    assert (row["value"], row["unit"], row["loinc_code"]) == (4.1, "mmol/L", "2823-3")
    assert (row["observation_name"], row["category"]) == ("Serum K", "laboratory")
    assert (row["effective_date"], row["effective_datetime"]) == ("2022-03-01", "2022-03-01T07:20:00")
    assert (row["interpretation"], row["reference_range"]) == ("H", "Normal: 3.5 to 5.1")
    assert row["encounter_id"] == "e-1" and rows["b"]["encounter_id"] == ""
    assert rows["b"]["value"] is None and rows["c"]["value"] == 12.5
    assert rows["c"]["effective_datetime"] == "2024-01-15T10:30:00"


def test_claim(flat):
    items = [{"productOrService": S.concept("99221"), "net": {"value": 10.25}},
             {"net": {"currency": "USD"}}, {"net": {"value": 4}}, {}]
    rows = flat(
        S.claim("a", "p1", "institutional", 4250.0, "2023-07-25", "2023-07-18", "2023-07-22"),
        {"resourceType": "Claim", "id": "b", "item": items, "total": {"value": "7.5"}},
    )
    row = rows["a"]
    assert (row["total_amount"], row["currency"], row["line_item_count"]) == (4250.0, "USD", 1)
    assert (row["claim_type"], row["claim_type_display"]) == ("institutional", "Institutional")
    assert (row["billable_period_start"], row["created_date"]) == ("2023-07-18", "2023-07-25")
    row = rows["b"]
    assert (row["line_item_count"], row["line_item_total"]) == (4, 14.25)
    assert (row["primary_cpt_code"], row["total_amount"], row["currency"]) == ("99221", 7.5, "USD")


def test_unknown_type_is_refused(resources_of):
    with pytest.raises(ValueError):
        flatten(to_bronze(resources_of({"resourceType": "Device"}), "r"), "Device")


def test_lenient_dates(spark):
    texts = ["2023-03-10", "2023-03-10T09:00:00+05:30", "15/05/1980", "05/15/1980", "20230310",
             "Mar 5, 2023", "5 March 2023", "2023-02-30", "not-a-date", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in frame.select(wall_clock(F.col("t"))).collect()]
    at = datetime.datetime
    assert found == [at(2023, 3, 10), at(2023, 3, 10, 9), at(1980, 5, 15), at(1980, 5, 15),
                     at(2023, 3, 10), at(2023, 3, 5), at(2023, 3, 5), None, None, None, None]


def test_hours_round_like_exact_decimals_of_the_double(spark):
    rows = spark.range(-3000, 90000, 3).select(
        "id", hours_from_seconds(F.col("id").cast("double")).alias("h")
    ).collect()
    assert all(r.h == round(r.id / 3600, 2) for r in rows)


def test_half_even(spark):
    frame = spark.createDataFrame([(1.125,), (1.135,), (2.5,), (-1.125,)], "v double")
    found = [r[0] for r in frame.select(half_even(F.col("v"))).collect()]
    expected = [float(Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_EVEN))
                for v in (1.125, 1.135, 2.5, -1.125)]
    assert found == pytest.approx(expected)
