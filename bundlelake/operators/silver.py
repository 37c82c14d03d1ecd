"""Flat tables, one per resource type, from the raw JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlelake.functions.dates import DATE, DATE_TIME, elapsed_seconds, offset_text, wall_clock
from bundlelake.functions.fhir import (
    code_of,
    display_of,
    first_item,
    first_match,
    first_of,
    identifier_value,
    number,
    or_empty,
    prefer,
    reference_id,
    slashed_reference_id,
)
from bundlelake.functions.rounding import hours_from_seconds
from bundlelake.schemas import ACTIVE_CLINICAL_STATUSES, LINEAGE, RESOURCE_JSON

Columns = dict[str, Column]

# Date texts of each type, parsed once into a column of the same name.
_DATES = {
    "Patient": {"born": "r.birthDate"},
    "Encounter": {"started": "r.period.start", "ended": "r.period.end"},
    "Condition": {
        "onset": "r.onsetDateTime",
        "abated": "r.abatementDateTime",
        "recorded": "r.recordedDate",
    },
    "Observation": {"taken": "r.effectiveDateTime"},
    "Claim": {
        "billed_from": "r.billablePeriod.start",
        "billed_to": "r.billablePeriod.end",
        "created": "r.created",
    },
}


def _day(column: str) -> Column:
    return F.date_format(column, DATE)


def _moment(column: str) -> Column:
    return F.date_format(column, DATE_TIME)


def _patient(r: Column) -> Columns:
    name = prefer(r["name"], lambda n: n["use"] == "official")
    address = prefer(r["address"], lambda a: a["use"] == "home")
    given, line = name["given"], address["line"]
    first, family = or_empty(first_item(given)), or_empty(name["family"])
    language = first_match(r["communication"], lambda c: c["preferred"])

    def contact(system: str) -> Column:
        return or_empty(first_match(r["telecom"], lambda t: t["system"] == system)["value"])

    return {
        "patient_id": or_empty(r["id"]),
        "mrn": identifier_value(r["identifier"], "mrn"),
        "first_name": first,
        "middle_name": or_empty(F.get(given, F.lit(1))),
        "family_name": family,
        "full_name": F.trim(F.concat_ws(" ", first, family)),
        "gender": or_empty(r["gender"]),
        "birth_date": _day("born"),
        "active": F.coalesce(r["active"], F.lit(True)),
        "address_line1": or_empty(first_item(line)),
        "address_line2": or_empty(F.get(line, F.lit(1))),
        "city": or_empty(address["city"]),
        "state": or_empty(address["state"]),
        "postal_code": or_empty(address["postalCode"]),
        "country": or_empty(address["country"]),
        "phone": contact("phone"),
        "email": contact("email"),
        "marital_status_code": code_of(r["maritalStatus"]),
        "preferred_language": code_of(language["language"]),
    }


def _encounter(r: Column) -> Columns:
    kind, reason = first_item(r["type"]), first_item(r["reasonCode"])
    stay = r["hospitalization"]
    return {
        "encounter_id": or_empty(r["id"]),
        "patient_id": reference_id(r["subject"]["reference"]),
        "status": or_empty(r["status"]),
        "encounter_class": or_empty(r["class"]["code"]),
        "type_code": code_of(kind),
        "type_display": first_of(kind["text"], display_of(kind)),
        "period_start": or_empty(_moment("started")),
        "period_end": or_empty(_moment("ended")),
        "length_of_stay_hours": hours_from_seconds(F.col("stay_seconds")),
        "reason_code": code_of(reason),
        "reason_display": first_of(reason["text"], display_of(reason)),
        "admit_source_code": code_of(stay["admitSource"]),
        "discharge_disposition_code": code_of(stay["dischargeDisposition"]),
        "service_provider": or_empty(r["serviceProvider"]["display"]),
    }


def _condition(r: Column) -> Columns:
    status = F.nullif(first_item(r["clinicalStatus"]["coding"])["code"], F.lit(""))
    return {
        "condition_id": or_empty(r["id"]),
        "patient_id": reference_id(r["subject"]["reference"]),
        "clinical_status": or_empty(status),
        "verification_status": code_of(r["verificationStatus"]),
        "category": code_of(first_item(r["category"])),
        "condition_code": code_of(r["code"]),
        "condition_display": or_empty(F.coalesce(r["code"]["text"], display_of(r["code"]))),
        "onset_date": or_empty(_day("onset")),
        "abatement_date": or_empty(_day("abated")),
        "recorded_date": or_empty(_day("recorded")),
        "is_active": status.isin(*ACTIVE_CLINICAL_STATUSES),
    }


def _observation(r: Column) -> Columns:
    quantity = r["valueQuantity"]
    return {
        "observation_id": or_empty(r["id"]),
        "patient_id": reference_id(r["subject"]["reference"]),
        "encounter_id": or_empty(slashed_reference_id(r["encounter"]["reference"])),
        "status": or_empty(r["status"]),
        "category": code_of(first_item(r["category"])),
        "loinc_code": code_of(r["code"]),
        "observation_name": or_empty(F.coalesce(r["code"]["text"], display_of(r["code"]))),
        "value": number(quantity["value"]),
        "unit": or_empty(quantity["unit"]),
        "unit_code": or_empty(quantity["code"]),
        "effective_date": or_empty(_day("taken")),
        "effective_datetime": or_empty(_moment("taken")),
        "interpretation": code_of(first_item(r["interpretation"])),
        "reference_range": or_empty(first_item(r["referenceRange"])["text"]),
    }


def _claim(r: Column) -> Columns:
    items = F.coalesce(r["item"], F.array())
    net = F.transform(items, lambda i: F.coalesce(number(i["net"]["value"]), F.lit(0.0)))
    return {
        "claim_id": or_empty(r["id"]),
        "patient_id": reference_id(r["patient"]["reference"]),
        "status": or_empty(r["status"]),
        "claim_type": code_of(r["type"]),
        "claim_type_display": first_of(display_of(r["type"]), r["type"]["text"]),
        "use": or_empty(r["use"]),
        "billable_period_start": or_empty(_day("billed_from")),
        "billable_period_end": or_empty(_day("billed_to")),
        "created_date": or_empty(_day("created")),
        "total_amount": number(r["total"]["value"]),
        "currency": F.coalesce(r["total"]["currency"], F.lit("USD")),
        "line_item_count": F.size(items).cast("long"),
        "line_item_total": F.aggregate(net, F.lit(0.0), lambda total, value: total + value),
        "primary_cpt_code": code_of(first_item(items)["productOrService"]),
    }


_LAYOUTS: dict[str, Callable[[Column], Columns]] = {
    "Patient": _patient,
    "Encounter": _encounter,
    "Condition": _condition,
    "Observation": _observation,
    "Claim": _claim,
}


def flatten(bronze: DataFrame, resource_type: str, also: tuple[str, ...] = ()) -> DataFrame:
    """The flat table of one resource type, with its lineage columns and further ones of bronze."""
    if resource_type not in _LAYOUTS:
        raise ValueError(f"no flat layout for resource type {resource_type!r}")
    parsed = (
        bronze.filter(F.col("resource_type") == resource_type)
        .select(F.from_json("raw_json", RESOURCE_JSON[resource_type]).alias("r"), *LINEAGE, *also)
        .withColumns(
            {name: wall_clock(F.col(path)) for name, path in _DATES[resource_type].items()}
        )
    )
    if resource_type == "Encounter":
        parsed = parsed.withColumns(
            {
                "start_offset": offset_text(F.col("r.period.start")),
                "end_offset": offset_text(F.col("r.period.end")),
            }
        ).withColumn(
            "stay_seconds",
            elapsed_seconds(
                F.col("start_offset"), F.col("end_offset"), F.col("started"), F.col("ended")
            ),
        )
    columns = _LAYOUTS[resource_type](F.col("r"))
    return parsed.select(*[value.alias(name) for name, value in columns.items()], *LINEAGE, *also)


def flatten_all(bronze: DataFrame) -> dict[str, DataFrame]:
    return {name.lower(): flatten(bronze, name) for name in _LAYOUTS}
