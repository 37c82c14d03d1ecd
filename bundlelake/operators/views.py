"""Reporting views over the flat tables and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bundlelake.functions.rounding import half_away
from bundlelake.operators.ranks import with_percent_rank
from bundlelake.schemas import CATEGORY_LABELS, CLASS_LABELS, CONDITION_GROUPS

Tables = dict[str, DataFrame]


def _label(code: Column, labels: dict[str, str]) -> Column:
    """The label of a code; unlisted codes stand for themselves."""
    result = code
    for key, text in labels.items():
        result = F.when(code == key, text).otherwise(result)
    return result


def _with_patient(rows: DataFrame, patients: DataFrame, *columns: str) -> DataFrame:
    """Left join to patients; Catalyst and AQE choose broadcast or a skew-aware merge.

    A row without a subject has no patient, so patients without an id stay out.
    """
    names = patients.filter("patient_id <> ''").select(
        "patient_id", F.col("full_name").alias("patient_name"), *columns
    )
    return rows.join(names, "patient_id", "left")


# --- detail views over the flat tables ---------------------------------------


def patient_demographics(silver: Tables, as_of: str) -> DataFrame:
    """Patients with display name, gender code and age in calendar years at ``as_of``."""
    born = F.substring("birth_date", 1, 4).try_cast("int")
    return silver["patient"].select(
        "patient_id",
        "full_name",
        F.concat("first_name", F.lit(" "), "family_name").alias("display_name"),
        "gender",
        "birth_date",
        (F.year(F.lit(as_of).cast("date")) - born).alias("age_years"),
        F.when(F.col("gender") == "male", "M")
        .when(F.col("gender") == "female", "F")
        .otherwise("U")
        .alias("gender_code"),
        "city",
        "state",
        "postal_code",
        "phone",
        "email",
        "preferred_language",
        "marital_status_code",
        "source_file",
        "pipeline_run_id",
    )


def encounter_detail(silver: Tables) -> DataFrame:
    hours = F.col("length_of_stay_hours")
    return _with_patient(silver["encounter"], silver["patient"], "gender").select(
        "encounter_id",
        "patient_id",
        "patient_name",
        "gender",
        "status",
        "encounter_class",
        _label(F.col("encounter_class"), CLASS_LABELS).alias("encounter_class_label"),
        "type_code",
        "type_display",
        "period_start",
        "period_end",
        "length_of_stay_hours",
        F.when(hours < 4, "short_stay")
        .when(hours < 48, "observation")
        .when(hours.isNotNull(), "inpatient")
        .alias("los_category"),
        "reason_code",
        "reason_display",
        "admit_source_code",
        "discharge_disposition_code",
        "service_provider",
        "pipeline_run_id",
    )


def condition_detail(silver: Tables) -> DataFrame:
    days = F.datediff(
        F.col("abatement_date").try_cast("date"), F.col("onset_date").try_cast("date")
    )
    return _with_patient(silver["condition"], silver["patient"]).select(
        "condition_id",
        "patient_id",
        "patient_name",
        "clinical_status",
        "verification_status",
        "condition_code",
        "condition_display",
        "onset_date",
        "abatement_date",
        "recorded_date",
        "is_active",
        days.alias("condition_duration_days"),
        "pipeline_run_id",
    )


def observation_detail(silver: Tables) -> DataFrame:
    return _with_patient(silver["observation"], silver["patient"]).select(
        "observation_id",
        "patient_id",
        "patient_name",
        "encounter_id",
        "status",
        "category",
        _label(F.col("category"), CATEGORY_LABELS).alias("category_label"),
        "loinc_code",
        "observation_name",
        "value",
        "unit",
        "effective_date",
        "effective_datetime",
        "interpretation",
        "reference_range",
        "pipeline_run_id",
    )


def claim_detail(silver: Tables) -> DataFrame:
    return _with_patient(silver["claim"], silver["patient"]).select(
        "claim_id",
        "patient_id",
        "patient_name",
        "status",
        "claim_type",
        "claim_type_display",
        "use",
        "billable_period_start",
        "billable_period_end",
        "created_date",
        "total_amount",
        "currency",
        "line_item_count",
        "line_item_total",
        "primary_cpt_code",
        "pipeline_run_id",
    )


# --- reports over the summaries -----------------------------------------------


def patient_360(gold: Tables) -> DataFrame:
    """One row per patient with encounters, plus conditions, bills and a risk tier."""
    conditions = gold["patient_condition_profile"].select(
        "patient_id",
        "total_conditions",
        "active_condition_count",
        "chronic_condition_count",
        "has_chronic_condition",
        "active_icd_codes",
        "active_condition_names",
    )
    bills = gold["claims_financial_summary"].select(
        "patient_id",
        "total_claims",
        "total_billed",
        "avg_claim_value",
        "professional_claims",
        "institutional_claims",
        "latest_claim_date",
    )
    chronic = F.col("chronic_condition_count")
    tier = (
        F.when((chronic >= 3) & (F.col("emer_encounters") >= 2), "HIGH")
        .when((chronic >= 2) | (F.col("imp_encounters") >= 2), "MEDIUM")
        .when(F.col("has_chronic_condition"), "LOW_CHRONIC")
        .otherwise("LOW")
    )
    visits = F.col("total_encounters")
    cost = F.when(visits > 0, half_away(F.col("total_billed") / visits))
    joined = (
        gold["patient_encounter_summary"]
        .join(conditions, "patient_id", "left")
        .join(bills, "patient_id", "left")
    )
    return joined.select(
        "patient_id",
        "full_name",
        "gender",
        "birth_date",
        "total_encounters",
        "amb_encounters",
        "imp_encounters",
        "emer_encounters",
        "avg_los_hours",
        "max_los_hours",
        "latest_encounter_date",
        "earliest_encounter_date",
        *[c for c in conditions.columns if c != "patient_id"],
        *[c for c in bills.columns if c != "patient_id"],
        tier.alias("risk_tier"),
        cost.alias("cost_per_encounter"),
    )


def high_cost_patients(gold: Tables) -> DataFrame:
    """Billed patients with their cost percentile and tier, dearest first."""
    bills = gold["claims_financial_summary"].select(
        "patient_id",
        "full_name",
        "gender",
        "total_claims",
        "total_billed",
        "avg_claim_value",
        "professional_claims",
        "institutional_claims",
    )
    conditions = gold["patient_condition_profile"].select(
        "patient_id", "active_condition_count", "chronic_condition_count", "active_icd_codes"
    )
    ranked = with_percent_rank(bills, "total_billed", "cost_percentile")
    share = F.col("cost_percentile")
    return (
        ranked.join(conditions, "patient_id", "left")
        .select(
            *bills.columns,
            "active_condition_count",
            "chronic_condition_count",
            "active_icd_codes",
            "cost_percentile",
            F.when(share >= 0.75, "Top 25%")
            .when(share >= 0.50, "Top 50%")
            .otherwise("Bottom 50%")
            .alias("cost_tier"),
        )
        .orderBy(F.desc("total_billed"), "patient_id")
    )


def _condition_group(code: Column) -> Column:
    group = F.lit("Other")
    for name, prefixes in CONDITION_GROUPS.items():
        group = F.when(code.rlike("^(" + "|".join(prefixes) + ")"), name).otherwise(group)
    return group


def chronic_disease_burden(gold: Tables) -> DataFrame:
    """Codes, patients and prevalence per condition group, most frequent first."""
    profile = gold["patient_condition_profile"]
    population = profile.agg(F.count("patient_id")).scalar()  # one row per patient
    codes = profile.filter(F.col("active_icd_codes") != "").select(
        "patient_id", F.explode(F.split("active_icd_codes", "[|]")).alias("code")
    )
    per_code = codes.groupBy(F.trim("code").alias("icd_code")).agg(
        F.count_distinct("patient_id").alias("patient_count")
    )
    occurrences = F.sum("patient_count")
    share = F.try_divide(F.lit(100.0) * F.col("total_patient_occurrences"), population)
    return (
        per_code.groupBy(_condition_group(F.col("icd_code")).alias("condition_group"))
        .agg(
            F.count("*").alias("distinct_icd_codes"),
            occurrences.alias("total_patient_occurrences"),
        )
        .withColumn("prevalence_pct", half_away(share, 1))
        .orderBy(F.desc("total_patient_occurrences"), "condition_group")
    )


def encounter_utilization_summary(gold: Tables) -> DataFrame:
    """Monthly volumes with running totals per class and shares of the month.

    Works on the trend table, which has one row per month, class and status.
    """
    running = (
        Window.partitionBy("encounter_class")
        .orderBy("year_month", "status")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    month_total = F.sum("encounter_count").over(Window.partitionBy("year_month"))
    return (
        gold["monthly_utilization_trends"]
        .select(
            "year_month",
            "encounter_class",
            _label(F.col("encounter_class"), CLASS_LABELS).alias("encounter_class_label"),
            "status",
            "encounter_count",
            "avg_los_hours",
            "total_los_hours",
            F.sum("encounter_count").over(running).alias("running_total_by_class"),
            half_away(
                F.try_divide(F.lit(100.0) * F.col("encounter_count"), month_total), 1
            ).alias("pct_of_monthly_volume"),
        )
        .orderBy("year_month", "encounter_class", "status")
    )


def all_views(silver: Tables, gold: Tables, as_of: str) -> Tables:
    return {
        "vw_patient_demographics": patient_demographics(silver, as_of),
        "vw_encounter_detail": encounter_detail(silver),
        "vw_condition_detail": condition_detail(silver),
        "vw_observation_detail": observation_detail(silver),
        "vw_claim_detail": claim_detail(silver),
        "vw_patient_360": patient_360(gold),
        "vw_high_cost_patients": high_cost_patients(gold),
        "vw_chronic_disease_burden": chronic_disease_burden(gold),
        "vw_encounter_utilization_summary": encounter_utilization_summary(gold),
    }


# --- checks and exploration ----------------------------------------------------

# Check names and the table each one counts.
SANITY_COUNTS = {
    "silver_patients_count": ("silver", "patient"),
    "silver_encounters_count": ("silver", "encounter"),
    "silver_conditions_count": ("silver", "condition"),
    "silver_observations_count": ("silver", "observation"),
    "silver_claims_count": ("silver", "claim"),
    "gold_encounter_summary_count": ("gold", "patient_encounter_summary"),
    "gold_condition_profile_count": ("gold", "patient_condition_profile"),
    "gold_financial_summary_count": ("gold", "claims_financial_summary"),
    "gold_utilization_trends_count": ("gold", "monthly_utilization_trends"),
}


def sanity_checks(silver: Tables, gold: Tables) -> DataFrame:
    """Row counts (-1 for an absent table) and the patient id comparison."""
    zones = {"silver": silver, "gold": gold}
    spark = next(iter({**silver, **gold}.values())).sparkSession
    rows = None

    def add(check: str, counted: DataFrame) -> None:
        nonlocal rows
        line = counted.select(F.lit(check).alias("check_name"), F.col("n").alias("value"))
        rows = line if rows is None else rows.unionByName(line)

    for check, (zone, table) in SANITY_COUNTS.items():
        if table in zones[zone]:
            add(check, zones[zone][table].agg(F.count("*").alias("n")))
        else:
            add(check, spark.range(1).select(F.lit(-1).cast("long").alias("n")))
    left = silver["patient"].agg(F.count_distinct("patient_id").alias("n"))
    right = gold["patient_encounter_summary"].agg(F.count_distinct("patient_id").alias("n"))
    add("silver_unique_patients", left)
    add("gold_unique_patients", right)
    same = (F.col("n") == right.scalar()).cast("long")
    add("patient_id_consistent", left.select(same.alias("n")))
    return rows


def active_conditions(silver: Tables) -> DataFrame:
    return silver["condition"].filter("is_active").select(
        "patient_id", "condition_code", "condition_display", "onset_date", "clinical_status"
    )


def first_vitals(silver: Tables, rows: int = 10) -> DataFrame:
    """The first vital-sign observations by id."""
    return (
        silver["observation"]
        .filter(F.col("category") == "vital-signs")
        .orderBy("observation_id")
        .limit(rows)
        .select(
            "observation_id", "patient_id", "observation_name", "value", "unit",
            "effective_date",
        )
    )


def patient_360_report(gold: Tables) -> DataFrame:
    return (
        patient_360(gold)
        .select(
            "patient_id",
            "full_name",
            "gender",
            "total_encounters",
            "chronic_condition_count",
            "total_billed",
            "risk_tier",
            "cost_per_encounter",
        )
        .orderBy(F.desc_nulls_last("total_billed"), "patient_id")
    )
