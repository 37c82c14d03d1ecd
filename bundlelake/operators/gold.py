"""Per-patient summaries and monthly trends.

Dates are compared as date or timestamp values, not text: fixed-width buffers
keep every aggregation on the hash path, with partial results merged per map
task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bundlelake.functions.dates import DATE, DATE_TIME
from bundlelake.functions.fhir import number, starts_with_any
from bundlelake.functions.rounding import half_even, summand, total
from bundlelake.operators.states import Layout, fresh
from bundlelake.schemas import ACTIVE_CLINICAL_STATUSES, CHRONIC_PREFIXES, GOLD


def is_chronic(code: Column) -> Column:
    return starts_with_any(code, CHRONIC_PREFIXES)


def _demographics(patients: DataFrame, *columns: str) -> DataFrame:
    """One row per patient id: the most recently ingested one. None for the empty id."""
    newest = Window.partitionBy("patient_id").orderBy(
        F.desc("ingestion_timestamp"),
        F.asc_nulls_last("full_name"),
        F.asc_nulls_last("gender"),
        F.asc_nulls_last("birth_date"),
    )
    return (
        patients.filter("patient_id <> ''")
        .select("patient_id", "full_name", "gender", "birth_date", "ingestion_timestamp")
        .withColumn("copy", F.row_number().over(newest))
        .filter("copy = 1")
        .select("patient_id", *columns)
    )


def _described(totals: DataFrame, patients: DataFrame | None, *columns: str) -> DataFrame:
    """Totals per patient, with demographics after them unless there is no patient table."""
    if patients is None:
        return totals
    return totals.join(_demographics(patients, *columns), "patient_id", "left").select(
        *totals.columns, *columns
    )


def _text(value: Column, layout: str) -> Column:
    return F.date_format(value, layout)


def _one_if(test: Column) -> Column:
    return F.when(test, 1).otherwise(0).cast("long")


def _none_as_0(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("decimal(28,6)"))


def _mean(exact: str, rest: str, count: str) -> Column:
    """Mean of the values that there are; null if none."""
    return F.try_divide(total(F.col(exact), F.col(rest)), F.nullif(F.col(count), F.lit(0)))


def _visits(encounters: DataFrame) -> DataFrame:
    los = number(F.col("length_of_stay_hours"))
    exact, rest = summand(los)
    started = F.col("period_start").try_cast("timestamp_ntz")
    return encounters.select(
        "patient_id",
        F.lit(1).cast("long").alias("visits"),
        _one_if(F.col("encounter_id").isNotNull()).alias("total_encounters"),
        *[
            _one_if(F.col("encounter_class") == code).alias(f"{code.lower()}_encounters")
            for code in ("AMB", "IMP", "EMER")
        ],
        _none_as_0(exact).alias("los_sum"),
        _one_if(los.isNotNull()).alias("los_count"),
        rest.alias("los_rest"),
        los.alias("los_min"),
        started.alias("earliest"),
        los.alias("los_max"),
        started.alias("latest"),
    )


VISITS = Layout(
    "encounter",
    ("patient_id",),
    ("visits", "total_encounters", "amb_encounters", "imp_encounters", "emer_encounters", "los_sum", "los_count"),
    ("los_rest",),
    ("los_min", "earliest"),
    ("los_max", "latest"),
    "patient_id string, visits bigint, total_encounters bigint, amb_encounters bigint, imp_encounters bigint, "
    "emer_encounters bigint, los_sum decimal(38,6), los_count bigint, los_rest double, los_min double, "
    "earliest timestamp_ntz, los_max double, latest timestamp_ntz",
    _visits,
)


def encounter_summary_of(state: DataFrame) -> DataFrame:
    return state.select(
        "patient_id",
        "total_encounters",
        "amb_encounters",
        "imp_encounters",
        "emer_encounters",
        half_even(_mean("los_sum", "los_rest", "los_count")).alias("avg_los_hours"),
        half_even(F.col("los_max")).alias("max_los_hours"),
        half_even(F.col("los_min")).alias("min_los_hours"),
        _text(F.col("latest"), DATE_TIME).alias("latest_encounter_date"),
        _text(F.col("earliest"), DATE_TIME).alias("earliest_encounter_date"),
    )


def _diagnoses(conditions: DataFrame) -> DataFrame:
    onset = F.col("onset_date").try_cast("date")
    return conditions.select(
        "patient_id",
        "condition_code",
        "condition_display",
        F.col("clinical_status").isin(*ACTIVE_CLINICAL_STATUSES).alias("active"),
        F.lit(1).cast("long").alias("n"),
        onset.alias("first_onset"),
        onset.alias("last_onset"),
    )


# Repeats of the same diagnosis collapse first, on a key that spreads a patient with very many
# rows; only distinct diagnoses reach the lists.
DIAGNOSES = Layout(
    "condition",
    ("patient_id", "condition_code", "condition_display", "active"),
    ("n",),
    (),
    ("first_onset",),
    ("last_onset",),
    "patient_id string, condition_code string, condition_display string, active boolean, n bigint, "
    "first_onset date, last_onset date",
    _diagnoses,
)


def condition_profile_of(state: DataFrame) -> DataFrame:
    diagnoses = state.withColumn("chronic", F.col("active") & is_chronic(F.col("condition_code")))

    def joined(column: str) -> Column:
        distinct = F.collect_set(F.when(F.col("active"), F.col(column)))
        return F.array_join(F.sort_array(distinct), "|")

    profile = diagnoses.groupBy("patient_id").agg(
        F.sum("n").alias("total_conditions"),
        F.sum(F.when(F.col("active"), F.col("n")).otherwise(0)).alias("active_condition_count"),
        F.sum(F.when(F.col("chronic"), F.col("n")).otherwise(0)).alias("chronic_condition_count"),
        joined("condition_code").alias("active_icd_codes"),
        joined("condition_display").alias("active_condition_names"),
        F.min("first_onset").alias("first_onset"),
        F.max("last_onset").alias("last_onset"),
    )
    return profile.select(
        "patient_id",
        "total_conditions",
        "active_condition_count",
        "chronic_condition_count",
        (F.col("chronic_condition_count") > 0).alias("has_chronic_condition"),
        "active_icd_codes",
        "active_condition_names",
        _text(F.col("first_onset"), DATE).alias("earliest_condition_onset"),
        _text(F.col("last_onset"), DATE).alias("most_recent_condition_onset"),
    )


def _bills(claims: DataFrame) -> DataFrame:
    amount = number(F.col("total_amount"))
    exact, rest = summand(amount)
    created = F.col("created_date").try_cast("date")
    return claims.select(
        "patient_id",
        F.lit(1).cast("long").alias("bills"),
        _one_if(F.col("claim_id").isNotNull()).alias("total_claims"),
        *[
            _one_if(F.col("claim_type") == kind).alias(f"{kind}_claims")
            for kind in ("professional", "institutional")
        ],
        _none_as_0(exact).alias("billed"),
        _one_if(amount.isNotNull()).alias("billed_count"),
        rest.alias("billed_rest"),
        amount.alias("lowest"),
        created.alias("earliest"),
        amount.alias("highest"),
        created.alias("latest"),
    )


BILLS = Layout(
    "claim",
    ("patient_id",),
    ("bills", "total_claims", "professional_claims", "institutional_claims", "billed", "billed_count"),
    ("billed_rest",),
    ("lowest", "earliest"),
    ("highest", "latest"),
    "patient_id string, bills bigint, total_claims bigint, professional_claims bigint, "
    "institutional_claims bigint, billed decimal(38,6), billed_count bigint, billed_rest double, lowest double, "
    "earliest date, highest double, latest date",
    _bills,
)


def claims_summary_of(state: DataFrame) -> DataFrame:
    return state.select(
        "patient_id",
        "total_claims",
        half_even(total(F.col("billed"), F.col("billed_rest"))).alias("total_billed"),
        half_even(_mean("billed", "billed_rest", "billed_count")).alias("avg_claim_value"),
        half_even(F.col("highest")).alias("max_claim_value"),
        half_even(F.col("lowest")).alias("min_claim_value"),
        "professional_claims",
        "institutional_claims",
        _text(F.col("latest"), DATE).alias("latest_claim_date"),
        _text(F.col("earliest"), DATE).alias("earliest_claim_date"),
    )


def _months(encounters: DataFrame) -> DataFrame:
    los = number(F.col("length_of_stay_hours"))
    exact, rest = summand(los)
    return encounters.select(
        F.substring("period_start", 1, 7).alias("year_month"),
        "encounter_class",
        "status",
        F.lit(1).cast("long").alias("visits"),
        # Undated encounters form groups that count nothing and are dropped after grouping;
        # filtering them first would push the whole date parsing, and the JSON parsing below
        # it, into the filter a second time.
        _one_if((F.col("period_start") != "") & F.col("encounter_id").isNotNull()).alias("encounter_count"),
        _none_as_0(exact).alias("los_sum"),
        _one_if(los.isNotNull()).alias("los_count"),
        rest.alias("los_rest"),
    )


MONTHS = Layout(
    "encounter",
    ("year_month", "encounter_class", "status"),
    ("visits", "encounter_count", "los_sum", "los_count"),
    ("los_rest",),
    (),
    (),
    "year_month string, encounter_class string, status string, visits bigint, encounter_count bigint, "
    "los_sum decimal(38,6), los_count bigint, los_rest double",
    _months,
)


def monthly_trends_of(state: DataFrame) -> DataFrame:
    return state.filter("encounter_count > 0").select(
        "year_month",
        "encounter_class",
        "status",
        "encounter_count",
        half_even(_mean("los_sum", "los_rest", "los_count")).alias("avg_los_hours"),
        half_even(total(F.col("los_sum"), F.col("los_rest"))).alias("total_los_hours"),
    )


#: State, summary and demographic columns of each table.
TABLES = {
    "patient_encounter_summary": (VISITS, encounter_summary_of, ("full_name", "gender", "birth_date")),
    "patient_condition_profile": (DIAGNOSES, condition_profile_of, ("full_name", "gender", "birth_date")),
    "claims_financial_summary": (BILLS, claims_summary_of, ("full_name", "gender")),
    "monthly_utilization_trends": (MONTHS, monthly_trends_of, ()),
}


def finished(name: str, state: DataFrame, patients: DataFrame | None, created_at: str) -> DataFrame:
    """A table from its state, with demographics unless there is no patient table."""
    _, summary_of, columns = TABLES[name]
    summary = summary_of(state)
    if columns:
        summary = _described(summary, patients, *columns)
    return summary.withColumn("gold_created_at", F.lit(created_at))


def patient_encounter_summary(
    patients: DataFrame | None, encounters: DataFrame, created_at: str
) -> DataFrame:
    return finished("patient_encounter_summary", fresh(VISITS, encounters), patients, created_at)


def patient_condition_profile(
    patients: DataFrame | None, conditions: DataFrame, created_at: str
) -> DataFrame:
    return finished("patient_condition_profile", fresh(DIAGNOSES, conditions), patients, created_at)


def claims_financial_summary(
    patients: DataFrame | None, claims: DataFrame, created_at: str
) -> DataFrame:
    return finished("claims_financial_summary", fresh(BILLS, claims), patients, created_at)


def monthly_utilization_trends(encounters: DataFrame, created_at: str) -> DataFrame:
    return finished("monthly_utilization_trends", fresh(MONTHS, encounters), None, created_at)


def build(name: str, silver: dict[str, DataFrame], created_at: str) -> DataFrame:
    """One summary by its table name; without demographics if ``silver["patient"]`` is None."""
    makers = {
        "patient_encounter_summary": lambda: patient_encounter_summary(
            silver["patient"], silver["encounter"], created_at
        ),
        "patient_condition_profile": lambda: patient_condition_profile(
            silver["patient"], silver["condition"], created_at
        ),
        "claims_financial_summary": lambda: claims_financial_summary(
            silver["patient"], silver["claim"], created_at
        ),
        "monthly_utilization_trends": lambda: monthly_utilization_trends(
            silver["encounter"], created_at
        ),
    }
    return makers[name]()


def build_all(silver: dict[str, DataFrame], created_at: str) -> dict[str, DataFrame]:
    """The four summaries, all carrying the same creation stamp."""
    return {name: build(name, silver, created_at) for name in GOLD}
