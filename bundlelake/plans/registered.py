"""Every operator as a query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake import session
from bundlelake.operators import gold as G
from bundlelake.operators import incremental as I
from bundlelake.operators import quality as Q
from bundlelake.operators import validation as V
from bundlelake.operators import views as W
from bundlelake.operators.bronze import copy_stats, latest_copies, to_bronze
from bundlelake.operators.silver import flatten_all
from bundlelake.plans.incremental import read_current, read_rejects, run_load
from bundlelake.plans.lakehouse import (
    lazy_silver,
    quality_log_rows,
    run_full_load,
    write_zones,
)
from bundlelake.schemas import FILE_LEDGER, GOLD, QUALITY_LOG, RESOURCE_TYPES, RUN_LOG, WATERMARK_LEDGER
from bundlelake.sinks import tables as sinks
from bundlelake.sources import bundles as B
from bundlelake.sources import retail
from bundlelake.sources import tables as sources
from bundlelake.streaming.ingest import stream_bundles, stream_deliveries, streamed_documents

RUN_ID = "run-1"
RUN_AT = "2024-02-01T00:00:00+00:00"
DAY = RUN_AT[:10]
AS_OF = "2024-06-30"
LATER = "2024-02-02T00:00:00+00:00"
HALF_TIME = "2024-01-16"
QUARANTINE_BELOW = 98.0
ENTRY_LIMIT = 2

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(session.configure(spark), sf_dir)

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    _QUERIES[function.__name__] = run
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _bronze(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    return to_bronze(retail.resources(spark, sf_dir, types or RESOURCE_TYPES), RUN_ID)


def _silver(spark: SparkSession, sf_dir: str, *types: str) -> dict[str, DataFrame]:
    """Flat tables of the given types only; other types are not even scanned."""
    kinds = types or RESOURCE_TYPES
    tables: dict[str, DataFrame] = {}
    for kind in kinds:
        tables.update(lazy_silver(retail.resources(spark, sf_dir, (kind,)), RUN_ID, (kind,)))
    return tables


_GOLD_INPUTS = {
    "patient_encounter_summary": ("Patient", "Encounter"),
    "patient_condition_profile": ("Patient", "Condition"),
    "claims_financial_summary": ("Patient", "Claim"),
    "monthly_utilization_trends": ("Encounter",),
}


def _patient_360_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three per-patient summaries; patients are flattened and joined for the first only."""
    silver = _silver(spark, sf_dir, "Patient", "Encounter", "Condition", "Claim")
    unnamed = {**silver, "patient": None}
    return {
        "patient_encounter_summary": G.build("patient_encounter_summary", silver, RUN_AT),
        "patient_condition_profile": G.build("patient_condition_profile", unnamed, RUN_AT),
        "claims_financial_summary": G.build("claims_financial_summary", unnamed, RUN_AT),
    }


def _gold(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named summaries, reading only the types they need."""
    needed = {t for name in names for t in _GOLD_INPUTS[name]}
    silver = _silver(spark, sf_dir, *[t for t in RESOURCE_TYPES if t in needed])
    return {name: G.build(name, silver, RUN_AT) for name in names}


def _stored_gold(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Summaries written once and read back, for reports that read them repeatedly."""
    root = session.scratch(spark, "gold")
    for name, table in _gold(spark, sf_dir, *names).items():
        sinks.write_gold(table, root, name)
    return {name: sources.read_gold(spark, root, name) for name in names}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = retail.land(spark, sf_dir, session.scratch(spark, "landing"))
    return B.read_documents(spark, path, pattern=retail.LANDED, one_per_line=True)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# --- sources -------------------------------------------------------------------


@_query
def bundle_scan(spark, sf_dir):
    found = B.explode_resources(B.parse_bundles(_documents(spark, sf_dir)), RUN_AT)
    return found.select(
        "resource_type",
        "bundle_id",
        "entry_index",
        "full_url",
        F.coalesce(F.get_json_object("resource", "$.id"), F.lit("")).alias("resource_id"),
        "ingestion_timestamp",
    )


@_query
def bundle_rejects(spark, sf_dir):
    bad = B.rejected(B.parse_bundles(_documents(spark, sf_dir)))
    return bad.groupBy("reason").agg(F.count("*").alias("documents"))


@_query
def unprocessed_files(spark, sf_dir):
    path = retail.land_in_batches(spark, sf_dir, session.scratch(spark, "landing"))
    batch = F.regexp_extract("path", r"batch=(\d+)/", 1).cast("int")
    files = sources.list_files(spark, path, retail.LANDED).withColumn("batch", batch)
    done = files.filter(F.col("batch") < 8)
    ledger = session.scratch(spark, "ledger")
    sinks.append_ledger(
        done.select(
            "path",
            F.lit(RUN_AT).cast("timestamp_ntz").alias("processed_at"),
            F.lit(RUN_ID).alias("pipeline_run_id"),
            F.lit(0).cast("long").alias("record_count"),
        ),
        ledger,
    )
    known = sources.read_table(spark, ledger, FILE_LEDGER)
    return I.unprocessed(files, known).select("batch").distinct()


@_query
def entry_limit(spark, sf_dir):
    parsed = B.parse_bundles(_documents(spark, sf_dir), ENTRY_LIMIT)
    return B.accepted(parsed).filter("truncated").select(
        "bundle_id", F.size("entry").cast("long").alias("entries_kept")
    )


@_query
def ingestion_report(spark, sf_dir):
    report = B.ingestion_report(B.parse_bundles(_documents(spark, sf_dir)))
    return report.select(
        "bundle_id",
        "total_entries",
        "skipped_entries",
        *[f"{t.lower()}_count" for t in RESOURCE_TYPES],
        F.array_join("errors", "; ").alias("errors"),
    )


@_query
def resource_summary(spark, sf_dir):
    return B.resource_summary(retail.resources(spark, sf_dir))


@_query
def bronze_read(spark, sf_dir):
    root = session.scratch(spark, "lake")
    sinks.write_bronze(_bronze(spark, sf_dir), root, DAY)
    rows = sources.read_bronze(spark, root, "Observation", DAY)
    return rows.select("resource_id", "version_id", "ingestion_timestamp", "bundle_id")


def _zones(spark, sf_dir) -> str:
    root = session.scratch(spark, "lake")
    write_zones(spark, retail.resources(spark, sf_dir), root, RUN_ID, RUN_AT)
    return root


@_query
def zone_row_counts(spark, sf_dir):
    return sources.row_counts(sources.zone_tables(spark, _zones(spark, sf_dir)))


@_query
def adhoc_sql(spark, sf_dir):
    silver = _silver(spark, sf_dir, "Patient", "Encounter")
    sources.register({f"silver_{name}": table for name, table in silver.items()})
    return spark.sql(
        """
        SELECT p.state, e.encounter_class, count(*) AS encounters,
               count(DISTINCT e.patient_id) AS patients
        FROM silver_encounter e JOIN silver_patient p ON e.patient_id = p.patient_id
        WHERE p.state <> '' AND e.patient_id <> ''
        GROUP BY p.state, e.encounter_class
        """
    )


# --- sinks ---------------------------------------------------------------------


@_query
def bronze_roundtrip(spark, sf_dir):
    root = session.scratch(spark, "lake")
    sinks.write_bronze(latest_copies(_bronze(spark, sf_dir)), root, DAY)
    return sources.read_bronze(spark, root, dedup=False).select(
        "resource_type", "resource_id", "version_id", "last_updated", "source_file",
        "bundle_id", "full_url", "ingestion_timestamp", "ingestion_date", "pipeline_run_id",
    )


@_query
def bronze_stats(spark, sf_dir):
    return copy_stats(_bronze(spark, sf_dir))


@_query
def silver_roundtrip(spark, sf_dir):
    root = session.scratch(spark, "lake")
    for name, table in _silver(spark, sf_dir).items():
        sinks.write_silver(table, root, name)
    return sources.read_silver(spark, root, "encounter")


@_query
def gold_roundtrip(spark, sf_dir):
    root = session.scratch(spark, "lake")
    for name, table in _gold(spark, sf_dir, *GOLD).items():
        sinks.write_gold(table, root, name)
    return sources.read_gold(spark, root, "claims_financial_summary").drop("gold_created_at")


@_query
def file_ledger(spark, sf_dir):
    path = session.scratch(spark, "ledger")
    sinks.append_ledger(
        _events(spark, sf_dir).select(
            F.concat(F.lit("landing/"), F.col("user_id"), F.lit(".json")).alias("path"),
            F.col("ts").alias("processed_at"),
            F.concat(F.lit("run-"), F.col("event_id")).alias("pipeline_run_id"),
            F.col("event_id").alias("record_count"),
        ),
        path,
    )
    return I.processed_files(sources.read_table(spark, path, FILE_LEDGER))


@_query
def stage_counts(spark, sf_dir):
    root = session.scratch(spark, "lake")
    log = run_full_load(spark, retail.resources(spark, sf_dir), root, RUN_ID, RUN_AT)
    return log.select("run_id", "stage", "status", "records")


@_query
def quality_score_log(spark, sf_dir):
    path = session.scratch(spark, "log")
    scored = Q.scores(Q.rule_outcomes(retail.resources(spark, sf_dir)))
    sinks.append_run_rows(quality_log_rows(scored, RUN_ID, RUN_AT), path)
    return sources.read_table(spark, path, QUALITY_LOG)


# --- validation ----------------------------------------------------------------


def _validated(spark, sf_dir) -> DataFrame:
    return V.validate(retail.resources(spark, sf_dir))


@_query
def validation_issues(spark, sf_dir):
    return V.issue_rows(_validated(spark, sf_dir))


@_query
def validation_results(spark, sf_dir):
    return V.results(_validated(spark, sf_dir)).drop("issues")


@_query
def reference_issues(spark, sf_dir):
    return V.reference_issues(retail.resources(spark, sf_dir))


@_query
def validation_summary(spark, sf_dir):
    return V.summary(_validated(spark, sf_dir))


@_query
def schema_constraint_issues(spark, sf_dir):
    return V.constraint_issues(retail.resources(spark, sf_dir))


@_query
def code_labels(spark, sf_dir):
    silver = _silver(spark, sf_dir, "Observation", "Condition")

    def counted(table: str, column: str, system: str) -> DataFrame:
        counts = silver[table].groupBy(F.col(column).alias("code")).agg(
            F.count("*").alias("records")
        )
        return V.label_codes(counts, system, "code").withColumn("code_system", F.lit(system))

    return counted("observation", "loinc_code", "LOINC").unionByName(
        counted("condition", "condition_code", "ICD-10")
    )


# --- quality -------------------------------------------------------------------


def _outcomes(spark, sf_dir, *dimensions: str) -> DataFrame:
    found = Q.rule_outcomes(retail.resources(spark, sf_dir), *dimensions)
    return found.drop("exact_rate")


@_query
def dq_completeness(spark, sf_dir):
    return _outcomes(spark, sf_dir, "completeness")


@_query
def dq_conformity(spark, sf_dir):
    return _outcomes(spark, sf_dir, "conformity")


@_query
def dq_consistency(spark, sf_dir):
    return _outcomes(spark, sf_dir, "consistency")


@_query
def dq_uniqueness(spark, sf_dir):
    return _outcomes(spark, sf_dir, "uniqueness")


@_query
def dq_rules(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@_query
def dq_rule_details(spark, sf_dir):
    return Q.rule_details(retail.resources(spark, sf_dir))


@_query
def dq_dimension_scores(spark, sf_dir):
    return Q.long_dimension_scores(Q.rule_outcomes(retail.resources(spark, sf_dir)))


@_query
def dq_scores(spark, sf_dir):
    return Q.scores(Q.rule_outcomes(retail.resources(spark, sf_dir)))


@_query
def dq_gate(spark, sf_dir):
    found = retail.resources(spark, sf_dir)
    scored = Q.scores(Q.rule_outcomes(found), QUARANTINE_BELOW)
    return Q.gate(found, scored, "quarantine").groupBy("resource_type", "released").agg(
        F.count("*").alias("resources")
    )


# --- bronze and silver ----------------------------------------------------------


@_query
def bronze_projection(spark, sf_dir):
    keys = F.json_object_keys("raw_json")
    return (
        _bronze(spark, sf_dir)
        .withColumn(
            "private_keys",
            F.size(F.filter(keys, lambda k: k.startswith("_"))).cast("long"),
        )
        .drop("raw_json")
    )


@_query
def bronze_dedup(spark, sf_dir):
    return latest_copies(_bronze(spark, sf_dir)).select(
        "resource_type", "resource_id", "version_id", "ingestion_timestamp", "bundle_id"
    )


@_query
def silver_patient(spark, sf_dir):
    return _silver(spark, sf_dir, "Patient")["patient"]


@_query
def silver_encounter(spark, sf_dir):
    return _silver(spark, sf_dir, "Encounter")["encounter"]


@_query
def silver_condition(spark, sf_dir):
    return _silver(spark, sf_dir, "Condition")["condition"]


@_query
def silver_observation(spark, sf_dir):
    return _silver(spark, sf_dir, "Observation")["observation"]


@_query
def silver_claim(spark, sf_dir):
    return _silver(spark, sf_dir, "Claim")["claim"]


# --- gold ----------------------------------------------------------------------


@_query
def patient_encounter_summary(spark, sf_dir):
    return _gold(spark, sf_dir, "patient_encounter_summary")["patient_encounter_summary"].drop("gold_created_at")


@_query
def patient_condition_profile(spark, sf_dir):
    return _gold(spark, sf_dir, "patient_condition_profile")["patient_condition_profile"].drop("gold_created_at")


@_query
def chronic_flag(spark, sf_dir):
    conditions = _silver(spark, sf_dir, "Condition")["condition"]
    return (
        conditions.groupBy("condition_code")
        .agg(F.count("*").alias("conditions"))
        .withColumn("is_chronic", G.is_chronic(F.col("condition_code")))
    )


@_query
def claims_financial_summary(spark, sf_dir):
    return _gold(spark, sf_dir, "claims_financial_summary")["claims_financial_summary"].drop("gold_created_at")


@_query
def monthly_utilization_trends(spark, sf_dir):
    return _gold(spark, sf_dir, "monthly_utilization_trends")["monthly_utilization_trends"].drop("gold_created_at")


# --- views ---------------------------------------------------------------------


@_query
def vw_patient_demographics(spark, sf_dir):
    return W.patient_demographics(_silver(spark, sf_dir, "Patient"), AS_OF)


@_query
def vw_encounter_detail(spark, sf_dir):
    return W.encounter_detail(_silver(spark, sf_dir, "Patient", "Encounter"))


@_query
def vw_condition_detail(spark, sf_dir):
    return W.condition_detail(_silver(spark, sf_dir, "Patient", "Condition"))


@_query
def vw_observation_detail(spark, sf_dir):
    return W.observation_detail(_silver(spark, sf_dir, "Patient", "Observation"))


@_query
def vw_claim_detail(spark, sf_dir):
    return W.claim_detail(_silver(spark, sf_dir, "Patient", "Claim"))


@_query
def vw_patient_360(spark, sf_dir):
    return W.patient_360(_patient_360_inputs(spark, sf_dir))


@_query
def vw_high_cost_patients(spark, sf_dir):
    return W.high_cost_patients(
        _stored_gold(
            spark, sf_dir, "claims_financial_summary", "patient_condition_profile"
        )
    )


@_query
def vw_chronic_disease_burden(spark, sf_dir):
    return W.chronic_disease_burden(
        _stored_gold(spark, sf_dir, "patient_condition_profile")
    )


@_query
def vw_encounter_utilization_summary(spark, sf_dir):
    return W.encounter_utilization_summary(
        _gold(spark, sf_dir, "monthly_utilization_trends")
    )


@_query
def sanity_checks(spark, sf_dir):
    root = _zones(spark, sf_dir)
    silver = {t.lower(): sources.read_silver(spark, root, t.lower()) for t in RESOURCE_TYPES}
    gold = {name: sources.read_gold(spark, root, name) for name in GOLD}
    return W.sanity_checks(silver, gold)


@_query
def active_conditions(spark, sf_dir):
    return W.active_conditions(_silver(spark, sf_dir, "Condition"))


@_query
def vitals_top10(spark, sf_dir):
    return W.first_vitals(_silver(spark, sf_dir, "Observation"))


@_query
def patient_360_report(spark, sf_dir):
    return W.patient_360_report(_patient_360_inputs(spark, sf_dir))


# --- incremental and streaming ----------------------------------------------------


def _event_files(spark, sf_dir) -> DataFrame:
    """Events as delivered files of the source named by their type."""
    return _events(spark, sf_dir).select(
        F.concat(F.lit("landing/"), F.col("event_id"), F.lit(".json")).alias("path"),
        F.col("event_type").alias("source_key"),
        F.col("ts").alias("modified_at"),
    )


def _first_load(files: DataFrame) -> DataFrame:
    """Watermark entries after loading January's first half of all sources but one."""
    done = files.filter(
        (F.col("modified_at") < F.lit(HALF_TIME).cast("timestamp_ntz"))
        & (F.col("source_key") != "error")
    )
    return I.advanced_watermarks(done, done, RUN_ID, DAY)


@_query
def watermark_current(spark, sf_dir):
    path = session.scratch(spark, "marks")
    sinks.append_ledger(
        _events(spark, sf_dir).select(
            F.concat_ws("-", "event_type", "user_id").alias("source_key"),
            F.col("ts").alias("last_processed"),
            F.col("ts").alias("updated_at"),
            F.concat(F.lit("run-"), F.col("event_id")).alias("last_run_id"),
            F.col("event_id").alias("files_processed"),
            (F.col("event_id") % 5 == 0).alias("is_reset"),
        ),
        path,
    )
    return I.current_watermarks(sources.read_table(spark, path, WATERMARK_LEDGER))


@_query
def pending_files(spark, sf_dir):
    files = _event_files(spark, sf_dir)
    marks = I.current_watermarks(_first_load(files))
    return I.pending_files(files, marks)


@_query
def watermark_advance(spark, sf_dir):
    files = _event_files(spark, sf_dir)
    late = files.filter(F.col("modified_at") >= F.lit(HALF_TIME).cast("timestamp_ntz"))
    late = late.filter(F.col("source_key") != "signup")
    return I.advanced_watermarks(late, files, "run-2", DAY)


def _load(spark, landing: str, root: str, run_id: str, run_at: str, **options) -> DataFrame:
    return run_load(spark, landing, root, run_id, run_at, pattern=retail.LANDED, one_per_line=True, buckets=8, **options)


def _two_loads(spark, sf_dir, checks: bool = False) -> tuple[str, str]:
    """Landing folder and lake after two deliveries; visits of the first are drafts in part."""
    landing, root = session.scratch(spark, "landing"), session.scratch(spark, "lake")
    retail.land_delivery(spark, sf_dir, landing, 1)
    _load(spark, landing, root, "run-1", RUN_AT, checks=checks)
    retail.land_delivery(spark, sf_dir, landing, 2)
    return landing, root


@_query
def incremental_equals_full(spark, sf_dir):
    """Two loads, the second broken off once and a third without new files, against all at once."""
    landing, root = _two_loads(spark, sf_dir)
    try:
        _load(spark, landing, root, "run-2", LATER, checks=False, stop_before="silver")
    except RuntimeError:
        pass
    _load(spark, landing, root, "run-2", LATER, checks=False)
    _load(spark, landing, root, "run-3", LATER, checks=False)
    docs = B.read_documents(spark, landing, retail.LANDED, one_per_line=True)
    found = B.explode_resources(B.parse_bundles(docs), RUN_AT)
    stamp = F.when(F.contains("source_file", F.lit("delivery=2")), LATER).otherwise(RUN_AT)
    full = latest_copies(to_bronze(found.withColumn("ingestion_timestamp", stamp), "run-4"))
    return I.difference(full, read_current(spark, root, "bronze"))


@_query
def bronze_current(spark, sf_dir):
    landing, root = _two_loads(spark, sf_dir)
    _load(spark, landing, root, "run-2", LATER, checks=False)
    return read_current(spark, root, "bronze").select(
        "resource_type", "resource_id", "version_id", "bundle_id", "full_url"
    )


@_query
def gold_after_two_loads(spark, sf_dir):
    """Visits and claims per patient, after later versions took the place of drafts."""
    landing, root = _two_loads(spark, sf_dir)
    _load(spark, landing, root, "run-2", LATER, checks=False)
    visits = read_current(spark, root, "gold_patient_encounter_summary").drop("gold_created_at")
    bills = read_current(spark, root, "gold_claims_financial_summary")
    return visits.join(bills.drop("full_name", "gender", "gold_created_at"), "patient_id", "full_outer")


@_query
def gold_rebuild_difference(spark, sf_dir):
    """Rows of each summary after two loads that a rebuild from current bronze lacks, or the other way."""
    landing, root = _two_loads(spark, sf_dir)
    _load(spark, landing, root, "run-2", LATER, checks=False)
    rebuilt = G.build_all(flatten_all(read_current(spark, root, "bronze")), RUN_AT)
    found = None
    for name, table in rebuilt.items():
        kept = read_current(spark, root, f"gold_{name}").drop("gold_created_at")
        signed = table.drop("gold_created_at").withColumn("sign", F.lit(1)).unionByName(kept.withColumn("sign", F.lit(-1)))
        balance = signed.groupBy(*kept.columns).agg(F.sum("sign").alias("balance"))
        line = balance.agg(F.coalesce(F.sum(F.abs("balance")), F.lit(0).cast("long")).alias("unmatched_rows"))
        line = line.select(F.lit(name).alias("table_name"), "unmatched_rows")
        found = line if found is None else found.unionByName(line)
    return found


@_query
def load_rejects(spark, sf_dir):
    """What a load could not read, by reason; an empty file lies among the others."""
    landing, root = session.scratch(spark, "landing"), session.scratch(spark, "lake")
    retail.land(spark, sf_dir, f"{landing}/visits")
    spark.createDataFrame([], "value string").write.text(f"{landing}/nothing")
    _load(spark, landing, root, RUN_ID, RUN_AT, checks=False)
    return read_rejects(spark, root, RUN_ID).groupBy("reason").agg(F.count("*").alias("documents"))


@_query
def load_log(spark, sf_dir):
    """Rows per stage of two loads, counted by the writes themselves."""
    landing, root = _two_loads(spark, sf_dir, checks=True)
    _load(spark, landing, root, "run-2", LATER)
    log = sources.read_table(spark, f"{root}/log/pipeline_run_log", RUN_LOG)
    ingested = log.filter("stage IN ('ingest', 'bronze', 'validate')")
    return ingested.groupBy("stage", "status").agg(F.sum("records").alias("records"), F.count("*").alias("runs"))


@_query
def stream_equals_batch(spark, sf_dir):
    landing = retail.land(spark, sf_dir, session.scratch(spark, "landing"))
    root = session.scratch(spark, "lake")
    stream_bundles(spark, landing, root, RUN_ID, RUN_AT, DAY, retail.LANDED, one_per_line=True)
    docs = B.read_documents(spark, landing, retail.LANDED, one_per_line=True)
    batch = to_bronze(B.explode_resources(B.parse_bundles(docs), RUN_AT), "run-2")
    return I.difference(latest_copies(batch), sources.read_bronze(spark, root))


@_query
def stream_after_batch(spark, sf_dir):
    """A batch, a stream and another batch on one table, against all rows loaded at once."""
    landing = retail.land(spark, sf_dir, session.scratch(spark, "landing"))
    root = session.scratch(spark, "lake")
    docs = B.read_documents(spark, landing, retail.LANDED, one_per_line=True)
    found = B.explode_resources(B.parse_bundles(docs), RUN_AT)
    some = F.col("resource_type").isin("Patient", "Claim")
    sinks.write_bronze(to_bronze(found.filter(some), "run-1"), root, DAY)
    stream_bundles(spark, landing, root, "run-2", RUN_AT, DAY, retail.LANDED, one_per_line=True)
    sinks.write_bronze(to_bronze(found.filter(~some), "run-3"), root, DAY)
    return I.difference(latest_copies(to_bronze(found, "run-4")), sources.read_bronze(spark, root))


@_query
def stream_rejects(spark, sf_dir):
    """Rejected documents of a stream by reason, after the same texts were delivered once more."""
    landing, root = session.scratch(spark, "landing"), session.scratch(spark, "lake")
    for delivery in ("first", "repeated"):
        retail.land(spark, sf_dir, f"{landing}/{delivery}")
        stream_deliveries(spark, landing, root, RUN_ID, RUN_AT, DAY, retail.LANDED, one_per_line=True)
    found = streamed_documents(spark, root, RUN_ID).filter("reason IS NOT NULL")
    return found.groupBy("reason").agg(F.count("*").alias("documents"))
