"""The full load, and its pieces as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.operators import gold as gold_tables
from bundlelake.operators import quality, validation
from bundlelake.operators.bronze import latest_copies, latest_stored_copies, latest_versions, to_bronze
from bundlelake.operators.silver import flatten, flatten_all
from bundlelake.sinks.tables import append_run_rows, write_bronze, write_gold, write_silver
from bundlelake.sources.tables import read_bronze, read_gold, read_silver
from bundlelake.schemas import (
    GOLD,
    MIN_QUALITY_SCORE,
    QUALITY_LOG,
    RESOURCE_TYPES,
    RUN_LOG,
    SILVER,
)

STAGES = ("ingest", "validate", "bronze", "silver", "gold", "warehouse")


def lazy_silver(
    resources: DataFrame,
    run_id: str,
    types: tuple[str, ...] = RESOURCE_TYPES,
    latest_only: bool = False,
) -> dict[str, DataFrame]:
    """Flat tables of the given types straight from resources, without writing anything."""
    bronze = latest_copies(to_bronze(resources, run_id))
    if latest_only:
        bronze = latest_versions(bronze)
    return {name.lower(): flatten(bronze, name) for name in types}


def _count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("records"))


def _total(tables: list[DataFrame]) -> DataFrame:
    counts = _count(tables[0])
    for table in tables[1:]:
        counts = counts.unionByName(_count(table))
    return counts.agg(F.sum("records").alias("records"))


def quality_log_rows(scored: DataFrame, run_id: str, evaluated_at: str) -> DataFrame:
    return scored.select(
        F.lit(run_id).alias("run_id"),
        "resource_type",
        "record_count",
        "quality_score",
        "completeness",
        "conformity",
        "consistency",
        "uniqueness",
        "passed_threshold",
        F.lit(evaluated_at).alias("evaluated_at"),
    )


def write_zones(
    spark: SparkSession,
    resources: DataFrame,
    root: str,
    run_id: str,
    run_at: str,
    latest_only: bool = False,
) -> None:
    """Bronze, silver and gold tables of a batch, each built from the one before."""
    day = run_at[:10]
    write_bronze(latest_copies(to_bronze(resources, run_id)), root, day)
    bronze = latest_stored_copies(read_bronze(spark, root, dedup=False))
    if latest_only:
        bronze = latest_versions(bronze)
    for name, table in flatten_all(bronze).items():
        write_silver(table, root, name)
    silver = {name: read_silver(spark, root, name) for name in SILVER}
    for name, table in gold_tables.build_all(silver, run_at).items():
        write_gold(table, root, name)


def run_full_load(
    spark: SparkSession,
    resources: DataFrame,
    root: str,
    run_id: str,
    run_at: str,
    min_score: float = MIN_QUALITY_SCORE,
    gate_mode: str = "warn",
) -> DataFrame:
    """Validate, score, write all zones, and log record counts per stage.

    Every resource's validity and issues, and their summary per type, are stored with the run.
    Returns the log rows of the run. With ``gate_mode='quarantine'`` types
    scoring below ``min_score`` do not reach the zones.
    """
    found = validation.results(validation.validate(resources)).withColumn("run_id", F.lit(run_id))
    checks = append_run_rows(found, f"{root}/log/validation_results")
    checked = spark.read.schema(found.schema).parquet(checks).filter(F.col("run_id") == run_id)
    append_run_rows(
        validation.summary_of(checked).withColumn("run_id", F.lit(run_id)),
        f"{root}/log/validation_summary",
    )
    scored = quality.scores(quality.rule_outcomes(resources), min_score)
    append_run_rows(
        quality_log_rows(scored, run_id, run_at), f"{root}/log/data_quality_scores"
    )
    released = resources
    if gate_mode != "warn":
        stored = spark.read.schema(QUALITY_LOG).parquet(f"{root}/log/data_quality_scores")
        verdicts = stored.filter(F.col("run_id") == run_id)
        released = quality.gate(resources, verdicts, gate_mode).filter("released")
        released = released.drop("released")
    write_zones(spark, released, root, run_id, run_at)
    bronze = [read_bronze(spark, root, dedup=False)]
    silver = [read_silver(spark, root, name) for name in SILVER]
    gold = [read_gold(spark, root, name) for name in GOLD]
    counts = {
        "ingest": _count(resources),
        "validate": _count(checked),
        "bronze": _count(read_bronze(spark, root, dedup=False, run_id=run_id)),
        "silver": _total(silver),
        "gold": _total(gold),
        "warehouse": _total(bronze + silver + gold),
    }
    log = None
    for stage in STAGES:
        line = counts[stage].select(
            F.lit(run_id).alias("run_id"),
            F.lit(stage).alias("stage"),
            F.lit("SUCCESS").alias("status"),
            F.col("records").cast("long").alias("records"),
            F.lit(run_at).alias("created_at"),
        )
        log = line if log is None else log.unionByName(line)
    append_run_rows(log, f"{root}/log/pipeline_run_log")
    history = spark.read.schema(RUN_LOG).parquet(f"{root}/log/pipeline_run_log")
    return history.filter(F.col("run_id") == run_id)
