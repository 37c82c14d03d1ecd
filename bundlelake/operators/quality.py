"""Quality scoring of a batch, by resource type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bundlelake.functions.rounding import half_even
from bundlelake.operators.facts import (
    BILLED_REVERSED,
    NEGATIVE_TOTAL,
    ONSET_AFTER_ABATEMENT,
    PERIOD_REVERSED,
    VALUE_NOT_NUMERIC,
    listed,
    with_facts,
)
from bundlelake.schemas import (
    CLAIM_STATUSES,
    CLINICAL_STATUSES,
    ENCOUNTER_CLASSES,
    ENCOUNTER_STATUSES,
    GENDERS,
    MIN_QUALITY_SCORE,
    OBSERVATION_STATUSES,
    QUALITY_WEIGHTS,
    RESOURCE_TYPES,
)

UNIQUENESS_RULE = "resource_id_uniqueness"
DETAIL_LINES = 10

# Fields each completeness rule wants present.
COMPLETENESS = {
    "patient_required_fields": ("Patient", ("id", "resourceType")),
    "patient_demographic_fields": ("Patient", ("name", "birthDate", "gender")),
    "encounter_required_fields": ("Encounter", ("id", "resourceType", "status", "subject")),
    "encounter_timing_fields": ("Encounter", ("period",)),
    "condition_required_fields": ("Condition", ("id", "resourceType", "subject")),
    "condition_clinical_fields": ("Condition", ("clinicalStatus", "code")),
    "obs_required_fields": ("Observation", ("id", "resourceType", "status", "subject")),
    "obs_value_fields": ("Observation", ("valueQuantity", "effectiveDateTime")),
    "claim_required_fields": ("Claim", ("id", "resourceType", "status", "patient")),
    "claim_financial_fields": ("Claim", ("total", "billablePeriod")),
}


@dataclass(frozen=True)
class QualityRule:
    """A rule of one type: SQL for "fails" and for its detail text, over the facts."""

    name: str
    dimension: str
    resource_type: str
    fails: str
    detail: str

    def applies_and_fails(self) -> str:
        return f"(resource_type = '{self.resource_type}' AND {self.fails})"


def _completeness(name: str) -> QualityRule:
    resource_type, fields = COMPLETENESS[name]
    first_absent = "CASE " + " ".join(f"WHEN absent_{f} THEN '{f}'" for f in fields) + " END"
    return QualityRule(
        name, "completeness", resource_type,
        "(" + " OR ".join(f"absent_{f}" for f in fields) + ")",
        f"concat('field \\'', {first_absent}, '\\' missing or empty')",
    )


def _conformity(name: str, resource_type: str, fails: str, wording: str,
                value: str) -> QualityRule:
    return QualityRule(name, "conformity", resource_type, fails,
                       f"concat('{wording}=\\'', {value}, '\\'')")


def _listing(name: str, resource_type: str, value: str, codes: tuple[str, ...],
             wording: str) -> QualityRule:
    """Fails for values present, even if empty, that are not among the codes."""
    fails = f"coalesce(NOT {listed(value, codes)}, false)"
    return _conformity(name, resource_type, fails, wording, value)


# All rules but uniqueness, which needs counts across rows.
RULES: tuple[QualityRule, ...] = (
    *[_completeness(name) for name in COMPLETENESS],
    _listing("patient_gender_codes", "Patient", "gender", GENDERS, "invalid gender"),
    _listing("encounter_status_codes", "Encounter", "status", ENCOUNTER_STATUSES,
             "invalid status"),
    _listing("encounter_class_codes", "Encounter", "class_code", ENCOUNTER_CLASSES,
             "unknown class code"),
    _listing("obs_status_codes", "Observation", "status", OBSERVATION_STATUSES,
             "invalid status"),
    _conformity("obs_value_numeric", "Observation", VALUE_NOT_NUMERIC,
                "non-numeric valueQuantity.value", "value_text"),
    _listing("claim_status_codes", "Claim", "status", CLAIM_STATUSES, "invalid status"),
    _listing("condition_clinical_status_codes", "Condition", "clinical_code",
             CLINICAL_STATUSES, "invalid clinicalStatus.code"),
    QualityRule("encounter_period_logic", "consistency", "Encounter", PERIOD_REVERSED,
                "concat('start=', period_start, ' > end=', period_end)"),
    QualityRule("condition_date_logic", "consistency", "Condition", ONSET_AFTER_ABATEMENT,
                "concat('onset=', onsetDateTime, ' after abatement=', abatementDateTime)"),
    QualityRule("claim_period_logic", "consistency", "Claim", BILLED_REVERSED,
                "'billablePeriod start > end'"),
    QualityRule("claim_total_positive", "consistency", "Claim", NEGATIVE_TOTAL,
                "concat('negative claim total=', total_text)"),
)


def _per_rule(per_type: DataFrame, kept: list[QualityRule], uniqueness: bool) -> DataFrame:
    """Turn one wide row per type into one row per rule."""

    def outcome(name: str, dimension: str, failed: str) -> str:
        return (
            f"named_struct('rule_name', '{name}', 'dimension', '{dimension}', "
            f"'failed', {failed})"
        )

    outcomes = [
        f"CASE WHEN resource_type = '{rule.resource_type}' "
        f"THEN {outcome(rule.name, rule.dimension, rule.name)} END"
        for rule in kept
    ]
    if uniqueness:
        outcomes.append(outcome(UNIQUENESS_RULE, "uniqueness", "with_id - distinct_ids"))
    rate = (F.col("total") - F.col("failed")) / F.col("total")
    return per_type.selectExpr(
        "resource_type", "total", f"inline(array_compact(array({', '.join(outcomes)})))"
    ).select(
        "resource_type",
        "rule_name",
        "dimension",
        (F.col("total") - F.col("failed")).alias("passed"),
        "failed",
        "total",
        half_even(rate, 4).alias("pass_rate"),
        rate.alias("exact_rate"),
    )


def rule_outcomes(resources: DataFrame, *dimensions: str) -> DataFrame:
    """Pass and fail counts of every rule, in one pass over the resources.

    With uniqueness, equal rows first collapse to (type, id, failed rules as bits) and
    a count. Both the rule counts and the distinct ids are taken from that narrow
    table, so no counter per rule is shuffled, and neither a large type nor a much
    repeated id meets one task.
    """
    wanted = dimensions or tuple(QUALITY_WEIGHTS)
    kept = [rule for rule in RULES if rule.dimension in wanted]
    uniqueness = "uniqueness" in wanted
    facts = with_facts(resources)
    if not uniqueness:
        checked = facts.selectExpr(
            "resource_type", *[f"{rule.applies_and_fails()} AS {rule.name}" for rule in kept]
        )
        measures = [F.count_if(F.col(rule.name)).alias(rule.name) for rule in kept]
        per_type = checked.groupBy("resource_type").agg(F.count("*").alias("total"), *measures)
        return _per_rule(per_type, kept, uniqueness)
    bits = [f"if({rule.applies_and_fails()}, {1 << k}L, 0L)" for k, rule in enumerate(kept)]
    narrow = (
        facts.selectExpr(
            "resource_type",
            "CASE WHEN NOT blank_id THEN id END AS identifier",
            f"{' | '.join(bits) or '0L'} AS failed_bits",
        )
        .groupBy("resource_type", "identifier", "failed_bits")
        .agg(F.count("*").alias("n"))
    )
    per_type = narrow.groupBy("resource_type").agg(
        F.sum("n").alias("total"),
        *[
            F.sum(F.when(F.expr(f"failed_bits & {1 << k}L") != 0, F.col("n")).otherwise(0)).alias(rule.name)
            for k, rule in enumerate(kept)
        ],
    )
    # Summing ``n`` here too makes both branches read the same exchange.
    per_id = narrow.groupBy("resource_type", "identifier").agg(F.sum("n").alias("n"))
    ids = per_id.groupBy(F.col("resource_type").alias("id_type")).agg(
        F.sum(F.when(F.col("identifier").isNotNull(), F.col("n")).otherwise(0)).alias("with_id"),
        F.count("identifier").alias("distinct_ids"),
    )
    per_type = per_type.join(ids, F.col("resource_type").eqNullSafe(F.col("id_type"))).drop("id_type")
    return _per_rule(per_type, kept, uniqueness)


def rule_details(resources: DataFrame, limit: int = DETAIL_LINES) -> DataFrame:
    """The first lines of failing records per rule, in id order.

    One pass over the resources gives a line per failing rule and a row per id, so each text is
    made and parsed once. Equal rows are counted before the shuffle; of a repeated line no more
    copies than the limit come back.
    """
    failing = ", ".join(
        f"CASE WHEN {rule.applies_and_fails()} THEN named_struct('rule_name', '{rule.name}', "
        f"'resource_id', coalesce(id, '?'), "
        f"'detail', concat('id=', coalesce(id, '?'), ': ', {rule.detail})) END"
        for rule in RULES
    )
    own = (
        f"CASE WHEN own_id <> '' THEN named_struct('rule_name', '{UNIQUENESS_RULE}', "
        "'resource_id', own_id, 'detail', cast(null AS string)) END"
    )
    rows = (
        with_facts(resources, own_id=F.get_json_object("resource", "$.id"))
        .selectExpr("resource_type", f"inline(array_compact(array({failing}, {own})))")
        .groupBy("resource_type", "rule_name", "resource_id", "detail")
        .agg(F.count("*").alias("n"))
    )
    repeats = F.col("rule_name") == UNIQUENESS_RULE
    copies = F.when(repeats, 1).otherwise(F.least("n", F.lit(limit))).cast("int")
    order = Window.partitionBy("resource_type", "rule_name").orderBy("resource_id", "detail")
    return (
        rows.filter(~repeats | (F.col("n") > 1))
        .withColumn(
            "detail",
            F.when(repeats, F.format_string("id=%s appears %d times", "resource_id", "n")).otherwise(F.col("detail")),
        )
        .withColumn("copy", F.explode(F.array_repeat(F.lit(0), copies)))
        .withColumn("line", F.row_number().over(order))
        .filter(F.col("line") <= limit)
        .select("resource_type", "rule_name", "line", "detail")
    )


def dimension_scores(outcomes: DataFrame) -> DataFrame:
    """Mean pass rate per dimension times 100; 100 where a type has no rule."""
    rates = outcomes.groupBy("resource_type").agg(
        F.max("total").alias("record_count"),
        *[
            F.coalesce(
                F.avg(F.when(F.col("dimension") == name, F.col("exact_rate"))) * 100,
                F.lit(100.0),
            ).alias(name)
            for name in QUALITY_WEIGHTS
        ],
    )
    return rates


def long_dimension_scores(outcomes: DataFrame) -> DataFrame:
    wide = dimension_scores(outcomes)
    return wide.unpivot(
        "resource_type", list(QUALITY_WEIGHTS), "dimension", "value"
    ).select("resource_type", "dimension", half_even(F.col("value")).alias("dimension_score"))


def scores(outcomes: DataFrame, min_score: float = MIN_QUALITY_SCORE) -> DataFrame:
    """Weighted score per type, compared unrounded with the threshold."""
    weighted = sum(
        (F.col(name) * F.lit(weight) for name, weight in QUALITY_WEIGHTS.items()),
        F.lit(0.0),
    )
    return dimension_scores(outcomes).select(
        "resource_type",
        "record_count",
        half_even(weighted).alias("quality_score"),
        *[half_even(F.col(name)).alias(name) for name in QUALITY_WEIGHTS],
        (weighted >= F.lit(float(min_score))).alias("passed_threshold"),
    )


def gate(resources: DataFrame, scored: DataFrame, mode: str = "warn") -> DataFrame:
    """Mark resources by the score of their type.

    ``warn`` lets everything pass; ``quarantine`` holds back the types below
    the threshold. Only the five supported types are looked up, which bounds
    the broadcast at five rows.
    """
    if mode not in ("warn", "quarantine"):
        raise ValueError(f"unknown gate mode {mode!r}")
    verdict = F.col("passed_threshold") | F.lit(mode == "warn")
    verdicts = scored.filter(F.col("resource_type").isin(*RESOURCE_TYPES)).select(
        "resource_type", verdict.alias("released")
    )
    return resources.join(F.broadcast(verdicts), "resource_type", "left").withColumn(
        "released", F.coalesce("released", F.lit(True))
    )
