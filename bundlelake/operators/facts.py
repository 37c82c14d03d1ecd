"""What the rules need to know about a resource, one column per fact.

Validation and quality scoring look at the same fields. The facts are computed
once per resource in front of both rule sets, which keeps the rules themselves
to comparisons of plain columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlelake.functions.json import is_absent, is_array, is_blank, is_numeric, text_at
from bundlelake.schemas import RULE_JSON

# Fields tested for presence.
PRESENCE = (
    "id", "resourceType", "status", "subject", "patient", "name", "birthDate", "gender",
    "class", "period", "clinicalStatus", "code", "onsetDateTime", "effectiveDateTime",
    "valueQuantity", "type", "billablePeriod", "total",
)

_VALUE = "try_variant_get(r.valueQuantity, '$.value', 'variant')"
_TOTAL = "try_variant_get(r.total, '$.value', 'variant')"

_TEXTS = {
    "class_code": text_at("r.class", "$.code"),
    "subject_ref": text_at("r.subject", "$.reference"),
    "period_start": text_at("r.period", "$.start"),
    "period_end": text_at("r.period", "$.end"),
    "clinical_code": text_at("r.clinicalStatus", "$.coding[0].code"),
    "abatementDateTime": text_at("r.abatementDateTime"),
    "value_text": text_at("r.valueQuantity", "$.value"),
    "total_text": text_at("r.total", "$.value"),
    "currency": text_at("r.total", "$.currency"),
    "billed_start": text_at("r.billablePeriod", "$.start"),
    "billed_end": text_at("r.billablePeriod", "$.end"),
}

_TYPES = {
    "name_is_array": is_array("r.name"),
    "value_is_numeric": is_numeric(_VALUE),
    "value_type": f"schema_of_variant({_VALUE})",
    "total_is_numeric": is_numeric(_TOTAL),
}


def with_facts(resources: DataFrame, **more: Column) -> DataFrame:
    """The fact columns: field texts, blank and absent flags, JSON types; ``more`` columns beside them."""
    return (
        resources.withColumns({"r": F.from_json("resource", RULE_JSON), **more})
        .selectExpr(
            "resource_type",
            "r",
            *more,
            *[f"{text_at('r.' + name)} AS `{name}`" for name in PRESENCE],
            *[f"{sql} AS {name}" for name, sql in _TEXTS.items()],
        )
        .selectExpr(
            "*",
            *[f"{is_blank('r.' + n, f'`{n}`')} AS blank_{n}" for n in PRESENCE],
            *[f"{is_absent('r.' + n, f'`{n}`')} AS absent_{n}" for n in PRESENCE],
            *[f"{sql} AS {name}" for name, sql in _TYPES.items()],
        )
    )


# --- predicates both rule sets share, as SQL over the facts -------------------


def given(*texts: str) -> str:
    """All texts present and non-empty."""
    return "(" + " AND ".join(f"coalesce({t} <> '', false)" for t in texts) + ")"


def listed(text: str, codes: tuple[str, ...]) -> str:
    return f"{text} IN (" + ", ".join(f"'{c}'" for c in codes) + ")"


PERIOD_REVERSED = f"({given('period_start', 'period_end')} AND period_start > period_end)"
BILLED_REVERSED = f"({given('billed_start', 'billed_end')} AND billed_start > billed_end)"
ONSET_AFTER_ABATEMENT = (
    f"({given('onsetDateTime', 'abatementDateTime')} AND "
    "substring_index(onsetDateTime, 'T', 1) > substring_index(abatementDateTime, 'T', 1))"
)
VALUE_NOT_NUMERIC = "(value_text IS NOT NULL AND NOT value_is_numeric)"
NEGATIVE_TOTAL = "(total_is_numeric AND coalesce(try_cast(total_text AS double) < 0, false))"
