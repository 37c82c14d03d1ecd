"""JSON parsing, and SQL snippets for type-aware tests on VARIANT values.

Each snippet helper takes and returns SQL text, so a whole rule set reaches Spark as a
handful of expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZERO = r"r'^-?0+(\.0*)?([eE][+-]?\d+)?$'"
_NUMERIC_OR_BOOLEAN = "r'^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)'"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_at(value: str, path: str = "$") -> str:
    """Scalar text at a path; objects and arrays come back as JSON text."""
    return f"try_variant_get({value}, '{path}', 'string')"


def _known_type(value: str, test: str) -> str:
    return f"coalesce(schema_of_variant({value}) {test}, false)"


def is_array(value: str) -> str:
    return _known_type(value, "LIKE 'ARRAY%'")


def is_numeric(value: str) -> str:
    """JSON numbers; booleans count as numbers, as they do in the rules."""
    return _known_type(value, f"RLIKE {_NUMERIC_OR_BOOLEAN}")


def is_blank(value: str, text: str) -> str:
    """Missing, null, ``""``, ``[]``, ``{}``, ``0`` or ``false``.

    ``text`` is the value as text. Strings that only look blank, such as
    ``"0"``, are not: just for those texts the JSON type is looked up.
    """
    zero = f"(substr({text}, 1, 1) IN ('0', '-') AND {text} RLIKE {_ZERO})"
    looks_blank = f"({text} IN ('[]', '{{}}', 'false') OR {zero})"
    return (
        f"CASE WHEN {text} IS NULL OR {text} = '' THEN true "
        f"WHEN {looks_blank} THEN schema_of_variant({value}) <> 'STRING' ELSE false END"
    )


def is_absent(value: str, text: str) -> str:
    """Missing, null, ``""`` or ``[]``; an empty object counts as present."""
    return (
        f"CASE WHEN {text} IS NULL OR {text} = '' THEN true "
        f"WHEN {text} = '[]' THEN schema_of_variant({value}) <> 'STRING' ELSE false END"
    )


def parsed_once(text: str, schema: str, options: dict[str, str] | None = None) -> Column:
    """A JSON text column parsed behind a one-item explode.

    Filters on derived columns stop at the generator. Without it Catalyst would
    push them below the projection and parse every text again for each one.
    """
    return F.explode_outer(F.array(F.from_json(text, schema, options)))
