"""Pulling scalars out of parsed FHIR structures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def first_of(*candidates: Column) -> Column:
    """First non-empty text, else an empty string."""
    return or_empty(F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates]))


def first_item(items: Column) -> Column:
    return F.get(items, F.lit(0))


def first_match(items: Column, test: Callable[[Column], Column]) -> Column:
    return first_item(F.filter(items, test))


def prefer(items: Column, test: Callable[[Column], Column]) -> Column:
    """The first element passing the test, else the first element."""
    return F.coalesce(first_match(items, test), first_item(items))


def code_of(concept: Column) -> Column:
    return or_empty(first_item(concept["coding"])["code"])


def display_of(concept: Column) -> Column:
    return first_item(concept["coding"])["display"]


def reference_id(reference: Column) -> Column:
    """What follows the first slash; the whole text when there is none."""
    return or_empty(F.regexp_replace(reference, "^[^/]*/", ""))


def slashed_reference_id(reference: Column) -> Column:
    """As ``reference_id`` but empty when the text has no slash."""
    return F.when(F.contains(reference, F.lit("/")), reference_id(reference)).otherwise("")


def identifier_value(identifiers: Column, keyword: str) -> Column:
    """Value of the first identifier whose system mentions the keyword, else of the first."""
    hit = first_match(
        identifiers, lambda i: F.lower(or_empty(i["system"])).contains(keyword.lower())
    )
    return or_empty(
        F.when(hit.isNotNull(), hit["value"]).otherwise(first_item(identifiers)["value"])
    )


def number(text: Column) -> Column:
    """Finite number or null; never an error."""
    value = text.try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)  # NaN counts as larger


def starts_with_any(code: Column, prefixes: tuple[str, ...]) -> Column:
    return F.upper(or_empty(code)).rlike("^(" + "|".join(prefixes) + ")")
