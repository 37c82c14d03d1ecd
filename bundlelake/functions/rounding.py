"""The three rounding conventions the tables need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int = 2) -> Column:
    """Scale, round halves to even, scale back (gold aggregates, scores)."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def half_away(value: Column, digits: int = 2) -> Column:
    """Scale, round halves away from zero, scale back (report views)."""
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale


def hours_from_seconds(seconds: Column) -> Column:
    """Hours to two places, rounding the binary quotient rather than its text.

    Only ``seconds % 36 == 18`` ends on half a hundredth of an hour. There the
    double nearest to ``seconds / 3600`` lies above or below the true half, and
    its distance, computed in steps that are each exact, tells which way to go.
    """
    size = F.abs(seconds)
    hours = size / F.lit(3600.0)
    odd = size / F.lit(18.0)
    above = (hours * 128 - odd) + hours * 64 + hours * 8
    floor = F.floor(size / F.lit(36.0))
    up = F.when(above == 0, floor % 2 == 1).otherwise(above > 0)
    at_half = (floor + F.when(up, 1).otherwise(0)) / F.lit(100.0)
    rounded = F.when(size % 36 == 18, at_half).otherwise(F.round(hours, 2))
    return F.when(seconds < 0, -rounded).otherwise(rounded)


def summand(value: Column) -> tuple[Column, Column]:
    """A double as a decimal, and as a double where no decimal of 22 whole digits holds it.

    NaN and infinities are neither.
    """
    exact = value.try_cast("decimal(28,6)")
    return exact, F.when(exact.isNull() & (F.abs(value) < float("inf")), value)


def total(exact: Column, rest: Column) -> Column:
    """Sums of both kinds of summands as one double (null if there is none)."""
    return F.when(exact.isNotNull() | rest.isNotNull(), F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0)))


def exact_sum(value: Column) -> Column:
    """Sum of a double column, as a double (null if no value).

    What fits a decimal is added exactly, in any order; the rest is added as doubles.
    """
    exact, rest = summand(value)
    return total(F.sum(exact), F.sum(rest))
