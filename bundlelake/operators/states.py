"""Mergeable states: what a summary has to remember of the rows it has seen.

A state has one row per key with sums, minima and maxima. Rows that come are merged in. Rows that go
are taken out of the sums; where a row that goes held a minimum or maximum, the key is stale and its
state is made anew from the rows that are left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """Keys and values of a state and how its source's rows give them.

    ``rows`` selects the keys and, for each row, what it adds to the sums and offers as minimum or
    maximum. The first sum counts rows. ``floats`` are sums of doubles, which cannot be undone.
    """

    source: str
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    floats: tuple[str, ...]
    lows: tuple[str, ...]
    highs: tuple[str, ...]
    ddl: str
    rows: Callable[[DataFrame], DataFrame]

    def columns(self) -> tuple[str, ...]:
        return (*self.keys, *self.sums, *self.floats, *self.lows, *self.highs)


def fresh(layout: Layout, source: DataFrame) -> DataFrame:
    """The state of all rows of a source."""
    return _grouped(layout, layout.rows(source))


def _grouped(layout: Layout, rows: DataFrame) -> DataFrame:
    return rows.groupBy(*layout.keys).agg(
        *[F.sum(c).alias(c) for c in (*layout.sums, *layout.floats)],
        *[F.min(c).alias(c) for c in layout.lows],
        *[F.max(c).alias(c) for c in layout.highs],
    )


def delta(layout: Layout, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Per key what added and removed rows do to the sums, and the extremes of either kind."""
    signed = layout.rows(added).withColumn("sign", F.lit(1)).unionByName(
        layout.rows(removed).withColumn("sign", F.lit(-1))
    )
    comes, goes = F.col("sign") == 1, F.col("sign") == -1
    return signed.groupBy(*layout.keys).agg(
        *[F.sum(F.when(comes, F.col(c)).otherwise(-F.col(c))).alias(c) for c in layout.sums],
        *[F.sum(F.when(comes, F.col(c))).alias(c) for c in layout.floats],
        *[F.min(F.when(comes, F.col(c))).alias(c) for c in layout.lows],
        *[F.max(F.when(comes, F.col(c))).alias(c) for c in layout.highs],
        *[F.count(F.when(goes, F.col(c))).alias(f"gone_{c}") for c in layout.floats],
        *[F.min(F.when(goes, F.col(c))).alias(f"gone_{c}") for c in layout.lows],
        *[F.max(F.when(goes, F.col(c))).alias(f"gone_{c}") for c in layout.highs],
    )


def merged(layout: Layout, old: DataFrame, change: DataFrame) -> DataFrame:
    """Old state and change side by side, with ``stale`` where the change took an extreme away.

    Keys without rows are left out unless they are stale.
    """
    before, after = old.alias("before"), change.alias("after")
    same = [F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}")) for k in layout.keys]

    def side(name: str, column: str) -> Column:
        return F.col(f"{name}.{column}")

    def either(make: Callable[..., Column], column: str) -> Column:
        return make(side("before", column), side("after", column)).alias(column)

    lost = F.lit(False)
    for c in layout.floats:
        lost |= side("after", f"gone_{c}") > 0
    for c in layout.lows:
        lost |= F.coalesce(side("after", f"gone_{c}") <= side("before", c), F.lit(False))
    for c in layout.highs:
        lost |= F.coalesce(side("after", f"gone_{c}") >= side("before", c), F.lit(False))
    joined = before.join(after, same, "full_outer").select(
        *[F.coalesce(side("before", k), side("after", k)).alias(k) for k in layout.keys],
        *[either(lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b), c)
          for c in (*layout.sums, *layout.floats)],
        *[either(F.least, c) for c in layout.lows],
        *[either(F.greatest, c) for c in layout.highs],
        F.coalesce(lost, F.lit(False)).alias("stale"),
    )
    return joined.filter(F.col("stale") | (F.col(layout.sums[0]) > 0))


def updated(
    layout: Layout, old: DataFrame, change: DataFrame, source: DataFrame, removals: bool = True
) -> DataFrame:
    """The state after a change; ``source`` holds all rows as they are now, for stale keys only.

    Without ``removals`` in the change no key can be stale, and the source is not read.
    """
    both = merged(layout, old, change)
    if not removals:
        return both.select(*layout.columns())
    stale = both.filter("stale").select(*[F.col(k).alias(f"stale_{k}") for k in layout.keys])
    rows = layout.rows(source)
    same = [F.col(k).eqNullSafe(F.col(f"stale_{k}")) for k in layout.keys]
    again = _grouped(layout, rows.join(stale, same, "left_semi"))
    return both.filter("NOT stale").select(*layout.columns()).unionByName(again.select(*layout.columns()))
