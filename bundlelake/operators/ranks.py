"""Percent rank over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_percent_rank(
    rows: DataFrame, value: str, name: str, buckets: int = 200
) -> DataFrame:
    """Add the exact percent rank of a numeric column, nulls ranking last.

    Equal values collapse to one row first. The distinct values are cut into
    buckets at approximate quantiles; counts of the lower buckets plus a
    running count inside the bucket give the rows below each value. Where the
    cuts fall changes only how work is spread, never a rank.
    """
    ties = rows.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))
    fractions = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = ties.agg(F.percentile_approx("v", fractions, F.lit(10_000))).scalar()
    bucketed = ties.withColumn("cuts", cuts).withColumn(
        "bucket",
        F.when(F.col("v").isNull(), F.lit(buckets)).otherwise(
            F.coalesce(F.size(F.filter("cuts", lambda cut: cut < F.col("v"))), F.lit(0))
        ),
    )
    bucketed = bucketed.drop("cuts")
    # At most buckets + 1 rows from here on: a window over all of them and a
    # broadcast are both bounded by that constant.
    per_bucket = bucketed.groupBy("bucket").agg(F.sum("n").alias("bucket_n"))
    lower = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "bucket",
        F.coalesce(F.sum("bucket_n").over(lower), F.lit(0)).alias("offset"),
        F.sum("bucket_n")
        .over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("all_n"),
    )
    inside = (
        Window.partitionBy("bucket")
        .orderBy(F.asc_nulls_last("v"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    ranked = bucketed.join(F.broadcast(offsets), "bucket").select(
        "v",
        F.when(F.col("all_n") > 1, below / (F.col("all_n") - 1))
        .otherwise(F.lit(0.0))
        .alias(name),
    )
    return rows.join(ranked, rows[value].eqNullSafe(ranked["v"])).drop("v")
