"""Writing zone tables and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.schemas import GOLD, SILVER

#: Codec of zone tables: raw JSON takes about half the space it takes with Spark's default.
CODEC = "zstd"


def write_bronze(bronze: DataFrame, root: str, partition_date: str) -> str:
    """Write bronze rows below ``resource_type/dt/run_id``.

    A run owns its folders and replaces only those, so repeating a failed run
    leaves no copies and other runs stay as they are.
    """
    path = f"{root}/bronze"
    (
        bronze.withColumn("dt", F.lit(partition_date))
        .withColumn("run_id", F.col("pipeline_run_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("resource_type", "dt", "run_id")
        .parquet(path, compression=CODEC)
    )
    return path


def write_silver(table: DataFrame, root: str, name: str) -> str:
    """Replace a flat table; an empty batch empties it."""
    if name not in SILVER:
        raise ValueError(f"unknown silver table {name!r}")
    path = f"{root}/silver/{name}"
    table.write.mode("overwrite").parquet(path, compression=CODEC)
    return path


def write_gold(table: DataFrame, root: str, name: str) -> str:
    """Replace a summary table; an empty batch empties it."""
    if name not in GOLD:
        raise ValueError(f"unknown gold table {name!r}")
    path = f"{root}/gold/{name}"
    table.write.mode("overwrite").parquet(path, compression=CODEC)
    return path


def append_ledger(entries: DataFrame, path: str) -> str:
    """Add entries to an append-only ledger (files, watermarks)."""
    entries.write.mode("append").parquet(path, compression=CODEC)
    return path


def append_run_rows(rows: DataFrame, path: str) -> str:
    """Add history rows of a run; repeating the run replaces its own rows."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path, compression=CODEC)
    )
    return path
