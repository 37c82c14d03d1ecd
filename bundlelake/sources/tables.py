"""Reading zone tables and exposing them to SQL."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.operators.bronze import latest_stored_copies
from bundlelake.schemas import BRONZE, BRONZE_COLUMNS, GOLD, SILVER


#: Streams write bronze here, batch loads to ``bronze``; readers see both.
STREAMED_BRONZE = "bronze_streamed"


def read_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A Parquet table with a fixed schema; empty when it was never written.

    Only a missing path means that; any other failure to read is raised.
    """
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def read_bronze(
    spark: SparkSession,
    root: str,
    resource_type: str | None = None,
    partition_date: str | None = None,
    dedup: bool = True,
    run_id: str | None = None,
) -> DataFrame:
    """Bronze rows of one type, day and run, or of everything, batch loads and streams alike.

    All filters are on partition columns and prune folders. Every run appends
    its own folder, so copies across runs are dropped here, told apart by narrow rows.
    """
    layout = BRONZE + ", dt string, run_id string"
    rows = read_table(spark, f"{root}/bronze", layout).unionByName(
        read_table(spark, f"{root}/{STREAMED_BRONZE}", layout)
    )
    if run_id:
        rows = rows.filter(F.col("run_id") == run_id)
    if resource_type:
        rows = rows.filter(F.col("resource_type") == resource_type)
    if partition_date:
        rows = rows.filter(F.col("dt") == partition_date)
    rows = rows.select(*BRONZE_COLUMNS)
    return latest_stored_copies(rows) if dedup else rows


def read_silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, f"{root}/silver/{name}", SILVER[name])


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, f"{root}/gold/{name}", GOLD[name])


def zone_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All written tables by their zone-qualified name."""
    tables = {"bronze_resource": latest_stored_copies(read_bronze(spark, root, dedup=False))}
    tables.update({f"silver_{n}": read_silver(spark, root, n) for n in SILVER})
    tables.update({f"gold_{n}": read_gold(spark, root, n) for n in GOLD})
    return tables


def register(tables: dict[str, DataFrame]) -> None:
    """Make the tables available to ``spark.sql`` under their names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counted = [
        table.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, table in tables.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def list_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Path, modification time and size of landed files, without their content."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
            F.col("_metadata.file_size").alias("length"),
        )
    )


def empty_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Paths of landed files without a byte, which readers pass over."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    # only the file index, which the driver holds anyway, knows of them
    names = spark.createDataFrame([(name,) for name in found.inputFiles()], "path string")
    names = names.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"))  # as in _metadata
    return names.join(list_files(spark, path, pattern).select("path"), "path", "left_anti")
