"""Raw layer: projection with lineage, and removal of copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bundlelake.functions.fhir import or_empty
from bundlelake.schemas import BRONZE_COLUMNS, ENVELOPE_JSON

#: Hashes of repeated identities (8 bytes each) up to this number are sent to every task.
REPEATED_KEYS = 1_000_000


def _strip(value: Column) -> Column:
    return F.trim(value, F.lit(" \t\n\r\f\x0b"))


def without_private_keys(resource: Column) -> Column:
    """Drop top-level keys starting with ``_``; other texts stay untouched."""
    keys = F.json_object_keys(resource)
    rest = F.map_filter(
        F.from_json(resource, "map<string,variant>"),
        lambda key, _: ~key.startswith("_"),
    )
    # The substring test spares almost every row the extra parse.
    return F.when(
        F.contains(resource, F.lit('"_'))
        & F.coalesce(F.exists(keys, lambda k: k.startswith("_")), F.lit(False)),
        F.to_json(rest),
    ).otherwise(resource)


def to_bronze(resources: DataFrame, run_id: str) -> DataFrame:
    """Eleven text columns: identity, lineage and the raw JSON."""
    head = resources.withColumn("head", F.from_json("resource", ENVELOPE_JSON))
    stamp = F.col("ingestion_timestamp")
    columns = {
        "resource_id": or_empty(F.col("head.id")),
        "resource_type": F.col("resource_type"),
        "version_id": F.coalesce(F.col("head.meta.versionId"), F.lit("1")),
        "last_updated": or_empty(F.col("head.meta.lastUpdated")),
        "source_file": or_empty(F.col("source_file")),
        "bundle_id": or_empty(F.col("bundle_id")),
        "full_url": or_empty(F.col("full_url")),
        "ingestion_timestamp": stamp,
        "ingestion_date": F.substring(stamp, 1, 10),
        "pipeline_run_id": F.lit(run_id),
    }
    return head.select(
        *[_strip(value).alias(name) for name, value in columns.items()],
        without_private_keys(F.col("resource")).alias("raw_json"),
    )


def own_identity() -> Column:
    """What tells resources without an id apart: where they lie and their text; null with an id."""
    place = F.concat_ws("\x1f", "source_file", "bundle_id", "full_url", "raw_json")
    return F.when(F.col("resource_id") == "", F.sha2(place, 256))


def latest_copies(bronze: DataFrame) -> DataFrame:
    """Keep the newest copy of each (type, id, version).

    ``row_number() = 1`` lets Spark drop older copies inside each map task
    before the shuffle, so one heavily repeated resource stays cheap. The
    trailing order columns make the choice total. Resources without an id are
    copies only if they come from the same place with the same text.
    """
    identity = ("resource_type", "resource_id", "version_id", own_identity())
    newest = Window.partitionBy(*identity).orderBy(
        F.desc("ingestion_timestamp"),
        F.desc("last_updated"),
        F.desc("source_file"),
        F.desc("bundle_id"),
        F.desc("raw_json"),
    )
    return (
        bronze.withColumn("copy", F.row_number().over(newest))
        .filter("copy = 1")
        .select(*BRONZE_COLUMNS)
    )


def latest_stored_copies(rows: DataFrame, known: int = REPEATED_KEYS) -> DataFrame:
    """As :func:`latest_copies`, for rows that lie in files and can be read more than once.

    Rows are shuffled by a hash of their identity alone, to find the hashes that occur more than once; only
    rows with one of those are compared whole. Up to ``known`` such hashes are sent to all tasks,
    with more of them all rows are compared.
    """
    name = "identity_hash"
    hashed = rows.withColumn(name, F.xxhash64("resource_type", "resource_id", "version_id", own_identity()))
    repeated = hashed.groupBy(name).agg(F.count("*").alias("n")).where("n > 1").select(name)
    found = repeated.limit(known + 1).count()
    if not found:
        return rows.select(*BRONZE_COLUMNS)
    if found > known:
        return latest_copies(rows)
    single = hashed.join(F.broadcast(repeated), name, "left_anti").select(*BRONZE_COLUMNS)
    return single.unionByName(latest_copies(hashed.join(F.broadcast(repeated), name, "left_semi")))


def latest_versions(bronze: DataFrame) -> DataFrame:
    """Optionally keep only the highest version of each resource."""
    newest = Window.partitionBy("resource_type", "resource_id", own_identity()).orderBy(
        F.desc(F.col("version_id").try_cast("long")),
        F.desc("version_id"),
        F.desc("ingestion_timestamp"),
        F.desc("raw_json"),
    )
    return (
        bronze.withColumn("copy", F.row_number().over(newest))
        .filter("copy = 1")
        .select(*BRONZE_COLUMNS)
    )


def copy_stats(bronze: DataFrame) -> DataFrame:
    """Per type: rows in, rows kept and copies removed, from counts alone."""
    copies = bronze.groupBy(
        "resource_type", "resource_id", "version_id", own_identity().alias("own")
    ).agg(F.count("*").alias("n"))
    return copies.groupBy("resource_type").agg(
        F.sum("n").alias("records_ingested"),
        F.count("*").alias("records_written"),
        (F.sum("n") - F.count("*")).alias("duplicates_removed"),
    )
