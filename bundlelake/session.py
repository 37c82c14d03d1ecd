"""Session settings and scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Parts that shuffles start with. AQE merges small ones to ``PART_BYTES``, so what a task groups or sorts
#: is bounded by that and not by the input over ``spark.sql.shuffle.partitions``.
SHUFFLE_PARTS, PART_BYTES = 1024, 4 << 20
#: Bytes of files that one task reads. Stored JSON takes a tenth of its size or less, so a task of the default
#: 128 MB would hold more than a gigabyte.
SPLIT_BYTES = 8 << 20
#: Folders that one task writes side by side; only with more of them does it sort its rows by folder first.
OPEN_FOLDERS = 32


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the transformations rely on.

    Timestamps without an offset are wall-clock text, so the session runs in
    UTC; skewed joins and small shuffle partitions are left to AQE, which starts
    from parts enough for large inputs. Flattening
    and rules are wide projections: beyond 8000 bytes of bytecode the JVM would
    only interpret the fused method, so Spark is told to split it instead.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < SHUFFLE_PARTS:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(SHUFFLE_PARTS))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(PART_BYTES))
    if _bytes(spark, "spark.sql.files.maxPartitionBytes") > SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FOLDERS))
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def _bytes(spark: SparkSession, name: str) -> int:
    """A size setting in bytes, whether given as a number or with a unit."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", spark.conf.get(name).strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit[:1] or "b")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="run-")


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call uses."""
    return f"{shared_folder(spark)}/bundlelake/{label}-{uuid.uuid4().hex}"
