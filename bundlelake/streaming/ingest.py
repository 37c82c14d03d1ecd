"""Continuous bundle ingestion into bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.operators.bronze import to_bronze
from bundlelake.sinks.tables import CODEC, append_run_rows, write_bronze
from bundlelake.sources.bundles import explode_resources, ingestion_report, parse_bundles, read_documents
from bundlelake.sources.tables import STREAMED_BRONZE

#: How long after its file's time a text is remembered, so that a copy of it is passed over.
REMEMBERED = "7 days"

#: Bytes of files that one micro-batch takes, oldest files first; the texts of a batch are held while it is written.
BATCH_BYTES = 256 << 20

#: Where the digests of texts are kept: on the executors' disks, with a bounded part of them in memory. A
#: checkpoint that exists stays with the kind of store it began with.
_STATE = "spark.sql.streaming.stateStore."
_ON_DISK = {
    f"{_STATE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}rocksdb.boundedMemoryUsage": "true",
}


def stream_bundles(
    spark: SparkSession,
    landing: str,
    root: str,
    run_id: str,
    ingested_at: str,
    partition_date: str,
    pattern: str = "*.json",
    one_per_line: bool = False,
    entry_limit: int | None = None,
) -> None:
    """Append all files not seen before, then stop.

    The checkpoint remembers finished files and the file sink commits each
    batch once, so a restart neither loses nor repeats files. The sink's log
    would hide files that others write beside it, so the stream has a folder of
    its own, and reading bronze reads both. Copies of a resource are dropped
    then, as for batch loads.
    """
    docs = read_documents(spark, landing, pattern, one_per_line, stream=True)
    bronze = to_bronze(
        explode_resources(parse_bundles(docs, entry_limit), ingested_at), run_id
    )
    query = (
        bronze.withColumn("dt", F.lit(partition_date))
        .withColumn("run_id", F.col("pipeline_run_id"))
        .writeStream.format("parquet")
        .partitionBy("resource_type", "dt", "run_id")
        .option("path", f"{root}/{STREAMED_BRONZE}")
        .option("compression", CODEC)
        .option("checkpointLocation", f"{root}/_checkpoints/bronze")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_deliveries(
    spark: SparkSession,
    landing: str,
    root: str,
    run_id: str,
    ingested_at: str,
    partition_date: str,
    pattern: str = "*.json",
    one_per_line: bool = False,
    remembered: str = REMEMBERED,
    batch_bytes: int = BATCH_BYTES,
) -> None:
    """Load all files not seen before with their rejects and reports, then stop.

    A bundle whose very text came before, in whatever file, is passed over: the state store keeps
    the digests of texts until the files' times are ``remembered`` further on. A micro-batch takes some
    ``batch_bytes`` of files, writes its resources to bronze and one line per document to ``log/ingestion_report``, rejected
    ones with their reason. Both lie in folders named by run and batch, so a batch that is done again after a
    failure replaces what it wrote; the checkpoint keeps files and digests across restarts.
    """
    docs = (
        read_documents(
            spark, landing, pattern, one_per_line, stream=True, skip_unreadable=True, batch_bytes=batch_bytes
        )
        .withColumn("digest", F.sha2(F.col("value").cast("binary"), 256))
        .withWatermark("modified_at", remembered)
        .dropDuplicatesWithinWatermark(["digest"])
    )

    def load(batch: DataFrame, number: int) -> None:
        name = f"{run_id}-{number}"
        held = batch.drop("digest").persist()  # the state store is asked once a batch
        try:
            parsed = parse_bundles(held)
            report = ingestion_report(parsed, with_rejected=True).withColumn("run_id", F.lit(name))
            append_run_rows(report, f"{root}/log/ingestion_report")
            write_bronze(to_bronze(explode_resources(parsed, ingested_at), name), root, partition_date)
        finally:
            held.unpersist()

    for name, value in _ON_DISK.items():
        spark.conf.set(name, value)
    query = (
        docs.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{root}/_checkpoints/deliveries")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def streamed_documents(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The report lines of a stream's batches, rejected documents included."""
    lines = spark.read.option("mergeSchema", True).parquet(f"{root}/log/ingestion_report")
    return lines.filter(F.col("run_id").startswith(f"{run_id}-"))
