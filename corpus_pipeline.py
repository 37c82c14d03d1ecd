"""From raw documents to sharded training data: the stages, in order.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bundlelake.llm import decontamination, mixing, near_dedup, quality_rules, sharding
from bundlelake.llm.common import stored, table

#: The mix and the placement are random by design and near-duplicates need text similarity, so
#: no SQL gives the rows; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("source mix", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
