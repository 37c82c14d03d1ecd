"""What derived input and stored tables take."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from bundlelake import session
from bundlelake.operators import incremental as I
from bundlelake.operators.bronze import to_bronze
from bundlelake.sinks import tables as sinks
from bundlelake.sources import bundles as B
from bundlelake.sources import retail
from bundlelake.sources.tables import read_bronze

DAY = datetime.datetime(2024, 1, 5)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Small retail tables of one file each."""
    root = str(tmp_path_factory.mktemp("sf"))
    keys = spark.range(1, 401)

    def put(name, frame):
        frame.coalesce(1).write.parquet(f"{root}/{name}.parquet")

    put("region", spark.createDataFrame([(0, "EAST")], "r_regionkey int, r_name string"))
    put("nation", spark.createDataFrame([(0, "LAND", 0)], "n_nationkey int, n_name string, n_regionkey int"))
    put("customer", keys.selectExpr("id AS c_custkey", "concat('Customer', id) AS c_name", "0 AS c_nationkey"))
    put("orders", keys.selectExpr("id AS o_orderkey", "id % 50 AS o_custkey", "'F' AS o_orderstatus",
                                  "1.5D * id AS o_totalprice", "'1-URGENT' AS o_orderpriority")
        .withColumn("o_orderdate", F.lit(DAY).cast("timestamp_ntz")))
    put("lineitem", keys.selectExpr("id AS l_orderkey", "1 AS l_linenumber", "id % 50 AS l_partkey",
                                    "id % 7 AS l_suppkey", "'R' AS l_returnflag")
        .withColumn("l_shipdate", F.lit(DAY).cast("timestamp_ntz")))
    put("events", keys.selectExpr("id AS event_id", "id % 50 AS user_id", "'view' AS event_type", "1.0D * id AS value")
        .withColumn("ts", F.lit(DAY).cast("timestamp_ntz")))
    return root


def size(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files if f[0] != ".")


def test_landed_bundles_are_compressed_and_read_back_whole(spark, sf_dir, tmp_path):
    texts = sorted(r[0] for r in retail.bundle_texts(spark, sf_dir).select("value").collect())
    for land, folder in ((retail.land, "one"), (retail.land_in_batches, "batches")):
        path = land(spark, sf_dir, str(tmp_path / folder))
        read = B.read_documents(spark, path, retail.LANDED, one_per_line=True)
        assert sorted(r.value for r in read.collect()) == texts
        assert size(path) < sum(map(len, texts)) / 3
    found = retail.deliveries(spark, sf_dir).filter("delivery = 1")
    path = retail.land_delivery(spark, sf_dir, str(tmp_path / "delivered"), 1)
    read = B.read_documents(spark, path, retail.LANDED, one_per_line=True)
    assert sorted(r.value for r in read.collect()) == sorted(r.value for r in found.collect())
    assert size(path) < found.agg(F.sum(F.length("value"))).first()[0] / 3


def test_bronze_is_written_with_the_codec(spark, tmp_path):
    rows = spark.range(5).selectExpr("'T' AS resource_type", "'r' AS pipeline_run_id", "cast(id AS string) AS raw_json")
    path = sinks.write_bronze(rows, str(tmp_path), "2024-01-01")
    names = [f for _, _, files in os.walk(path) for f in files if f.endswith(".parquet")]
    assert names and all(f".{sinks.CODEC}." in f for f in names)


def test_patients_are_made_in_all_spread_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(retail, "TASK_ROWS", 50)  # 400 rows: 8 tasks
    for kind, per_task in (("Patient", 100), ("Condition", 100), ("Observation", 100), ("Claim", 100)):
        made = retail.resources(spark, sf_dir, (kind,)).groupBy(F.spark_partition_id()).count()
        counts = [r["count"] for r in made.collect()]
        assert sum(counts) == 400 and len(counts) == 8 and max(counts) <= per_task, kind


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_shuffles_start_from_parts_enough_whatever_their_setting(spark):
    counts = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count()
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert f", {session.SHUFFLE_PARTS}), " in plan(counts)
    assert counts.count() == 100 and counts.agg(F.sum("count")).first()[0] == 1000


def test_tasks_read_small_splits_and_write_folders_side_by_side(spark, tmp_path):
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for given, wanted in (("128m", session.SPLIT_BYTES), ("134217728b", session.SPLIT_BYTES), ("1048576", 1 << 20), ("2MB", 2 << 20)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", given)
        assert session._bytes(session.configure(spark), "spark.sql.files.maxPartitionBytes") == wanted
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    folders = 2 * session.OPEN_FOLDERS
    many = spark.range(1000).withColumn("k", F.col("id") % folders)
    many.write.partitionBy("k").parquet(str(tmp_path / "many"))  # more folders than are open at a time
    assert spark.read.parquet(str(tmp_path / "many")).groupBy("k").count().count() == folders


def test_difference_shuffles_digests_and_finds_other_texts(spark):
    columns = "resource_type string, resource_id string, version_id string, raw_json string"
    left = spark.createDataFrame(
        [("A", "1", "1", "x"), ("A", "1", "1", "x"), ("A", "2", "1", None), ("B", None, "1", "y"), ("B", "3", "1", "z")], columns
    )
    right = spark.createDataFrame([("A", "1", "1", "x"), ("A", "2", "1", None), ("B", None, "1", "Y"), ("B", "3", "1", "z")], columns)
    found = I.difference(left, right)
    assert {tuple(r) for r in found.collect()} == {("A", 3, 2, 1), ("B", 2, 2, 2)}
    shuffles = [line for line in plan(found).splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and not any("raw_json" in line for line in shuffles)


def test_stored_bronze_without_copies_is_read_without_sorting_texts(spark, resources_of, tmp_path):
    made = [{"resourceType": "Patient", "id": str(k)} for k in range(20)] + [{"resourceType": "Claim"}]
    for run in ("a", "b"):
        sinks.write_bronze(to_bronze(resources_of(*made), run), str(tmp_path), "2024-01-01")
        rows = read_bronze(spark, str(tmp_path))
        assert rows.count() == 21
        assert ("Window" in plan(rows)) == (run == "b")
