from __future__ import annotations

import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bundlelake import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return session.configure(spark)


@pytest.fixture(scope="session")
def resources_of(spark):
    """Turn resource dicts into the frame that bundle reading delivers."""

    def make(*resources, stamps=None):
        rows = [
            (
                r.get("resourceType", "Unknown"), json.dumps(r), "f.json", "b-1", f"urn:{i}",
                stamps[i] if stamps else "2024-01-15T10:00:00+00:00",
            )
            for i, r in enumerate(resources)
        ]
        return spark.createDataFrame(
            rows,
            "resource_type string, resource string, source_file string, bundle_id string, "
            "full_url string, ingestion_timestamp string",
        )

    return make
