from __future__ import annotations

import pytest

import __spark_entry__
from clickloom.session import PARTITION_LIMITS, bound_partitions


@pytest.fixture
def sizes(spark):
    old = {key: spark.conf.get(key) for key in PARTITION_LIMITS}
    yield PARTITION_LIMITS
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("size", ["128MB", "134217728b", "1g", "134217728", "64 m"])
def test_large_partitions_are_bounded(spark, sizes, size):
    for key in sizes:
        spark.conf.set(key, size.replace(" ", ""))
    bound_partitions(spark)
    assert {key: int(spark.conf.get(key).removesuffix("b")) for key in sizes} == sizes


def test_smaller_partitions_stay(spark, sizes):
    for key in sizes:
        spark.conf.set(key, "1m")
    bound_partitions(spark)
    assert all(spark.conf.get(key) in ("1m", "1048576b") for key in sizes)


def test_the_clickstream_queries_run_in_bounds(spark, sizes, tmp_path):
    events = spark.range(40).selectExpr(
        "id AS event_id", "timestamp_seconds(1705000000 + 40000 * id) AS ts", "id % 3 AS user_id", "'view' AS event_type", "1.5D AS value", "'{}' AS props"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    for key in sizes:
        spark.conf.set(key, "128m")
    found = __spark_entry__.queries()["incremental_sessions"](spark, str(tmp_path))
    assert {key: int(spark.conf.get(key).removesuffix("b")) for key in sizes} == sizes
    assert found.count() > 0
