from __future__ import annotations

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from chartlake.operators import joins
from chartlake.operators.aggregates import group_concat, group_count, latest_by_key


def test_group_concat(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None), (None, "x")], "k INT, v STRING"
    )
    assert rows(group_concat(df, ["k"], "v", "all")) == [(None, "x"), (1, "a, b"), (2, "")]


def test_group_count(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k STRING")
    counted = group_count(df, ["k"])
    assert counted.schema.simpleString() == "struct<k:string,count:bigint>"
    assert rows(counted) == [(None, 1), ("a", 2)]


def test_latest_by_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), (None, 1, "n")],
        "k STRING, seq INT, v STRING",
    )
    latest = latest_by_key(df, ["k"], ["seq"])
    assert rows(latest) == [(None, 1, "n"), ("a", 3, "new")]
    plan = final_plan(latest)
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:], "no limit below the shuffle"


KEYS = ["position", "day"]


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [("x", 1, "d1"), ("x", 1, "d1"), ("y", 2, "d1"), ("z", None, "d1"), ("w", 1, None)],
        "id STRING, position INT, day STRING",
    )


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "d2"), (2, "d1"), (2, "d1"), (None, "d1")], "position INT, day STRING"
    )


@pytest.mark.parametrize("threshold", ["10MB", "-1"], ids=["broadcast", "shuffled"])
def test_unseen(batch, target, threshold, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    left = joins.unseen(batch, target, KEYS)
    assert left.columns == batch.columns
    assert rows(left, "id") == [("w",), ("x",), ("x",), ("z",)]
    null_safe = joins.unseen(batch, target, KEYS, null_safe=True)
    assert rows(null_safe, "id") == [("w",), ("x",), ("x",)]
    assert ("BroadcastHashJoin" in final_plan(left)) == (threshold != "-1")


def test_copies_of_the_target_shrink_before_the_shuffle(spark):
    batch = spark.range(10).select(F.col("id").alias("key"))
    target = spark.range(5000).select((F.col("id") % 5).alias("key"))
    plan = final_plan(joins.unseen(batch, target, ["key"]))
    # The first aggregation stands below the first exchange of the target's side.
    assert plan.count("HashAggregate(keys=[key") >= 2
    assert joins.unseen(batch, target, ["key"]).count() == 5


def test_enrich_drops_entries_without_a_record(spark):
    entries = spark.createDataFrame([("t1", 1), ("t9", 2), (None, 3)], "track STRING, position INT")
    lookup = spark.createDataFrame([("t1", "One"), ("t2", "Two")], "id STRING, name STRING")
    got = joins.enrich(entries, lookup, "track").select("position", "record.name")
    assert rows(got) == [(1, "One")]


def test_inner_join_keeps_both_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "n")], "id INT, v STRING")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (None, "r")], "artists_id INT, w STRING")
    got = joins.inner_renamed(left, right, "id", "artists_id")
    assert got.columns == ["id", "v", "artists_id", "w"]
    assert rows(got) == [(1, "a", 1, "p"), (1, "a", 1, "q")]


@pytest.mark.parametrize("shape", ["inner", "anti"])
def test_a_hot_key_is_split_at_run_time(spark, setting, shape):
    """A third of all rows share one key; nothing may be broadcast."""
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    hot = spark.range(0, 300_000, 1, 20).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"),
        F.xxhash64("id").alias("payload"),
    )
    others = spark.range(0, 150_000, 1, 4)
    if shape == "inner":
        joined = joins.inner_renamed(hot, others.withColumn("id", F.col("id") - 1), "key", "id")
        expected = 100_000 + sum(1 for k in range(149_999) if k % 3)
    else:
        joined = joins.unseen(hot, others.select(F.col("id").alias("key")), ["key"])
        expected = 100_000 + sum(1 for k in range(150_000, 300_000) if k % 3)
    assert joined.count() == expected
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
