"""Joins with heavy and NULL keys."""

import pytest
from pyspark.sql import functions as F

from lakeward.operators.joins import heavy_keys, left_join_split_nulls, left_join_spread


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_heavy_keys(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.col("id").cast("string")).alias("k"))
    found = heavy_keys(rows, "k", 1 / 32)
    assert set(found) == {"hot", None}
    assert found["hot"] == pytest.approx(1 / 3, abs=0.01) and found[None] == pytest.approx(1 / 15, abs=0.01)
    assert heavy_keys(rows.limit(0), "k", 0.1) == {}
    assert heavy_keys(spark.range(1000), "id", 1 / 32) == {}


def test_nothing_is_copied_without_heavy_keys(spark, static_plans):
    left = spark.range(4000).select(F.col("id").alias("order_id"), (F.col("id") % 500).alias("customer"))
    known = left.select(F.col("customer").alias("known")).where("known % 3 = 1").distinct()
    out = left_join_spread(left, known, "customer", "known", spread_by="order_id")
    assert "Generate" not in plan(out) and "__turn" not in plan(out)
    assert out.where("known is not null").count() == left.where("customer % 3 = 1").count()


@pytest.mark.parametrize("share", [2, 4])
def test_heavy_keys_take_copies_by_their_share(spark, static_plans, share):
    left = spark.range(6400).select(
        F.col("id").alias("order_id"), F.when(F.col("id") % share == 0, 7).otherwise(F.col("id")).cast("long").alias("customer"))
    known = left.select(F.col("customer").alias("known")).distinct()
    out = left_join_spread(left, known, "customer", "known", spread_by="order_id")
    assert out.count() == 6400 and out.where("known is null").count() == 0
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 6400 / share / 3  # one task would have that many rows of customer 7 and more
    copied = spark.createDataFrame([(7,), (8,)], "known long")
    right_rows = left_join_spread(left, copied, "customer", "known", spread_by="order_id")
    assert right_rows.where("known = 8").count() == left.where("customer = 8").count()


def test_null_keys_are_spread_in_one_scan(spark, static_plans):
    left = spark.range(3000).select(F.col("id").alias("c"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("p"))
    right = spark.range(0, 3000, 2).select(F.col("id").alias("q"), F.lit("x").alias("v"))
    out = left_join_split_nulls(left, right, "p", "q", "c")
    assert out.columns == ["c", "p", "q", "v"]
    want = {(i, i if i % 3 else None, "x" if i % 3 and i % 2 == 0 else None) for i in range(3000)}
    assert {(r.c, r.p, r.v) for r in out.collect()} == want and out.count() == 3000
    logical = out._jdf.queryExecution().analyzed().toString()
    assert logical.count("Range (0, 3000, step=1") == 1
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 500  # a thousand rows have no key
