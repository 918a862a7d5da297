from datetime import datetime

import pytest

from lakeward.operators.contracts import (
    accepted_values, gate, not_null, relationships, run_contracts, unique, unique_combination,
)
from lakeward.operators.freshness import freshness
from lakeward.plans.contract_specs import declared_tests


@pytest.fixture
def tables(spark):
    child = spark.createDataFrame(
        [(1, 10, "M", 1), (2, 10, "X", 1), (2, 11, "m", 2), (None, 99, None, 3), (4, None, "X", 3)],
        "id int, parent_id int, gender string, line int")
    parent = spark.createDataFrame([(10,), (11,), (11,)], "pid int")
    return {"child": child, "parent": parent}


def test_failure_counts_and_status(spark, tables):
    tests = [
        not_null("child", "id"),
        unique("child", "id", "warn"),
        accepted_values("child", "gender", ["M", "F"], "warn"),
        relationships("child", "parent_id", "parent", "pid"),
        unique_combination("child", ["id", "line"]),
        unique("parent", "pid"),
    ]
    out = {(r.model, r.column_name, r.test): r for r in run_contracts(tables, tests).collect()}
    assert out[("child", "id", "not_null")].failures == 1
    assert out[("child", "id", "not_null")].status == "fail"
    assert out[("child", "id", "unique")].failures == 1
    assert out[("child", "id", "unique")].status == "warn"
    # distinct non-NULL values outside the set: 'X' and 'm'
    assert out[("child", "gender", "accepted_values")].failures == 2
    # non-NULL child rows without a parent: the row with 99
    assert out[("child", "parent_id", "relationships")].failures == 1
    assert out[("child", "id,line", "unique_combination_of_columns")].failures == 0
    assert out[("parent", "pid", "unique")].failures == 1
    with pytest.raises(AssertionError):
        gate(run_contracts(tables, tests))


def test_passing_contracts_gate_quietly(spark, tables):
    gate(run_contracts(tables, [not_null("parent", "pid")]))


def test_declared_contracts_are_complete():
    tests = declared_tests()
    assert len(tests) == 207
    kinds = {}
    for t in tests:
        kinds[t.test] = kinds.get(t.test, 0) + 1
    assert kinds == {"not_null": 159, "unique": 24, "accepted_values": 10, "relationships": 11,
                     "unique_combination_of_columns": 3}
    assert {t.severity for t in tests if t.test == "relationships" and t.to == "stg_erp__order_headers"} == {"error"}


@pytest.mark.parametrize("age_hours,status", [(12, "pass"), (48, "warn"), (96, "error")])
def test_freshness_thresholds(spark, age_hours, status):
    from datetime import timedelta
    now = datetime(2024, 1, 10, 12)
    df = spark.createDataFrame([(now - timedelta(hours=age_hours),)], "_ingested_at timestamp_ntz")
    r = freshness(df, "raw", now, warn_after_days=1, error_after_days=3).first()
    assert r.status == status and r.age_hours == age_hours


def test_freshness_empty_table_is_error(spark):
    df = spark.createDataFrame([], "_ingested_at timestamp_ntz")
    assert freshness(df, "raw", datetime(2024, 1, 1), 1, 3).first().status == "error"


def test_tests_that_share_a_column_set_count_once(spark):
    from lakeward.operators.contracts import duplicate_group_counts

    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4), (None, 1), (None, 1)], "k int, v int")
    row = duplicate_group_counts(df, [(("k",), True), (("k",), False), (("k", "v"), False), (("v", "k"), False)]).first()
    assert tuple(row) == (1, 2, 2, 2)


def test_preset_shuffle_partitions_survive(spark):
    from lakeward.session import get_spark

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        assert get_spark().conf.get("spark.sql.shuffle.partitions") == "2000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_written_once_equals_the_lazy_run(spark, tables, scratch):
    from pyspark.sql import functions as F

    from lakeward.operators.contract_runs import run_contracts_once
    from lakeward.operators.contracts import expression_is_true

    tests = [
        not_null("child", "id"), unique("child", "id", "warn"), unique("child", "gender"),
        accepted_values("child", "gender", ["M", "F"], "warn"), accepted_values("child", "line", [1, 2]),
        relationships("child", "parent_id", "parent", "pid"),
        unique_combination("child", ["id", "line"]), unique_combination("child", ["gender", "line"]),
        unique_combination("child", ["line", "gender"]), unique("parent", "pid"), not_null("parent", "pid"),
        expression_is_true("child", "small", "line < 3", "warn"),
    ]
    key = lambda df: sorted(map(tuple, df.collect()))
    lazy = key(run_contracts(tables, tests))
    assert key(run_contracts_once(tables, tests, f"{scratch}/a")) == lazy
    # hashes that meet by chance are told from repeated keys
    weak = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(2))
    assert key(run_contracts_once(tables, tests, f"{scratch}/b", weak)) == lazy
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert key(run_contracts_once(empty, tests, f"{scratch}/c")) == key(run_contracts(empty, tests))


def test_each_view_is_evaluated_once(spark, scratch):
    """A column that counts its evaluations: one for each row, whatever the number of tests."""
    from pyspark.sql import functions as F

    from lakeward.operators.contract_runs import run_contracts_once

    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v

    view = spark.range(50).select(F.udf(count, "long")("id").alias("id"), (F.col("id") % 3).cast("string").alias("g"))
    tests = [not_null("v", "id"), unique("v", "id"), accepted_values("v", "g", ["0", "1"]),
             unique_combination("v", ["id", "g"]), relationships("v", "id", "v", "id")]
    out = {r.test: r.failures for r in run_contracts_once({"v": view}, tests, scratch).collect()}
    assert out == {"not_null": 0, "unique": 0, "accepted_values": 1, "unique_combination_of_columns": 0, "relationships": 0}
    assert seen.value == 50


def test_keys_are_looked_at_by_their_hashes(spark):
    from lakeward.operators.contract_runs import repeated_hashes

    df = spark.createDataFrame([("a", "b"), ("a", "b")], "x string, y string")
    plan = repeated_hashes(df, ["x", "y"], False)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange" in line]
    assert "Expand" not in plan and shuffled and not any("x#" in line or "y#" in line for line in shuffled)
