from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeward.operators.dedupe import dedupe_latest
from lakeward.operators.landing import LoadStamp, landing_reload
from lakeward.operators.staging import stage
from lakeward.sources.schemas import ORDER_HEADERS, PRODUCTS

RUN = datetime(2024, 1, 2, 1)


def product_rows(spark, rows):
    return spark.createDataFrame(rows, "product_id int, product_number string, product_name string, "
                                       "standard_cost decimal(19,4), list_price decimal(19,4), "
                                       "finished_goods_flag boolean, color string, safety_stock_level short, "
                                       "reorder_point short, size string, weight decimal(8,2)")


def test_stage_filters_deleted_and_null_flag_and_clips(spark):
    raw = landing_reload(product_rows(spark, [
        (1, "P1", "A", None, None, True, "red", 1, 1, "EXTRA-LARGE-XL", None),
        (2, "P2", "B", None, None, True, "red", 1, 1, "S", None),
        (3, "P3", "C", None, None, True, "red", 1, 1, "M", None),
    ]), PRODUCTS, LoadStamp("b", datetime(2024, 1, 1)))
    raw = raw.withColumn("_is_deleted", F.when(F.col("product_id") == 2, True)
                         .when(F.col("product_id") == 3, None).otherwise(False))
    out = stage(raw, PRODUCTS, RUN).collect()
    assert [(r.product_id, r.size, r._dbt_loaded_at) for r in out] == [(1, "EXTRA-LARG", RUN)]


def test_tinyint_and_overflow(spark):
    src = spark.createDataFrame(
        [(1, 200, datetime(2024, 1, 1), 5)],
        "sales_order_id int, revision_number int, order_date timestamp_ntz, status int")
    for c in ORDER_HEADERS.payload:
        if c not in src.columns:
            src = src.withColumn(c, F.lit(None))
    raw = landing_reload(src, ORDER_HEADERS, LoadStamp("b", datetime(2024, 1, 1)))
    r = stage(raw, ORDER_HEADERS, RUN).first()
    assert r.revision_number == 200 and r.order_date == date(2024, 1, 1)
    big = spark.createDataFrame([(70000,)], "v int").select(F.col("v").cast("smallint"))
    with pytest.raises(Exception):
        big.collect()


def test_dedupe_latest_tiebreak_is_deterministic(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, 10), (1, t, 11), (1, datetime(2023, 1, 1), 12), (2, t, 20)],
                               "k int, ts timestamp_ntz, id int")
    out = dedupe_latest(df, ["k"], order_by=["ts"], tiebreak=["id"])
    assert sorted((r.k, r.id) for r in out.collect()) == [(1, 11), (2, 20)]


def test_dedupe_plans_partial_group_limit_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
        plan = dedupe_latest(df, ["k"], order_by=["ts"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.index("Exchange") < plan.rindex("Partial")
