"""What order lines carry through shuffles, and what contracts write."""

import os
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import functions as F

from lakeward.operators import declared
from lakeward.operators.contract_runs import run_contracts_once, write_tested
from lakeward.operators.contracts import not_null, unique
from lakeward.operators.landing import LoadStamp, landing_merge_feed, stamp
from lakeward.operators.table_store import SHUFFLE_CLEANUP, TableStore
from lakeward.plans import queries
from lakeward.plans.landing_jobs import PRINTED_LATER, unprinted
from lakeward.plans.pipeline import TwoDayPipeline
from lakeward.sources.schemas import ENTITIES, IS_DELETED, RAW_HASH

LINES = [(o, p, 1, n, 2.0, 10.5 * n, 0.05, 0.01, "N", "O", date(1996, 1, n)) for o, p, n in ((1, 7, 1), (1, 8, 2), (1, 8, 2), (2, 9, 1))]
LINE_SCHEMA = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
               "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


class _Lines(TwoDayPipeline):
    """A pipeline that has order lines only."""

    def __init__(self, spark):
        super().__init__(spark, "none")
        self.lines = spark.createDataFrame(LINES, LINE_SCHEMA)

    @property
    def today_ops(self):
        from lakeward.sources.standin import sales_order_detail

        return {"sales_order_detail": sales_order_detail(lambda name: self.lines)}

    @property
    def yesterday_ops(self):
        from lakeward.sources.scenario import MUTATIONS, yesterday_table

        return {"sales_order_detail": yesterday_table(self.today_ops["sales_order_detail"], MUTATIONS["order_details"], self.rates)}


def test_lines_are_dealt_before_they_are_printed_and_published_with_three_exchanges(spark):
    p = _Lines(spark)
    published = p.run(2).ref("az_order_details")
    plan = _plan(published).splitlines()
    exchanges = [i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert len([i for i in exchanges if "l_orderkey" not in plan[i] and "SalesOrderID" not in plan[i]]) == 2
    below = "\n".join(plan[exchanges[0]:])
    assert "sha2" not in below.split("Exchange", 1)[1].split("Window")[0]
    keys = {(r.sales_order_id, r.sales_order_detail_id) for r in published.collect()}
    assert keys <= {(1, 1), (1, 2), (1, 3), (2, 1)}


def test_lines_by_order_need_the_exchange_of_their_numbering_alone(spark):
    plan = _plan(_Lines(spark).run(2).ref("stg_erp__order_details"))
    assert plan.count("Exchange hashpartitioning") == 1


def test_loads_of_lines_read_them_numbered(spark, monkeypatch):
    class Source(TwoDayPipeline):
        yesterday_ops = cached_property(_Lines.yesterday_ops.fget)

    p, plans, load = Source(spark, "none"), [], declared.load
    p.today_ops = _Lines(spark).today_ops

    def seen(rows, *rest):
        plans.append(_plan(rows))
        return load(rows, *rest)

    monkeypatch.setattr(queries, "_pipe", lambda *_: p)
    monkeypatch.setattr(declared, "load", seen)
    rows = queries.build_queries()["append_history_order_details"](spark, "none")
    assert len(plans) == 3 and not any("Exchange" in plan for plan in plans)
    second = rows.where(F.dayofmonth("_load_dt") == 2).select("sales_order_id", "sales_order_detail_id", "product_id").collect()
    assert sorted(map(tuple, second)) == [(1, 1, 7), (1, 2, 8), (1, 3, 8), (2, 1, 9)]


def test_late_fingerprints_are_those_of_the_extracts(spark):
    p = _Lines(spark)
    extract, spec = p.extract("order_details", 2), ENTITIES["order_details"]
    load = LoadStamp("b", datetime(2024, 1, 1))
    early, late = (stamp(rows, spec, load).orderBy(*spec.key).collect() for rows in (extract, unprinted("order_details", extract)))
    assert early == late and "customers" not in PRINTED_LATER


def test_gone_rows_are_flagged_without_shuffling_the_state(spark):
    spec, load = ENTITIES["departments"], LoadStamp("b2", datetime(2024, 1, 2))
    rows = lambda *r: spark.createDataFrame(list(r), "department_id short, name string, group_name string")
    current = stamp(rows((1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, "d", "x")), spec, LoadStamp("b1", datetime(2024, 1, 1)))
    source = rows((1, "a", "x"), (2, "new", "x"), (4, "d", "x"), (5, "e", "x"), (6, "f", "x"))
    gone = spark.createDataFrame([(1,), (2,), (3,), (5,)], "department_id short")
    feed = landing_merge_feed(current, source, spec, load, gone=gone)
    found = {r.department_id: (r["_change_type"], r[IS_DELETED]) for r in feed.collect()}
    assert found == {1: ("unchanged", True), 2: ("update", True), 3: ("kept", True), 4: ("unchanged", False),
                     5: ("insert", True), 6: ("insert", False)}
    plan = _plan(feed)  # the full outer join is above the joins with what is gone
    assert plan.index("FullOuter") < plan.index("LeftOuter")


def test_laid_rows_are_published_without_an_exchange_and_settings_are_put_back(spark, scratch):
    store = TableStore(spark, scratch, buckets=4, prefix="lean_")
    before = spark.conf.get(SHUFFLE_CLEANUP)
    rows = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    printed = lambda df: df.withColumn(RAW_HASH, F.sha2(F.col("v").cast("string"), 256))
    assert store.replace("raw", "t", rows, ["k"], finish=printed) == 40
    landed = store.current("raw", "t")
    assert landed.columns == ["k", "v", RAW_HASH]
    assert store.replace("az", "t", landed, ["k"], validate_keys=False, laid=True) == 40
    assert store.current("az", "t").orderBy("k").collect() == landed.orderBy("k").collect()
    assert store.digests("az", "t") == store.digests("raw", "t")
    assert spark.conf.get(SHUFFLE_CLEANUP) == before


def test_contracts_write_only_what_is_read_again(spark, scratch):
    df = spark.createDataFrame([(1, None, "x"), (1, "a", None), (2, "b", "z")], "k int, a string, b string")
    rows, failures = write_tested(df, f"{scratch}/none", [not_null("t", "a"), not_null("t", "b")], [])
    assert failures == [1, 1] and not os.path.exists(f"{scratch}/none")
    tests = [not_null("t", "a"), not_null("t", "b"), unique("t", "k")]
    result = run_contracts_once({"t": df}, tests, f"{scratch}/some")
    assert {(r.column_name, r.test): r.failures for r in result.collect()} == {("a", "not_null"): 1, ("b", "not_null"): 1, ("k", "unique"): 1}
    assert spark.read.parquet(f"{scratch}/some/t0").columns == ["k"]
