"""What contracts leave on disk while they run: one large table's job at a time, order lines numbered once."""

import time
from threading import Lock

from lakeward.operators import contract_runs
from lakeward.operators.contracts import not_null, relationships, unique, unique_combination
from lakeward.plans import queries
from lakeward.plans.pipeline import TwoDayPipeline
from lakeward.session import SHUFFLE_CLEANUP
from test_shuffled_bytes import _Lines, _plan


def _observed_runs(spark, scratch, monkeypatch, large):
    """Most jobs under way at a time, the settings they saw and the result."""
    state, lock, write = {"now": 0, "most": 0, "cleaned": set()}, Lock(), contract_runs.write_tested

    def counted(*args):
        with lock:
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
            state["cleaned"].add(spark.conf.get(SHUFFLE_CLEANUP))
        time.sleep(0.3)
        try:
            return write(*args)
        finally:
            with lock:
                state["now"] -= 1

    monkeypatch.setattr(contract_runs, "write_tested", counted)
    monkeypatch.setattr(contract_runs, "LARGE_BYTES", large)
    tables = {n: spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string") for n in ("t", "u", "w")}
    tests = [t for n in tables for t in (not_null(n, "v"), unique(n, "k"))] + [relationships("t", "k", "u", "k")]
    result = contract_runs.run_contracts_once(tables, tests, f"{scratch}/{large}")
    return state["most"], state["cleaned"], sorted(map(tuple, result.collect()))


def test_large_tables_are_written_one_at_a_time(spark, scratch, monkeypatch):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    most, cleaned, rows = _observed_runs(spark, scratch, monkeypatch, -1)
    assert most == 1 and cleaned == {"true"} and spark.conf.get(SHUFFLE_CLEANUP) == before
    assert [r[4] for r in rows] == [0, 1, 1, 1, 1, 1, 1]
    monkeypatch.undo()
    most, cleaned, small = _observed_runs(spark, scratch, monkeypatch, 1 << 40)
    assert most > 1 and cleaned == {"true"} and small == rows


def test_lines_are_numbered_once_for_several_tested_tables(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(queries, "_number_lines", lambda p: asked.append(p))
    monkeypatch.setattr(queries, "_tables_for", lambda p, tests: {})
    monkeypatch.setattr(queries, "run_contracts_once", lambda tables, tests, folder: tests)
    p = TwoDayPipeline(spark, "none")
    key = ["sales_order_id", "sales_order_detail_id"]
    one = [unique_combination("az_order_details", key), not_null("az_products", "product_id")]
    assert queries._contracts(p, one) == one and not asked
    queries._contracts(p, [*one, not_null("int_orders", "status")])
    assert asked == [p]


def test_written_lines_are_dealt_by_their_order_once(spark, scratch):
    p = _Lines(spark)
    ops = p.today_ops

    class Written(TwoDayPipeline):
        today_ops = ops

    q = Written(spark, "none")
    as_numbered = p.run(2).ref("stg_erp__order_details").orderBy("sales_order_id", "sales_order_detail_id").collect()
    q.write_source("sales_order_detail", scratch)
    staged = q.run(2).ref("stg_erp__order_details")
    plan = _plan(staged)
    assert plan.count("Exchange hashpartitioning(sales_order_id") == 1 and plan.count("Exchange") == 1
    assert staged.orderBy("sales_order_id", "sales_order_detail_id").collect() == as_numbered
