"""Two runs of the whole project on the smallest driver tables, on written tables."""

from datetime import datetime
from uuid import uuid4

from pyspark.sql import functions as F

from lakeward.operators.landing import LoadStamp, landing_reload
from lakeward.operators.table_store import TableStore
from lakeward.plans.pipeline import RUN_TS, TwoDayPipeline, load_stamp
from lakeward.plans.runner import run_project, schema_of
from lakeward.sources.schemas import ENTITIES

SF = "/root/testdata/sf0.001"


def store_in(spark, folder, buckets=4):
    return TableStore(spark, folder, buckets, prefix=f"t{uuid4().hex[:8]}_")


def test_two_runs_publish_and_preserve_unchanged_rows(spark, scratch):
    store = store_in(spark, scratch)
    p = TwoDayPipeline(spark, SF)
    raw = lambda e: store.current("raw", e)
    for e, spec in ENTITIES.items():
        store.replace("raw", e, landing_reload(p.extract(e, 1), spec, load_stamp(e, 1)), spec.key)
    first = run_project(store, raw, RUN_TS[1])
    assert set(first) == {"az_customers", "az_addresses", "az_order_headers", "az_order_details",
                          "az_products", "az_employees", "az_departments", "az_orders"}
    assert all(set(counts) == {"insert"} and counts["insert"] > 0 for counts in first.values())
    for e, spec in ENTITIES.items():
        store.replace("raw", e, p.raw(e, 2), spec.key)
    second = run_project(store, raw, RUN_TS[2])
    for name in ("az_customers", "az_order_details"):
        got, expected = store.current("azure_fabric", name), p.run(2).ref(name)
        assert got.count() == expected.count()
        assert got.exceptAll(expected.select(*got.columns)).count() == 0
        stamps = {r._dbt_loaded_at: r["count"] for r in got.groupBy("_dbt_loaded_at").count().collect()}
        assert set(stamps) == set(RUN_TS.values())  # unchanged rows keep the first run's stamp
        assert stamps[RUN_TS[2]] == second[name]["insert"] + second[name]["update"]
        assert second[name]["delete"] == first[name]["insert"] + second[name]["insert"] - got.count()
    assert schema_of("stg_crm__customers") == "staging" and schema_of("int_orders") == "intermediate"
    # a third run finds nothing to do in the incremental tables
    third = run_project(store, raw, datetime(2024, 1, 3))
    assert [n for n, counts in third.items() if counts] == ["az_orders"]


def test_full_refresh_rebuilds_and_incremental_keeps(spark, scratch):
    store = store_in(spark, scratch)
    src = spark.createDataFrame([(1, "Sales", "Ops"), (2, "HR", "Admin")],
                                "department_id short, name string, group_name string")
    spec = ENTITIES["departments"]
    store.replace("raw", "departments", landing_reload(src, spec, LoadStamp("b1", datetime(2024, 1, 1))), spec.key)
    raw = lambda e: store.current("raw", e)
    current = lambda: store.current("azure_fabric", "az_departments")
    t1, t2, t3 = datetime(2024, 1, 1, 1), datetime(2024, 1, 2, 1), datetime(2024, 1, 3, 1)
    assert run_project(store, raw, t1, select=["az_departments"]) == {"az_departments": {"insert": 2}}
    assert run_project(store, raw, t2, select=["az_departments"]) == {"az_departments": {}}   # nothing changed
    assert {r._dbt_loaded_at for r in current().collect()} == {t1}
    run_project(store, raw, t3, select=["az_departments"], full_refresh=True)
    assert {r._dbt_loaded_at for r in current().collect()} == {t3} and current().count() == 2
    assert current().where(F.col("department_name") == "HR").count() == 1
