from datetime import datetime

import pytest

from lakeward.operators.audit import tables_per_layer
from lakeward.operators.contracts import accepted_values, run_contracts
from lakeward.operators.landing import LoadStamp, landing_reload
from lakeward.operators.publish import schema_name, table_path
from lakeward.plans.models import MODELS
from lakeward.sources.readers import raw_path, read_raw
from lakeward.sources.schemas import DEPARTMENTS


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc", "csv"])
def test_read_raw_any_format_with_declared_schema(spark, scratch, fmt):
    src = spark.createDataFrame([(1, "Sales", "Ops")], "department_id short, name string, group_name string")
    raw = landing_reload(src, DEPARTMENTS, LoadStamp("b", datetime(2024, 1, 1)))
    path = raw_path(scratch, DEPARTMENTS)
    opts = {"header": "true"} if fmt == "csv" else {}
    raw.write.format(fmt).options(**opts).save(path)
    back = read_raw(spark, path, DEPARTMENTS, fmt, **opts)
    assert [f.dataType for f in back.schema.fields] == [f.dataType for f in DEPARTMENTS.raw_schema.fields]
    r = back.first()
    assert (r.department_id, r.name, r._source_entity, r._is_deleted) == (1, "Sales", "departments", False)
    assert path.endswith("raw_hr/departments")


def test_layer_naming():
    assert schema_name(None, "dbo") == "dbo"
    assert schema_name(" staging ", "dbo") == "staging"
    assert table_path("/lake/", "azure_fabric", "az_orders") == "/lake/azure_fabric/az_orders"


def test_tables_per_layer():
    assert tables_per_layer(MODELS) == [("certified", 8), ("intermediate", 5), ("staging", 7)]


def test_case_insensitive_accepted_values(spark):
    df = spark.createDataFrame([("M",), ("m ",), ("s",), ("X",), (None,)], "g string")
    strict = accepted_values("t", "g", ["M", "S"])
    loose = accepted_values("t", "g", ["M", "S"], case_insensitive=True)
    got = {r.failures for r in run_contracts({"t": df}, [strict]).collect()}
    assert got == {3}  # 'm ', 's', 'X'
    got = {r.failures for r in run_contracts({"t": df}, [loose]).collect()}
    assert got == {1}  # only 'X'


def test_drifted_files_raise(spark, scratch):
    from lakeward.sources.readers import SchemaDriftError

    src = spark.createDataFrame([(1, "Sales", "Ops")], "department_id short, name string, group_name string")
    raw = landing_reload(src, DEPARTMENTS, LoadStamp("b", datetime(2024, 1, 1)))
    raw.drop("_is_deleted").write.parquet(f"{scratch}/less")
    with pytest.raises(SchemaDriftError, match="_is_deleted: absent"):
        read_raw(spark, f"{scratch}/less", DEPARTMENTS)
    raw.withColumn("department_id", raw["department_id"].cast("string")).write.parquet(f"{scratch}/other")
    with pytest.raises(SchemaDriftError, match="department_id: string"):
        read_raw(spark, f"{scratch}/other", DEPARTMENTS)
    raw.selectExpr("'abc' as department_id", *raw.columns[1:]).write.csv(f"{scratch}/csv", header=True)
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        read_raw(spark, f"{scratch}/csv", DEPARTMENTS, "csv", header="true").collect()


def test_selectors():
    from lakeward.plans.runner import select_models

    assert select_models(["azure_fabric"]) == select_models(["certified"])
    both = select_models(["+int_orders+"])
    assert {"stg_erp__order_headers", "int_customers", "int_orders", "az_orders"} <= set(both)
    assert set(both) == set(select_models(["+int_orders"])) | set(select_models(["int_orders+"]))
    for unknown in ("tag:none", "nothing", "+nothing+"):
        with pytest.raises(KeyError):
            select_models([unknown])
