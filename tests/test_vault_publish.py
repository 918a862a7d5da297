from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeward.functions import pii_hash
from lakeward.operators.audit import batch_audit, load_summary
from lakeward.operators.publish import leak_check, pii_columns
from lakeward.operators.table_store import TableStore
from lakeward.operators.vault import cross_verify, lookup, lookup_by_clear_value
from lakeward.plans.models import MODELS
from lakeward.plans.runner import select_models


@pytest.fixture
def vault(spark):
    df = spark.createDataFrame([("k1", "a@x"), ("k2", None), ("k3", "")], "sk string, email string")
    return df.withColumn("email_hash", pii_hash("email"))


def test_lookups(spark, vault):
    assert [r.email for r in lookup(vault, "sk", "k1", ["email"]).collect()] == ["a@x"]
    assert [r.sk for r in lookup_by_clear_value(vault, "email_hash", "a@x", ["sk"]).collect()] == ["k1"]
    with pytest.raises(ValueError):
        lookup_by_clear_value(vault, "email_hash", "", ["sk"])


def test_cross_verify_counts_mismatches(spark, vault):
    published = vault.withColumn("email_hash", F.when(F.col("sk") == "k3", "BAD").otherwise(F.col("email_hash")))
    r = cross_verify(vault, published, "sk", ["email_hash"]).first()
    assert (r.hash_column, r.compared, r.mismatches) == ("email_hash", 3, 1)


def test_audits(spark):
    t = datetime(2024, 1, 1)
    a = spark.createDataFrame([("customers", t, "b1")] * 3, "_source_entity string, _ingested_at timestamp_ntz, _batch_id string")
    b = spark.createDataFrame([("orders", t, "b2"), ("orders", t, "b3")], a.schema)
    assert [(r.table, r.row_count) for r in load_summary({"z": a, "y": b}).collect()] == [("y", 2), ("z", 3)]
    got = {r._source_entity: (r.rows, r.batches) for r in batch_audit({"a": a, "b": b}).collect()}
    assert got == {"customers": (3, 1), "orders": (2, 2)}


def test_selection():
    assert select_models(["+az_orders"])[-1] == "az_orders"
    assert "int_orders" in select_models(["+az_orders"])
    down = select_models(["stg_hr__employees+"], exclude_tags=())
    assert {"int_employees", "az_employees", "int_pii_vault_employees"} <= set(down)
    assert "int_pii_vault_employees" not in select_models(["stg_hr__employees+"], exclude_tags=["local_only"])
    assert set(select_models(["tag:pii_vault"], exclude_tags=())) == {"int_pii_vault_customers",
                                                                        "int_pii_vault_employees"}
    assert len(select_models(["staging"])) == 7
    assert len(select_models()) == 20
    assert len(select_models(exclude_tags=["local_only"])) == 18  # minus the two vaults


def test_leak_check(spark):
    pii = pii_columns(MODELS)
    assert {"email_address", "national_id_number", "birth_date"} <= pii
    ok = spark.createDataFrame([(1, "h")], "customer_id int, email_address_hash string")
    bad = spark.createDataFrame([(1, "x@y")], "customer_id int, email_address string")
    assert leak_check({"ok": ok, "bad": bad}, pii) == [("bad", "email_address")]


def test_model_metadata_and_never_export(spark, scratch):
    from lakeward.plans.runner import run_project
    assert MODELS["az_customers"].pii_vault == "int_pii_vault_customers"
    assert MODELS["az_orders"].contract_status == "visado" and MODELS["az_orders"].pii_free
    vault = MODELS["int_pii_vault_employees"]
    assert vault.access == "restricted" and vault.never_export and "local_only" in vault.tags
    store = TableStore(spark, scratch)
    with pytest.raises(ValueError, match="never_export"):
        run_project(store, lambda e: None, datetime(2024, 1, 1), select=["int_pii_vault_customers"],
                    exclude_tags=())
