"""Registered queries vs their DuckDB oracle SQL on the smallest driver tables.

One query per operator group by default; ``LAKEWARD_FULL_ORACLE=1`` checks
every registered query (``tools/oracle_check.py`` does the same at any SF).
"""

import os

import pytest

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
DEFAULT = [
    "stg_erp__order_details", "int_customers", "int_employees", "int_orders", "int_pii_vault_employees",
    "az_addresses", "az_order_details", "az_orders", "landing_merge_order_headers", "landing_reload_customers",
    "cdc_change_feed_order_details", "cdc_change_counts", "cdc_idempotent_rerun_customers",
    "cdc_schema_sync_products", "dedupe_latest_events", "contract_report", "freshness_report",
    "vault_lookup_hash", "vault_cross_verify", "audit_batches",
]


def _names():
    from lakeward.plans.queries import build_queries
    return list(build_queries()) if os.environ.get("LAKEWARD_FULL_ORACLE") else DEFAULT


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as se
    from tools.oracle_check import digest
    df = se.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(ocols, orows)


def test_every_query_has_an_oracle():
    import __spark_entry__ as se
    from lakeward.plans.queries import build_queries
    assert set(build_queries()) <= set(se.oracle_sql()) <= set(se.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as se
    df = se.entry(spark)
    assert df.count() > 0
    assert "line_total_net" in df.columns
