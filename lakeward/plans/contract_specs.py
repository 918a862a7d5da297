"""The declared data contracts of the pipeline (207 tests).

Fixed values taken from the project's declarations: tested columns, test
kinds, accepted sets and severities.  ``source:`` models are the raw
tables as landed.
"""

from __future__ import annotations

from lakeward.operators.contracts import (
    ContractTest,
    accepted_values,
    expression_is_true,
    not_null,
    relationships,
    unique,
    unique_combination,
)

# Fixed accepted sets.
ORDER_STATUS = (1, 2, 3, 4, 5, 6)
MARITAL_STATUS = ("M", "S")
GENDER = ("M", "F")

SOURCE_CUSTOMERS = "source:raw_crm.customers"
SOURCE_ADDRESSES = "source:raw_crm.addresses"


def _nn(model: str, *cols: str) -> list[ContractTest]:
    return [not_null(model, c) for c in cols]


def _key(model: str, col: str) -> list[ContractTest]:
    return [not_null(model, col), unique(model, col)]


def declared_tests() -> list[ContractTest]:
    t: list[ContractTest] = []
    # sources
    t += _key(SOURCE_CUSTOMERS, "customer_id")
    t += _key(SOURCE_ADDRESSES, "address_id")

    # staging
    m = "stg_crm__customers"
    t += _key(m, "customer_id") + _nn(m, "account_number", "name", "_ingested_at", "_dbt_loaded_at")
    m = "stg_crm__addresses"
    t += _key(m, "address_id") + _nn(m, "customer_id")
    t += [relationships(m, "customer_id", "stg_crm__customers", "customer_id", "warn")]
    t += _nn(m, "address_line1", "city", "_ingested_at", "_dbt_loaded_at")
    m = "stg_erp__order_headers"
    t += _key(m, "sales_order_id") + _nn(m, "customer_id", "order_date", "status")
    t += [accepted_values(m, "status", ORDER_STATUS, "warn")]
    t += _nn(m, "sub_total", "total_due", "_ingested_at", "_dbt_loaded_at")
    m = "stg_erp__order_details"
    t += [unique_combination(m, ["sales_order_id", "sales_order_detail_id"])]
    t += _nn(m, "sales_order_id")
    t += [relationships(m, "sales_order_id", "stg_erp__order_headers", "sales_order_id", "error")]
    t += _nn(m, "sales_order_detail_id", "product_id")
    t += [relationships(m, "product_id", "stg_erp__products", "product_id", "warn")]
    t += _nn(m, "order_qty", "unit_price", "line_total", "_ingested_at", "_dbt_loaded_at")
    m = "stg_erp__products"
    t += _key(m, "product_id") + _nn(m, "product_number", "product_name", "_ingested_at", "_dbt_loaded_at")
    m = "stg_hr__employees"
    t += _key(m, "business_entity_id") + _nn(m, "national_id_number", "job_title")
    t += [accepted_values(m, "marital_status", MARITAL_STATUS, "warn"),
          accepted_values(m, "gender", GENDER, "warn")]
    t += _nn(m, "hire_date", "_ingested_at", "_dbt_loaded_at")
    m = "stg_hr__departments"
    t += _key(m, "department_id") + _nn(m, "name", "group_name", "_ingested_at", "_dbt_loaded_at")

    # intermediate
    m = "int_customers"
    t += _key(m, "customer_sk") + _key(m, "customer_id")
    t += _nn(m, "account_number", "full_name_hash", "email_address_hash", "city", "_ingested_at",
             "_dbt_loaded_at")
    m = "int_employees"
    t += _key(m, "employee_sk") + _key(m, "business_entity_id")
    t += _nn(m, "national_id_hash", "login_id_hash", "birth_date_hash", "job_title", "hire_date")
    t += [accepted_values(m, "marital_status", MARITAL_STATUS, "warn"),
          accepted_values(m, "gender", GENDER, "warn")]
    t += _nn(m, "_ingested_at", "_dbt_loaded_at")
    m = "int_orders"
    t += _nn(m, "sales_order_id", "sales_order_detail_id", "customer_id", "order_date", "status")
    t += [accepted_values(m, "status", ORDER_STATUS, "warn")]
    t += _nn(m, "product_id", "order_qty", "unit_price", "line_total", "_ingested_at", "_dbt_loaded_at")
    m = "int_pii_vault_customers"
    t += _key(m, "customer_sk") + _key(m, "customer_id") + _nn(m, "full_name_hash", "email_address_hash")
    m = "int_pii_vault_employees"
    t += _key(m, "employee_sk") + _key(m, "business_entity_id")
    t += _nn(m, "national_id_hash", "login_id_hash", "birth_date_hash")

    # certified
    m = "az_customers"
    t += _key(m, "customer_sk") + _key(m, "customer_id")
    t += _nn(m, "account_number", "full_name_hash", "email_address_hash", "_ingested_at",
             "_source_system", "_raw_hash", "_dbt_loaded_at")
    m = "az_addresses"
    t += _key(m, "address_id") + _nn(m, "customer_id")
    t += [relationships(m, "customer_id", "az_customers", "customer_id", "warn")]
    t += _nn(m, "customer_sk")
    t += [relationships(m, "customer_sk", "az_customers", "customer_sk", "warn")]
    t += _nn(m, "address_line1_hash", "city", "_ingested_at", "_source_system", "_raw_hash",
             "_dbt_loaded_at")
    m = "az_order_headers"
    t += _key(m, "sales_order_id") + _nn(m, "customer_id")
    t += [relationships(m, "customer_id", "az_customers", "customer_id", "warn"),
          relationships(m, "customer_sk", "az_customers", "customer_sk", "warn")]
    t += _nn(m, "sales_order_number", "order_date", "status")
    t += [accepted_values(m, "status", ORDER_STATUS, "error")]
    t += _nn(m, "sub_total", "total_due", "_ingested_at", "_source_system", "_raw_hash", "_dbt_loaded_at")
    m = "az_order_details"
    t += [unique_combination(m, ["sales_order_id", "sales_order_detail_id"])]
    t += _nn(m, "sales_order_id")
    t += [relationships(m, "sales_order_id", "az_order_headers", "sales_order_id", "error")]
    t += _nn(m, "sales_order_detail_id", "product_id")
    t += [relationships(m, "product_id", "az_products", "product_id", "warn")]
    t += _nn(m, "order_qty", "unit_price", "line_total", "_ingested_at", "_source_system", "_raw_hash",
             "_dbt_loaded_at")
    m = "az_products"
    t += _key(m, "product_id") + _nn(m, "product_number", "product_name", "_ingested_at",
                                     "_source_system", "_raw_hash", "_dbt_loaded_at")
    m = "az_employees"
    t += _key(m, "employee_sk") + _key(m, "business_entity_id")
    t += _nn(m, "national_id_hash", "login_id_hash", "birth_date_hash", "job_title")
    t += [accepted_values(m, "marital_status", MARITAL_STATUS, "warn"),
          accepted_values(m, "gender", GENDER, "warn")]
    t += _nn(m, "hire_date", "_ingested_at", "_source_system", "_dbt_loaded_at")
    m = "az_departments"
    t += _key(m, "department_id") + _nn(m, "department_name", "department_group", "_ingested_at",
                                        "_source_system", "_raw_hash", "_dbt_loaded_at")
    m = "az_orders"
    t += [unique_combination(m, ["sales_order_id", "sales_order_detail_id"])]
    t += _nn(m, "sales_order_id", "sales_order_detail_id", "sales_order_number")
    t += [relationships(m, "customer_sk", "az_customers", "customer_sk", "warn")]
    t += _nn(m, "order_date", "status")
    t += [accepted_values(m, "status", ORDER_STATUS, "error")]
    t += _nn(m, "product_id")
    t += [relationships(m, "product_id", "az_products", "product_id", "warn")]
    t += _nn(m, "order_qty", "unit_price", "line_total", "sub_total", "total_due", "_ingested_at",
             "_source_system", "_dbt_loaded_at")
    return t


def documented_identities() -> list[ContractTest]:
    """Identities the documentation states but no declared test checks."""
    return [
        expression_is_true("stg_erp__order_headers", "total_due_identity",
                           "total_due = sub_total + tax_amt + freight", "warn"),
        expression_is_true("stg_erp__order_details", "line_total_identity",
                           "line_total = order_qty * unit_price * (1 - unit_price_discount)", "warn"),
    ]
