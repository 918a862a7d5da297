"""The append layout: four landed tables that keep every load.

Extracts have no fingerprint and nothing is merged; a load adds its rows, with
its time and date, to those of the loads before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.text import concat_strict
from lakeward.operators.declared import DeclaredColumn, DeclaredTable
from lakeward.operators.joins import left_join_split_nulls
from lakeward.plans.landing_jobs import order_details_extract, order_headers_extract, products_extract

Ops = Mapping[str, DataFrame]


def _table(name: str, system: str, keys: tuple[str, ...], /, **types: str) -> DeclaredTable:
    payload = tuple(DeclaredColumn(c, t, required=c in keys) for c, t in types.items())
    return DeclaredTable(name, (*payload, DeclaredColumn("_source_system", "VARCHAR(50)", True, f"'{system}'"),
                                DeclaredColumn("_is_active", "BOOLEAN", True, "true")))


# Names, types and widths of the landed columns.
APPEND_TABLES = {
    "customers": _table(
        "customers", "CRM", ("customer_id",),
        customer_id="INT", person_id="INT", store_id="INT", territory_id="INT", account_number="VARCHAR(10)",
        name="VARCHAR(255)", email_address="VARCHAR(50)", phone="VARCHAR(25)", website="VARCHAR(255)",
        annual_income="VARCHAR(100)"),
    "order_headers": _table(
        "order_headers", "ERP", ("sales_order_id",),
        sales_order_id="INT", revision_number="SMALLINT", order_date="TIMESTAMP_NTZ", due_date="TIMESTAMP_NTZ",
        ship_date="TIMESTAMP_NTZ", status="SMALLINT", customer_id="INT", sales_person_id="INT", territory_id="INT",
        sub_total="DECIMAL(19,4)", tax_amt="DECIMAL(19,4)", freight="DECIMAL(19,4)", total_due="DECIMAL(19,4)"),
    "order_details": _table(
        "order_details", "ERP", ("sales_order_id", "sales_order_detail_id"),
        sales_order_id="INT", sales_order_detail_id="INT", order_qty="SMALLINT", product_id="INT",
        unit_price="DECIMAL(19,4)", unit_price_discount="DECIMAL(19,4)", line_total="DECIMAL(19,4)"),
    "products": _table(
        "products", "ERP", ("product_id",),
        product_id="INT", product_name="VARCHAR(50)", standard_cost="DECIMAL(19,4)", list_price="DECIMAL(19,4)",
        size="VARCHAR(50)", weight="DECIMAL(8,2)"),
}


def customers_append_extract(ops: Ops) -> DataFrame:
    """Customer with four left joins: person, e-mail, phone and demographics.

    The four person-side tables share one key and are joined first; customers
    without a person are spread over all tasks.  Several e-mails or phones of a
    person give several rows, which the append layout keeps.
    """
    person = ops["person"]
    for table in ("email_address", "person_phone", "person_demographics"):
        person = person.join(ops[table], "BusinessEntityID", "left")
    joined = left_join_split_nulls(ops["customer"], person, "PersonID", "BusinessEntityID", spread_by="CustomerID")
    return joined.select(
        F.col("CustomerID").alias("customer_id"),
        F.col("PersonID").alias("person_id"),
        F.col("StoreID").alias("store_id"),
        F.col("TerritoryID").alias("territory_id"),
        F.col("AccountNumber").alias("account_number"),
        F.coalesce(concat_strict("FirstName", F.lit(" "), "LastName"), F.lit("Unknown")).alias("name"),
        F.col("EmailAddress").alias("email_address"),
        F.col("PhoneNumber").alias("phone"),
        F.col("Website").alias("website"),
        F.col("YearlyIncome").alias("annual_income"),
    )


def _of(extract: Callable[[Ops], DataFrame], table: str) -> Callable[[Ops], DataFrame]:
    kept = [c.name for c in APPEND_TABLES[table].columns if not c.name.startswith("_")]
    return lambda ops: extract(ops).select(*kept)


APPEND_EXTRACTS: dict[str, Callable[[Ops], DataFrame]] = {
    "customers": customers_append_extract,
    "order_headers": _of(order_headers_extract, "order_headers"),
    "order_details": _of(order_details_extract, "order_details"),
    "products": _of(products_extract, "products"),
}
