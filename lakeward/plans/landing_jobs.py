"""The seven landing extracts: operational tables -> one row per raw key.

Each extract renames the operational columns to the raw names and computes
the entity's ``_raw_hash`` with its own fingerprint recipe; the generic
landing operators then stamp and merge it.  ``ops`` maps operational table
names to DataFrames (see :mod:`lakeward.sources.standin`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.hashing import row_fingerprint
from lakeward.functions.text import concat_strict
from lakeward.operators.joins import left_join_split_nulls
from lakeward.sources.schemas import ENTITIES, RAW_HASH

Ops = Mapping[str, DataFrame]


def _fp(entity: str, cols) -> F.Column:
    return row_fingerprint(cols, ENTITIES[entity].fingerprint_encoding).alias(RAW_HASH)


def customers_extract(ops: Ops) -> DataFrame:
    """Customer LEFT JOIN Person LEFT JOIN EmailAddress LEFT JOIN PersonPhone.

    The three person-side tables share one key, so they are joined first
    (co-partitioned, one shuffle each) and the customer is joined to the
    result; the null-rejecting ON clauses make this the same as the
    left-deep chain.  Customers without a person (stores) are spread over all tasks.
    A person with several e-mails or phones fans out; the landing's key
    check then refuses the load.
    """
    person = (
        ops["person"]
        .join(ops["email_address"], "BusinessEntityID", "left")
        .join(ops["person_phone"], "BusinessEntityID", "left")
    )
    c = ops["customer"]
    joined = left_join_split_nulls(c, person, "PersonID", "BusinessEntityID", spread_by="CustomerID")
    full_name = concat_strict("FirstName", F.lit(" "), "LastName")
    return joined.select(
        F.col("CustomerID").alias("customer_id"),
        F.col("PersonID").alias("person_id"),
        F.col("StoreID").alias("store_id"),
        F.col("TerritoryID").alias("territory_id"),
        F.col("AccountNumber").alias("account_number"),
        # stored as 'Unknown' when absent, fingerprinted as ''
        F.coalesce(full_name, F.lit("Unknown")).alias("name"),
        F.col("EmailAddress").alias("email_address"),
        F.col("PhoneNumber").alias("phone"),
        _fp("customers", ["CustomerID", "AccountNumber", full_name, "EmailAddress", "PhoneNumber"]),
    )


def addresses_extract(ops: Ops) -> DataFrame:
    """Address LEFT JOIN customer links LEFT JOIN StateProvince LEFT JOIN CountryRegion.

    Only links whose entity is a customer count (``IN (SELECT CustomerID
    ...)`` inside the ON clause), written as a semi join that filters the
    link table before the outer join.  How the two geography tables are joined is
    left to their measured sizes at run time (AQE).
    """
    customers = ops["customer"].select(F.col("CustomerID").alias("BusinessEntityID"))
    links = ops["business_entity_address"].join(customers, "BusinessEntityID", "left_semi")
    joined = (
        ops["address"]
        .join(links, "AddressID", "left")
        .join(ops["state_province"], "StateProvinceID", "left")
        .join(ops["country_region"], "CountryRegionCode", "left")
    )
    return joined.select(
        F.col("AddressID").alias("address_id"),
        F.col("BusinessEntityID").alias("customer_id"),
        F.col("AddressLine1").alias("address_line1"),
        F.col("AddressLine2").alias("address_line2"),
        F.col("City").alias("city"),
        F.col("StateProvinceID").alias("state_province_id"),
        F.col("PostalCode").alias("postal_code"),
        F.col("Name").alias("country_region"),
        _fp("addresses", ["AddressID", "AddressLine1", "City", "PostalCode"]),
    )


def order_headers_extract(ops: Ops) -> DataFrame:
    h = ops["sales_order_header"]
    return h.select(
        F.col("SalesOrderID").alias("sales_order_id"),
        F.col("RevisionNumber").alias("revision_number"),
        F.col("OrderDate").alias("order_date"),
        F.col("DueDate").alias("due_date"),
        F.col("ShipDate").alias("ship_date"),
        F.col("Status").alias("status"),
        F.col("OnlineOrderFlag").alias("online_order_flag"),
        F.col("SalesOrderNumber").alias("sales_order_number"),
        F.col("PurchaseOrderNumber").alias("purchase_order_number"),
        F.col("AccountNumber").alias("account_number"),
        F.col("CustomerID").alias("customer_id"),
        F.col("SalesPersonID").alias("sales_person_id"),
        F.col("TerritoryID").alias("territory_id"),
        F.col("SubTotal").alias("sub_total"),
        F.col("TaxAmt").alias("tax_amt"),
        F.col("Freight").alias("freight"),
        F.col("TotalDue").alias("total_due"),
        _fp("order_headers", ["SalesOrderID", "RevisionNumber", "Status", "TotalDue"]),
    )


def order_details_extract(ops: Ops) -> DataFrame:
    d = ops["sales_order_detail"]
    return d.select(
        F.col("SalesOrderID").alias("sales_order_id"),
        F.col("SalesOrderDetailID").alias("sales_order_detail_id"),
        F.col("CarrierTrackingNumber").alias("carrier_tracking_number"),
        F.col("OrderQty").alias("order_qty"),
        F.col("ProductID").alias("product_id"),
        F.col("SpecialOfferID").alias("special_offer_id"),
        F.col("UnitPrice").alias("unit_price"),
        F.col("UnitPriceDiscount").alias("unit_price_discount"),
        F.col("LineTotal").alias("line_total"),
        _fp("order_details", ["SalesOrderID", "SalesOrderDetailID", "OrderQty", "LineTotal"]),
    )


def products_extract(ops: Ops) -> DataFrame:
    p = ops["product"]
    return p.select(
        F.col("ProductID").alias("product_id"),
        F.col("ProductNumber").alias("product_number"),
        F.col("Name").alias("product_name"),
        F.col("StandardCost").alias("standard_cost"),
        F.col("ListPrice").alias("list_price"),
        F.col("FinishedGoodsFlag").alias("finished_goods_flag"),
        F.col("Color").alias("color"),
        F.col("SafetyStockLevel").alias("safety_stock_level"),
        F.col("ReorderPoint").alias("reorder_point"),
        F.col("Size").alias("size"),
        F.col("Weight").alias("weight"),
        _fp("products", ["ProductID", "ProductNumber", "Name", "StandardCost", "ListPrice"]),
    )


def employees_extract(ops: Ops) -> DataFrame:
    e = ops["employee"]
    return e.select(
        F.col("BusinessEntityID").alias("business_entity_id"),
        F.col("NationalIDNumber").alias("national_id_number"),
        F.col("LoginID").alias("login_id"),
        F.col("JobTitle").alias("job_title"),
        F.col("BirthDate").alias("birth_date"),
        F.col("MaritalStatus").alias("marital_status"),
        F.col("Gender").alias("gender"),
        F.col("HireDate").alias("hire_date"),
        F.col("SalariedFlag").alias("salaried_flag"),
        F.col("VacationHours").alias("vacation_hours"),
        F.col("SickLeaveHours").alias("sick_leave_hours"),
        _fp("employees", ["BusinessEntityID", "NationalIDNumber", "JobTitle", "HireDate"]),
    )


def departments_extract(ops: Ops) -> DataFrame:
    d = ops["department"]
    return d.select(
        F.col("DepartmentID").alias("department_id"),
        F.col("Name").alias("name"),
        F.col("GroupName").alias("group_name"),
        _fp("departments", ["DepartmentID", "Name", "GroupName"]),
    )


EXTRACTS: dict[str, Callable[[Ops], DataFrame]] = {
    "customers": customers_extract,
    "addresses": addresses_extract,
    "order_headers": order_headers_extract,
    "order_details": order_details_extract,
    "products": products_extract,
    "employees": employees_extract,
    "departments": departments_extract,
}

#: Entities whose fingerprint covers their extract's columns as they are (a customer's covers a name that is stored otherwise).
PRINTED_LATER = ("addresses", "order_headers", "order_details", "products", "employees", "departments")


def unprinted(entity: str, extract: DataFrame) -> DataFrame:
    """An extract without its fingerprint, where landing makes the same one later.

    A fingerprint is 64 random hex digits, the widest value of most rows; made
    after the rows were shuffled, it is not shuffled with them.
    """
    return extract.drop(RAW_HASH) if entity in PRINTED_LATER else extract
