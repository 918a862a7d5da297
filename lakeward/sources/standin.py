"""Operational-source stand-ins built from the driver's TPC-H-style tables.

The pipeline lands seven entities from an operational database
(customers, persons, e-mails, phones, addresses, orders, order lines,
products, employees, departments).  The test environment only ships
TPC-H-style tables, so this module re-shapes them into rows with the
operational column names and types.  It only produces input rows: no
hashing, stamping, deduplication, joining of entities or change detection
happens here — all of that is the library's job downstream.

Mapping (driver table -> operational table):

* ``customer`` -> ``customer``, ``person`` (non-BUILDING segments),
  ``email_address``, ``person_phone`` (non-negative balance only),
  ``address`` (one per customer, a second for AUTOMOBILE),
  ``business_entity_address`` (plus a vendor-contact link for
  negative balances, id ``-custkey - 10^9``, which is not a customer);
* ``nation`` + ``region`` -> ``state_province``, ``country_region``,
  ``department``;
* ``orders`` -> ``sales_order_header``; ``lineitem`` ->
  ``sales_order_detail``; ``part`` -> ``product``; ``supplier`` ->
  ``employee``.

Order lines repeat ``(l_orderkey, l_linenumber)`` in the driver data, so the
line id is the line's position within its order (ordered by every column).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.sources.readers import DriverTables

INT = T.IntegerType()
SHORT = T.ShortType()
STR = T.StringType()
MONEY = T.DecimalType(19, 4)
CENTS = T.DecimalType(18, 2)


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(STR)


def _initial_cap(c: str) -> Column:
    return F.concat(F.substring(c, 1, 1), F.lower(F.substring(c, F.lit(2), F.length(c))))


def _region_code(c: str) -> Column:
    return F.upper(F.substring(c, 1, 2))


def customers_side(t: DriverTables) -> dict[str, DataFrame]:
    c = t("customer")
    person_rows = c.where(F.col("c_mktsegment") != "BUILDING")
    customer = c.select(
        F.col("c_custkey").cast(INT).alias("CustomerID"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast(INT)).alias("PersonID"),
        F.when(F.col("c_mktsegment") == "BUILDING", (F.col("c_nationkey") + 1000).cast(INT)).alias("StoreID"),
        F.col("c_nationkey").cast(INT).alias("TerritoryID"),
        F.concat(F.lit("AW"), F.lpad(_s("c_custkey"), 8, "0")).alias("AccountNumber"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("store"), _s("c_custkey"), F.lit(".example"))).alias("Website"),
    )
    person = person_rows.select(
        F.col("c_custkey").cast(INT).alias("BusinessEntityID"),
        _initial_cap("c_mktsegment").alias("FirstName"),
        F.concat(
            F.lit("No"), F.expr("substring(c_name, 10)"),
            F.when(F.col("c_acctbal") < 0, F.lit("  ")).otherwise(F.lit("")),
        ).alias("LastName"),
    )
    email = person_rows.select(
        F.col("c_custkey").cast(INT).alias("BusinessEntityID"),
        F.concat(F.lower("c_mktsegment"), F.lit("."), _s("c_custkey"), F.lit("@Example.com")).alias("EmailAddress"),
    )
    phone = person_rows.where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast(INT).alias("BusinessEntityID"),
        F.concat(F.lit("555-"), F.lpad(_s("c_custkey"), 7, "0")).alias("PhoneNumber"),
    )
    demographics = person_rows.where(F.col("c_nationkey") % 2 == 0).select(
        F.col("c_custkey").cast(INT).alias("BusinessEntityID"),
        F.when(F.col("c_acctbal") < 0, "0-25000").otherwise("25001-50000").alias("YearlyIncome"),
    )
    main = c.select(
        (F.col("c_custkey") * 2).cast(INT).alias("AddressID"),
        F.concat(_s("c_custkey"), F.lit(" Main St")).alias("AddressLine1"),
        F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("Suite "), _s("c_nationkey"))).alias("AddressLine2"),
        F.concat(F.lit("City "), _s("c_nationkey")).alias("City"),
        F.col("c_nationkey").cast(INT).alias("StateProvinceID"),
        F.lpad(_s("c_custkey"), 5, "0").alias("PostalCode"),
    )
    second = c.where(F.col("c_mktsegment") == "AUTOMOBILE").select(
        (F.col("c_custkey") * 2 + 1).cast(INT).alias("AddressID"),
        F.concat(_s("c_custkey"), F.lit(" Harbor Rd")).alias("AddressLine1"),
        F.lit(None).cast(STR).alias("AddressLine2"),
        F.concat(F.lit("Port "), _s("c_nationkey")).alias("City"),
        F.col("c_nationkey").cast(INT).alias("StateProvinceID"),
        F.lpad(_s("c_custkey"), 5, "0").alias("PostalCode"),
    )
    links = (
        c.select((F.col("c_custkey") * 2).cast(INT).alias("AddressID"),
                 F.col("c_custkey").cast(INT).alias("BusinessEntityID"))
        .unionByName(
            c.where(F.col("c_mktsegment") == "AUTOMOBILE").select(
                (F.col("c_custkey") * 2 + 1).cast(INT).alias("AddressID"),
                F.col("c_custkey").cast(INT).alias("BusinessEntityID"))
        )
        .unionByName(
            # vendor contacts share the address but are not customers
            c.where(F.col("c_acctbal") < 0).select(
                (F.col("c_custkey") * 2).cast(INT).alias("AddressID"),
                (-F.col("c_custkey") - 1_000_000_000).cast(INT).alias("BusinessEntityID"))
        )
    )
    return {
        "customer": customer,
        "person": person,
        "email_address": email,
        "person_phone": phone,
        "person_demographics": demographics,
        "address": main.unionByName(second),
        "business_entity_address": links,
    }


def geography_side(t: DriverTables) -> dict[str, DataFrame]:
    n, r = t("nation"), t("region")
    nr = n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner")
    return {
        "state_province": nr.select(
            F.col("n_nationkey").cast(INT).alias("StateProvinceID"),
            _region_code("r_name").alias("CountryRegionCode"),
        ),
        "country_region": r.select(
            _region_code("r_name").alias("CountryRegionCode"),
            F.col("r_name").alias("Name"),
        ),
        "department": nr.select(
            F.col("n_nationkey").cast(SHORT).alias("DepartmentID"),
            F.col("n_name").alias("Name"),
            F.col("r_name").alias("GroupName"),
        ),
    }


def sales_order_header(t: DriverTables) -> DataFrame:
    o = t("orders")
    online = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    sub = F.col("o_totalprice").cast(CENTS).cast(MONEY)
    tax = (sub * F.lit(Decimal("0.08"))).cast(MONEY)
    freight = (sub * F.lit(Decimal("0.02"))).cast(MONEY)
    return o.select(
        F.col("o_orderkey").cast(INT).alias("SalesOrderID"),
        F.substring("o_orderpriority", 1, 1).cast(SHORT).alias("RevisionNumber"),
        F.col("o_orderdate").alias("OrderDate"),
        (F.col("o_orderdate") + F.expr("INTERVAL 12 DAYS")).alias("DueDate"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")).alias("ShipDate"),
        F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 2)
        .when(F.col("o_orderstatus") == "F", 5).cast(SHORT).alias("Status"),
        online.alias("OnlineOrderFlag"),
        F.concat(F.lit("SO"), _s("o_orderkey")).alias("SalesOrderNumber"),
        F.when(~online, F.concat(F.lit("PO"), _s("o_orderkey"))).alias("PurchaseOrderNumber"),
        F.concat(F.lit("10-4030-"), F.lpad(_s("o_custkey"), 6, "0")).alias("AccountNumber"),
        F.col("o_custkey").cast(INT).alias("CustomerID"),
        F.when(~online, F.lit(279)).cast(INT).alias("SalesPersonID"),
        F.lit(1).cast(INT).alias("TerritoryID"),
        sub.alias("SubTotal"),
        tax.alias("TaxAmt"),
        freight.alias("Freight"),
        (sub + tax + freight).cast(MONEY).alias("TotalDue"),
    )


def sales_order_detail(t: DriverTables) -> DataFrame:
    # The order's key gets its type first, so that joins on it and key checks need no further exchange.
    li = t("lineitem").withColumn("SalesOrderID", F.col("l_orderkey").cast(INT))
    # Line position within its order; every column orders, so it is total.
    w = Window.partitionBy("SalesOrderID").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    # numbered in a projection of its own: in one with the other columns Spark would make and shuffle those before the window
    li = li.withColumn("SalesOrderDetailID", F.row_number().over(w).cast(INT))
    price = F.col("l_extendedprice").cast(CENTS).cast(MONEY)
    disc = F.col("l_discount").cast(CENTS).cast(MONEY)
    qty = F.col("l_quantity").cast(SHORT)
    return li.select(
        "SalesOrderID",
        "SalesOrderDetailID",
        F.concat(F.col("l_returnflag"), F.col("l_linestatus"), F.lit("-"), _s("l_suppkey")).alias("CarrierTrackingNumber"),
        qty.alias("OrderQty"),
        F.col("l_partkey").cast(INT).alias("ProductID"),
        F.lit(1).cast(INT).alias("SpecialOfferID"),
        price.alias("UnitPrice"),
        disc.alias("UnitPriceDiscount"),
        (qty * price * (F.lit(1) - disc)).cast(MONEY).alias("LineTotal"),
    )


def product(t: DriverTables) -> DataFrame:
    p = t("part")
    price = F.col("p_retailprice").cast(CENTS)
    return p.select(
        F.col("p_partkey").cast(INT).alias("ProductID"),
        F.concat(F.upper(F.substring("p_type", 1, 2)), F.lit("-"), F.lpad(_s("p_partkey"), 6, "0")).alias("ProductNumber"),
        F.concat(F.col("p_name"), F.lit(" "), _s("p_partkey")).alias("Name"),
        (price * F.lit(Decimal("0.6"))).cast(MONEY).alias("StandardCost"),
        price.cast(MONEY).alias("ListPrice"),
        (F.col("p_size") > 10).alias("FinishedGoodsFlag"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("Color"),
        (F.col("p_size") * 10).cast(SHORT).alias("SafetyStockLevel"),
        (F.col("p_size") * 7).cast(SHORT).alias("ReorderPoint"),
        F.concat(F.col("p_type"), F.lit("-"), _s("p_size")).alias("Size"),
        (F.col("p_size").cast(T.DecimalType(8, 2)) + F.lit(Decimal("0.25"))).cast(T.DecimalType(8, 2)).alias("Weight"),
    )


def employee(t: DriverTables) -> DataFrame:
    s = t("supplier")
    return s.select(
        F.col("s_suppkey").cast(INT).alias("BusinessEntityID"),
        F.lpad(_s(F.col("s_suppkey") * 7919), 9, "0").alias("NationalIDNumber"),
        F.concat(F.lit("adventure-works/"), F.lower(F.regexp_replace("s_name", "#", ""))).alias("LoginID"),
        F.concat(F.lit("Buyer "), _s("s_nationkey")).alias("JobTitle"),
        F.date_add(F.lit("1960-01-01").cast(T.DateType()), (F.col("s_suppkey") * 37 % 12000).cast(INT)).alias("BirthDate"),
        F.when(F.col("s_acctbal") > 5000, "M").otherwise("S").alias("MaritalStatus"),
        F.when(F.col("s_nationkey") % 2 == 0, "F").otherwise("M").alias("Gender"),
        F.date_add(F.lit("2005-01-01").cast(T.DateType()), (F.col("s_suppkey") * 13 % 3000).cast(INT)).alias("HireDate"),
        (F.col("s_acctbal") > 3000).alias("SalariedFlag"),
        (F.col("s_suppkey") % 100).cast(SHORT).alias("VacationHours"),
        (F.col("s_suppkey") % 50 + 20).cast(SHORT).alias("SickLeaveHours"),
    )


def operational_tables(t: DriverTables) -> dict[str, DataFrame]:
    """All operational tables the seven landing jobs read, by name."""
    out = {}
    out.update(customers_side(t))
    out.update(geography_side(t))
    out["sales_order_header"] = sales_order_header(t)
    out["sales_order_detail"] = sales_order_detail(t)
    out["product"] = product(t)
    out["employee"] = employee(t)
    return out
