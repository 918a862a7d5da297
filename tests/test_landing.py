from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeward.operators.keys import DuplicateKeyError
from lakeward.operators.landing import LoadStamp, landing_merge_feed, landing_reload, rows_affected, stamp
from lakeward.plans.landing_jobs import addresses_extract, customers_extract
from lakeward.sources.schemas import ADDRESSES, CUSTOMERS, DEPARTMENTS, EMPLOYEES

D1 = LoadStamp("b1", datetime(2024, 1, 1))
D2 = LoadStamp("b2", datetime(2024, 1, 2))


def emp(spark, rows):
    return spark.createDataFrame(rows, "business_entity_id int, national_id_number string, login_id string, "
                                       "job_title string, birth_date date, marital_status string, gender string, "
                                       "hire_date date, salaried_flag boolean, vacation_hours short, "
                                       "sick_leave_hours short")


def test_stamp_adds_lineage_and_fingerprint(spark):
    src = spark.createDataFrame([(1, "Sales", "Ops")], "department_id short, name string, group_name string")
    out = stamp(src, DEPARTMENTS, D1).first()
    assert out._source_system == "hr" and out._source_entity == "departments"
    assert out._pipeline_name == "pl_load_hr_departments_full" and out._batch_id == "b1"
    assert out._ingested_at == datetime(2024, 1, 1) and out._is_deleted is False
    import hashlib
    assert out._raw_hash == hashlib.sha256("1|Sales|Ops".encode("utf-16-le")).hexdigest().upper()


def test_merge_updates_only_listed_columns_and_keeps_deleted(spark):
    d = __import__("datetime").date
    day1 = emp(spark, [
        (1, "N1", "l1", "Buyer", d(1980, 2, 29), "M", "F", d(2010, 1, 1), True, 1, 1),
        (2, "N2", "l2", "Clerk", None, "S", "M", d(2011, 1, 1), False, 2, 2),
        (3, "N3", "l3", "Boss", None, "S", "M", d(2012, 1, 1), False, 3, 3),
    ])
    current = landing_reload(day1, EMPLOYEES, D1).withColumn(
        "_is_deleted", F.col("business_entity_id").isin(1, 2))
    day2 = emp(spark, [
        # fingerprinted job_title changed; login_id is not an update column
        (1, "N1", "CHANGED", "Senior Buyer", d(1980, 2, 29), "M", "F", d(2010, 1, 1), True, 9, 9),
        # same fingerprint (login differs, not fingerprinted): stays deleted, untouched
        (2, "N2", "other", "Clerk", None, "S", "M", d(2011, 1, 1), False, 2, 2),
        (4, "N4", "l4", "New", None, "S", "M", d(2013, 1, 1), False, 4, 4),
    ])
    feed = landing_merge_feed(current, day2, EMPLOYEES, D2)
    got = {r.business_entity_id: r for r in feed.collect()}
    assert got[1]._change_type == "update" and got[1].job_title == "Senior Buyer"
    assert got[1].login_id == "l1" and got[1].vacation_hours == 9 and got[1]._is_deleted is False
    assert got[1]._batch_id == "b2"
    assert got[2]._change_type == "unchanged" and got[2]._is_deleted is True and got[2].login_id == "l2"
    assert got[3]._change_type == "kept" and got[3]._batch_id == "b1"
    assert got[4]._change_type == "insert" and got[4]._ingested_at == datetime(2024, 1, 2)
    assert rows_affected(feed).first()[0] == 2


def _ops(spark):
    ops = {
        "customer": spark.createDataFrame(
            [(1, 1, None, 5, "AW1"), (2, None, 7, 5, "AW2")],
            "CustomerID int, PersonID int, StoreID int, TerritoryID int, AccountNumber string"),
        "person": spark.createDataFrame([(1, "Ana", None)], "BusinessEntityID int, FirstName string, LastName string"),
        "email_address": spark.createDataFrame([(1, "a@x")], "BusinessEntityID int, EmailAddress string"),
        "person_phone": spark.createDataFrame([(1, "555")], "BusinessEntityID int, PhoneNumber string"),
    }
    return ops


def test_customer_extract_unknown_name_fingerprinted_empty(spark):
    out = {r.customer_id: r for r in customers_extract(_ops(spark)).collect()}
    import hashlib
    # missing last name: stored 'Unknown', fingerprinted as ''
    assert out[1].name == "Unknown"
    assert out[1]._raw_hash == hashlib.sha256("1|AW1||a@x|555".encode("utf-16-le")).hexdigest().upper()
    assert out[2].name == "Unknown" and out[2].email_address is None


def test_customer_extract_fan_out_is_refused(spark):
    ops = _ops(spark)
    ops["email_address"] = spark.createDataFrame([(1, "a@x"), (1, "b@x")], "BusinessEntityID int, EmailAddress string")
    with pytest.raises(DuplicateKeyError):
        landing_reload(customers_extract(ops), CUSTOMERS, D1)


def test_address_links_only_count_customers(spark):
    ops = _ops(spark)
    ops["address"] = spark.createDataFrame(
        [(10, "Main", None, "X", 1, "00001")],
        "AddressID int, AddressLine1 string, AddressLine2 string, City string, StateProvinceID int, PostalCode string")
    ops["business_entity_address"] = spark.createDataFrame([(10, 1), (10, 99)], "AddressID int, BusinessEntityID int")
    ops["state_province"] = spark.createDataFrame([(1, "EU")], "StateProvinceID int, CountryRegionCode string")
    ops["country_region"] = spark.createDataFrame([("EU", "EUROPE")], "CountryRegionCode string, Name string")
    out = landing_reload(addresses_extract(ops), ADDRESSES, D1).collect()
    assert [(r.address_id, r.customer_id, r.country_region) for r in out] == [(10, 1, "EUROPE")]


def test_append_layout_loads_accumulate(spark, scratch):
    from datetime import date
    from lakeward.operators.landing import append_stamp

    src = spark.createDataFrame([(1, 100), (2, 200)], "sales_order_id int, total_due int")
    path = f"{scratch}/raw_erp/order_headers"
    append_stamp(src, "ERP", datetime(2024, 1, 1, 6)).write.mode("append").parquet(path)
    append_stamp(src, "ERP", datetime(2024, 1, 2, 6)).write.mode("append").parquet(path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 4
    assert {(r._load_dt, r._source_system, r._is_active) for r in rows} == {
        (date(2024, 1, 1), "ERP", True), (date(2024, 1, 2), "ERP", True)}
