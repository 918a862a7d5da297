"""Declared tables: widths, defaults, required columns and repeated loads."""

from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.errors import PySparkException

from lakeward.operators.declared import DeclaredColumn, DeclaredTable, history, load

TABLE = DeclaredTable("t", (
    DeclaredColumn("k", "INT", required=True), DeclaredColumn("v", "VARCHAR(3)"),
    DeclaredColumn("src", "VARCHAR(5)", True, "'crm'"), DeclaredColumn("live", "BOOLEAN", True, "true")))
DAY = datetime(2024, 1, 1, 6)


@pytest.fixture
def database(spark, scratch):
    name = f"d{uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch}/{name}'")
    return name


def kept(spark, database):
    return sorted((r.k, r.v, r.src, r.live, r._load_ts.day) for r in history(spark, TABLE, database).collect())


def test_repeated_loads_replace_their_own_rows(spark, database):
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    assert load(rows((1, "a"), (1, "a")), TABLE, database, "x", DAY) == 2
    assert load(rows((1, "b")), TABLE, database, "y", DAY) == 1
    assert load(rows((1, "b"), (2, None)), TABLE, database, "y", DAY) == 2
    both = [(1, "a", "crm", True, 1)] * 2 + [(1, "b", "crm", True, 1), (2, None, "crm", True, 1)]
    assert sorted(kept(spark, database), key=str) == sorted(both, key=str)
    assert load(rows((9, "z")).limit(0), TABLE, database, "y", DAY) == 0
    assert kept(spark, database) == both[:2]


def test_loads_that_break_the_declaration_are_refused(spark, database):
    frame = spark.createDataFrame
    load(frame([(1, "abc")], "k int, v string"), TABLE, database, "x", DAY)
    for bad in (frame([(1, "abcd")], "k int, v string"), frame([(None, "a")], "k int, v string"),
                frame([(1, None)], "k int, src string")):
        with pytest.raises(PySparkException):
            load(bad, TABLE, database, "x", DAY)
    for bad in (frame([("a",)], "v string"), frame([(1, 2)], "k int, other int")):
        with pytest.raises(ValueError):
            load(bad, TABLE, database, "x", DAY)
    assert kept(spark, database) == [(1, "abc", "crm", True, 1)]


def test_customers_keep_every_match_of_the_four_joins(spark, database):
    """Two e-mails give two rows, stores have no person, absent demographics stay NULL."""
    from lakeward.plans.append_jobs import APPEND_TABLES, customers_append_extract

    ops = {
        "customer": spark.createDataFrame(
            [(1, 10, None, 5, "AW1", None), (2, None, 7, 5, "AW2", "w.example"), (3, 11, None, 6, "AW3", None)],
            "CustomerID int, PersonID int, StoreID int, TerritoryID int, AccountNumber string, Website string"),
        "person": spark.createDataFrame(
            [(10, "Ann", "Lee"), (11, None, "Low")], "BusinessEntityID int, FirstName string, LastName string"),
        "email_address": spark.createDataFrame([(10, "a@x.example"), (10, "b@x.example")], "BusinessEntityID int, EmailAddress string"),
        "person_phone": spark.createDataFrame([(11, "555")], "BusinessEntityID int, PhoneNumber string"),
        "person_demographics": spark.createDataFrame([(10, "0-25000")], "BusinessEntityID int, YearlyIncome string"),
    }
    assert load(customers_append_extract(ops), APPEND_TABLES["customers"], database, "x", DAY) == 4
    rows = history(spark, APPEND_TABLES["customers"], database)
    got = sorted(rows.select("customer_id", "name", "email_address", "phone", "website", "annual_income").collect(), key=str)
    assert [tuple(r) for r in got] == [
        (1, "Ann Lee", "a@x.example", None, None, "0-25000"), (1, "Ann Lee", "b@x.example", None, None, "0-25000"),
        (2, "Unknown", None, None, "w.example", None), (3, "Unknown", None, "555", None, None)]
