"""Personal data followed through plans."""

from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeward.functions import pii_hash
from lakeward.operators.lineage import clear_columns, column_metadata, personal, value_leaks
from lakeward.operators.table_store import TableStore
from lakeward.plans import runner
from lakeward.plans.models import MODELS, Run
from lakeward.plans.pipeline import TwoDayPipeline
from lakeward.plans.queries import build_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture
def people(spark):
    rows = spark.createDataFrame([(1, "Ann", "a@x"), (2, "Bob", None), (2, "Bob", "b@x")], "id int, name string, mail string")
    return rows.select("id", personal(F.trim("name"), "name"), personal(F.col("mail"), "mail"))


def test_clear_values_are_found_under_any_name(spark, people):
    other = spark.createDataFrame([(1, "Oslo")], "id int, city string")
    by_id = Window.partitionBy("id").orderBy("mail")
    for df, expected in (
        (people.select("id", F.col("name").alias("account_number")), ["account_number"]),
        (people.select("id", F.upper(F.concat(F.lit("x"), "name")).alias("a"), F.length("mail").alias("n")), ["a", "n"]),
        (people.join(other, "id", "left").select("city", F.coalesce("mail", "city").alias("place")), ["place"]),
        (people.groupBy("id").agg(F.max("name").alias("top"), F.count("name").alias("n"), F.count(F.lit(1)).alias("rows")), ["top", "n"]),
        (people.select("id", F.first("mail").over(by_id).alias("first"), F.row_number().over(by_id).alias("nth")), ["first"]),
        (people.select(F.explode(F.split("name", "")).alias("letter")), ["letter"]),
        (other.select("city").union(people.select("name")), ["city"]),
        (people.select("id", F.struct("id", "name").alias("s")).select("s.*"), ["id", "name"]),
        (people.select(pii_hash("name").alias("name_hash"), F.md5("mail").alias("m"), "id"), []),
        (people.select(F.concat(pii_hash("name"), "name").alias("both")), ["both"]),
        (people.drop("name", "mail"), []),
        (people.dropDuplicates(["id"]).orderBy("id").limit(1), ["name", "mail"]),
    ):
        assert clear_columns(df) == expected, df.columns


def test_written_tables_keep_the_mark(spark, scratch, people):
    store = TableStore(spark, scratch, 2, prefix=f"t{uuid4().hex[:8]}_")
    store.replace("s", "t", people)
    renamed = store.current("s", "t").withColumnsRenamed({"name": "account_number", "mail": "city"})
    assert clear_columns(renamed) == ["account_number", "city"]


def test_published_models_are_clear_of_personal_data(spark):
    run = TwoDayPipeline(spark, SF).run(1)
    for name, info in MODELS.items():
        found = clear_columns(run.ref(name))
        assert (found == []) == (info.layer == "certified" or not info.pii_fields), name
        joined = {"address_line1", "address_line2"} if name == "int_customers" else set()
        assert set(found) == set(info.pii_fields) | joined if found else True, name
    assert ("email_address_hash", "email_address", "SHA2_256") in column_metadata(run.ref("az_customers"))
    assert {c for c, original, _ in column_metadata(run.ref("az_employees")) if original} == {
        "national_id_hash", "login_id_hash", "birth_date_hash"}


def test_a_renamed_clear_column_is_not_published(spark, scratch, monkeypatch):
    p = TwoDayPipeline(spark, SF)

    def leaky(run: Run):
        return run.ref("stg_crm__customers").select("customer_id", F.initcap("name").alias("account_number"), "_raw_hash")

    from dataclasses import replace

    monkeypatch.setitem(MODELS, "az_customers", replace(MODELS["az_customers"], build=leaky))
    store = TableStore(spark, scratch, 2, prefix=f"t{uuid4().hex[:8]}_")
    with pytest.raises(ValueError, match="account_number"):
        runner.run_project(store, lambda e: p.raw(e, 1), datetime(2024, 1, 1), select=["az_customers"])
    assert store.current("azure_fabric", "az_customers") is None


def test_value_leaks_counts_published_clear_values(spark, people):
    published = spark.createDataFrame([("Ann", "Oslo"), ("Ann", "b@x"), (None, "")], "code string, city string")
    got = {tuple(r) for r in value_leaks({"m": published}, ["name", "mail"], people).collect()}
    assert got == {("m", "code", 1), ("m", "city", 1)}
    assert "leak_scan" in build_queries()
