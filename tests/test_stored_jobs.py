"""Large upserts in several jobs, buckets by size, and what lies on disk meanwhile."""

import glob
from uuid import uuid4

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeward.operators import cdc, table_store
from lakeward.operators.frames import input_bytes
from lakeward.operators.table_store import OPEN_FILES, TableStore
from lakeward.plans import stored
from lakeward.plans.pipeline import TwoDayPipeline
from lakeward.plans.stored import StoredChain
from lakeward.sources.schemas import IS_DELETED
from test_shuffled_bytes import LINE_SCHEMA, LINES, _Lines, _plan

SCHEMA = "a int, b string, v string, _raw_hash string, stamp string"
KEYS = ["a", "b"]


@pytest.fixture
def store(spark, scratch, monkeypatch):
    monkeypatch.setattr(table_store, "JOB_BUCKETS", 2)
    monkeypatch.setattr(table_store, "JOBS", 3)
    return TableStore(spark, scratch, 6, prefix=f"j{uuid4().hex[:8]}_")


def mirrored(stamp, seen=None):
    project = lambda df: df.withColumn("stamp", F.lit(stamp))

    def change(s, t):
        if seen is not None:
            seen.append((s, t))
        return cdc.apply_changes(s, t, KEYS, project, with_change_type=True, with_deletes=False)

    return change


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def some(spark, n, hashed):
    return spark.createDataFrame([(i, "x", "v", hashed(i), "0") for i in range(n)], SCHEMA)


def test_an_upsert_in_several_jobs_equals_one(spark, store):
    first = some(spark, 60, lambda i: f"h{i}")
    second = some(spark, 70, lambda i: f"h{i % 40}").where("a > 4")
    store.replace("s", "t", first, KEYS)
    assert spark.conf.get(OPEN_FILES) == "0"
    seen = []
    counts = store.upsert("s", "t", second, KEYS, mirrored("1", seen), mirror=True)
    assert len(seen) == 4  # one for the columns, one for each job
    assert counts == {"insert": 10, "update": 20, "unchanged": 35, "kept": 0, "delete": 5}
    project = lambda df: df.withColumn("stamp", F.lit("1"))
    assert rows_of(store.current("s", "t")) == rows_of(cdc.apply_changes(second, first, KEYS, project).select(*first.columns))
    assert store.upsert("s", "t", second, KEYS, mirrored("2"), mirror=True) == {}


def test_repeated_keys_refuse_all_jobs(spark, store):
    first = some(spark, 60, lambda i: f"h{i}")
    store.replace("s", "t", first, KEYS)
    changed = some(spark, 60, lambda i: f"n{i}")
    for bad in (changed.union(changed.where("a = 59")), changed.union(spark.createDataFrame([(None, "x", "v", "h", "0")], SCHEMA))):
        with pytest.raises(Exception, match="not unique or NULL"):
            store.upsert("s", "t", bad, KEYS, mirrored("1"), mirror=True)
        assert rows_of(store.current("s", "t")) == rows_of(first)


def test_a_later_job_that_died_is_mended_by_any_source(spark, store):
    first, second = some(spark, 60, lambda i: f"h{i}"), some(spark, 60, lambda i: f"n{i}")
    store.replace("s", "t", first, KEYS)
    seen = []

    def dying(s, t):
        if len(seen) == 3:
            raise RuntimeError("lost")
        return mirrored("1", seen)(s, t)

    with pytest.raises(RuntimeError):
        store.upsert("s", "t", second, KEYS, dying, mirror=True)
    assert 0 < store.current("s", "t").where("stamp = '1'").count() < 60
    store.upsert("s", "t", first, KEYS, mirrored("0"), mirror=True)  # what was applied before the run that died
    assert rows_of(store.current("s", "t")) == rows_of(first)


def test_files_are_in_key_order_without_a_sort_of_the_writer(spark, store):
    rows = spark.range(400).select((F.col("id") * 7919 % 400).cast("int").alias("a"), F.lit("x").alias("b"), F.lit("v").alias("v"),
                                   F.col("id").cast("string").alias("_raw_hash"), F.lit("0").alias("stamp"))
    for checked in (True, False):
        store.replace("s", "t", rows, KEYS, validate_keys=checked)
        facts = spark.sql(f"DESCRIBE TABLE EXTENDED {store._written('s', 't')}").collect()
        assert next(r.data_type for r in facts if r.col_name == "Sort Columns") == "[]"
        files = glob.glob(f"{store.base}/s/t_*/_part=*/*.parquet")
        assert len(files) == 6
        for f in files:
            keys = pq.ParquetFile(f).read(columns=["a"]).column("a").to_pylist()
            assert keys == sorted(keys)


def test_some_buckets_are_read_alone(spark, store):
    store.replace("s", "t", some(spark, 60, str), KEYS)
    parts = store.part("s", "t", [1, 4])
    assert len(parts.inputFiles()) == 2 and parts_of(parts) == {1, 4} and store.buckets_of("s", "t") == 6


def parts_of(rows):
    return {r.p for r in rows.select(table_store.part_of(KEYS, 6).alias("p")).distinct().collect()}


class _Source(_Lines):
    """Order lines of a file; what is written of them is read from then on."""

    def __init__(self, spark, folder, n):
        TwoDayPipeline.__init__(self, spark, "none")
        rows = [(o, *r[1:]) for o in range(1, n) for r in LINES]
        spark.createDataFrame(rows, LINE_SCHEMA).write.parquet(f"{folder}/lines")
        self.lines = spark.read.parquet(f"{folder}/lines")
        self.kept = super().today_ops

    @property
    def today_ops(self):
        return self.kept


def test_the_chain_reads_numbered_lines_and_deals_large_extracts_into_more_buckets(spark, scratch, monkeypatch):
    found = {}
    for size in (8 << 20, 200):
        monkeypatch.setattr(stored, "BUCKET_BYTES", size)
        source = _Source(spark, f"{scratch}/{size}", 40)
        chain = StoredChain(TableStore(spark, f"{scratch}/store-{size}", 2, prefix=f"c{uuid4().hex[:8]}_"), source, unprinted=True)
        chain.first_day(["order_details"], ["az_order_details"])
        buckets = chain.store.buckets_of("raw_erp", "order_details")
        assert "Exchange" not in _plan(chain.extract("order_details", 1)) and "Exchange" not in _plan(chain.extract("order_details", 2))
        counts = chain.second_day(["order_details"], ["az_order_details"])
        landed, cert = chain.raw("order_details"), chain.store.current("azure_fabric", "az_order_details")
        assert landed.where(IS_DELETED).count() > 0
        found[size] = counts, rows_of(landed), rows_of(cert)
        assert chain.store.buckets_of("azure_fabric", "az_order_details") == buckets
        assert (buckets == 2) == (size > 200)
        chain.drop("order_details", "az_order_details")
        assert chain.raw("order_details") is None and not glob.glob(f"{scratch}/store-{size}/*/*/_part=*")
    (a, *small), (b, *large) = found.values()
    assert small == large
    for t in ("insert", "update", "delete"):  # rows of untouched buckets are not counted as unchanged
        assert a["az_order_details"][t] == b["az_order_details"][t]


def test_input_bytes_are_those_of_the_files(spark, scratch):
    spark.range(1000).write.parquet(f"{scratch}/t")
    df = spark.read.parquet(f"{scratch}/t")
    one = input_bytes(df)
    assert one > 0 and input_bytes(df.groupBy("id").count()) == one and input_bytes(df.union(df)) == 2 * one
    assert input_bytes(spark.createDataFrame([(1,)], "a int").union(df.selectExpr("cast(id as int) a"))) in range(one, one + 100)
