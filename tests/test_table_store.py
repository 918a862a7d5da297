"""Bucketed tables: digests, touched buckets, overwrites and plans."""

import glob
import os
import random
from uuid import uuid4

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeward.operators import cdc
from lakeward.operators.table_store import TableStore, bucket_digests, part_of

SCHEMA = "a int, b string, v string, _raw_hash string, stamp string"
KEYS = ["a", "b"]


@pytest.fixture
def store(spark, scratch):
    return TableStore(spark, scratch, 6, prefix=f"t{uuid4().hex[:8]}_")


def mirrored(stamp):
    project = lambda df: df.withColumn("stamp", F.lit(stamp))
    return lambda s, t: cdc.apply_changes(s, t, KEYS, project, with_change_type=True, with_deletes=False)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(store, name):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{store.base}/s/{name}_*/_part=*/*.parquet")}


def test_upsert_by_buckets_equals_the_plain_join(spark, store):
    """Random sources, NULL fingerprints and composite keys among them: the state is that of the plain recipe."""
    rng = random.Random(4)
    state, plain = {}, None
    for step in range(7):
        if step != 3:  # the fourth source is the third one again
            for _ in range(rng.choice([3, 12])):
                k = (rng.randrange(12), rng.choice(["x", "y"]))
                if rng.random() < 0.3:
                    state.pop(k, None)
                else:
                    state[k] = (rng.choice(["p", "q"]), rng.choice(["h1", "h2", "h3", None]))
        if step == 5:
            state = {}
        source = spark.createDataFrame([(a, b, v, h, None) for (a, b), (v, h) in state.items()], SCHEMA)
        project = lambda df, step=step: df.withColumn("stamp", F.lit(f"run {step}"))
        if plain is None:
            store.replace("s", "t", project(source), KEYS)
            plain = rows_of(project(source))
            continue
        before = files(store, "t")
        counts = store.upsert("s", "t", source, KEYS, mirrored(f"run {step}"), mirror=True)
        target = spark.createDataFrame(plain, SCHEMA)
        feed = {r[cdc.CHANGE_TYPE]: r["rows"] for r in cdc.change_counts(cdc.classify_changes(source, target, KEYS)).collect()}
        plain = rows_of(cdc.apply_changes(source, target, KEYS, project).select(*target.columns))
        assert rows_of(store.current("s", "t").select(*target.columns)) == plain
        assert {k: counts.get(k, 0) for k in ("insert", "update", "delete")} == {k: feed.get(k, 0) for k in ("insert", "update", "delete")}
        if step == 3:
            assert counts == {} and files(store, "t") == before


def test_only_touched_buckets_are_joined_and_written(spark, store):
    rows = spark.range(600).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b"), F.lit("v").alias("v"),
                                   F.col("id").cast("string").alias("_raw_hash"), F.lit("first").alias("stamp"))
    assert store.replace("s", "t", rows, KEYS) == 600
    before = files(store, "t")
    assert len(before) == 6
    changed = rows.withColumn("_raw_hash", F.when(F.col("a").isin(7, 8), "new").otherwise(F.col("_raw_hash")))
    parts = {r.p for r in rows.where("a in (7, 8)").select(part_of(KEYS, 6).alias("p")).collect()}
    seen = []

    def change(s, t):
        seen.append((s, t))
        return mirrored("second")(s, t)

    counts = store.upsert("s", "t", changed, KEYS, change, mirror=True)
    assert counts["update"] == 2 and counts["insert"] == counts["delete"] == 0 and counts["unchanged"] > 0
    source, target = seen[-1]
    for df in (source, target):
        assert {r.p for r in df.select(part_of(KEYS, 6).alias("p")).distinct().collect()} == parts
    untouched = {f for f in files(store, "t") if int(f.split("_part=")[1].split("/")[0]) not in parts}
    assert untouched == {f for f in before if f in files(store, "t")} and len(untouched) == 6 - len(parts)
    assert store.current("s", "t").where("stamp = 'second'").count() == 2


def test_target_is_joined_without_an_exchange(spark, store):
    rows = spark.range(500).select(F.col("id").cast("int").alias("a"), F.hex("id").alias("b"), F.lit("v").alias("v"),
                                   F.col("id").cast("string").alias("_raw_hash"), F.lit("s").alias("stamp"))
    store.replace("s", "t", rows, KEYS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = rows.repartition(6, *KEYS)
        plan = mirrored("x")(source, store.current("s", "t"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the source is dealt once, and neither its key check nor the join shuffles anything again
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan


def test_a_bucket_equals_sparks_own(spark, store):
    rows = spark.range(200).select(F.col("id").cast("int").alias("a"), F.col("id").cast("string").alias("_raw_hash"))
    store.replace("s", "t", rows, ["a"])
    for f in files(store, "t"):
        part = int(f.split("_part=")[1].split("/")[0])
        assert int(os.path.basename(f).split("_")[-1].split(".")[0]) == part


def test_digests_see_every_difference(spark):
    base = [(1, "x", "v", "h", None), (2, "x", "v", None, None), (3, "y", "v", "", None)]
    digest = lambda rows: {tuple(r) for r in bucket_digests(spark.createDataFrame(rows, SCHEMA), KEYS, 3).collect()}
    assert digest(base) == digest(base[::-1])
    for other in (base[:2], base + [(4, "x", "v", "h", None)], [(1, "x", "v", "h", None), (2, "x", "v", "", None), (3, "y", "v", "", None)],
                  [(1, "x", "v", "H", None), *base[1:]], [(1, "y", "v", "h", None), *base[1:]]):
        assert digest(other) != digest(base)


def test_refused_writes_leave_the_table(spark, store):
    assert store.current("s", "t") is None
    one = spark.createDataFrame([(1, "x", "v", "h", "s")], SCHEMA)
    store.replace("s", "t", one, KEYS)
    for bad in (one.union(one), spark.createDataFrame([(None, "x", "v", "h", "s")], SCHEMA)):
        with pytest.raises(Exception, match="not unique or NULL"):
            store.replace("s", "t", bad, KEYS)
        with pytest.raises(Exception, match="not unique or NULL"):
            store.upsert("s", "t", bad.withColumn("_raw_hash", F.lit("new")), KEYS, mirrored("x"), mirror=True)
    assert rows_of(store.current("s", "t")) == rows_of(one)
    assert len(files(store, "t")) == 1  # refused attempts leave no data behind
    assert store.replace("s", "t", store.current("s", "t").withColumn("stamp", F.lit("self")), KEYS) == 1
    assert [r.stamp for r in store.current("s", "t").collect()] == ["self"]
    with pytest.raises(AnalysisException):
        store.replace("s", "t", one.selectExpr("no_such_column"), KEYS)


def test_a_run_that_died_before_its_digests_is_repeated(spark, store, monkeypatch):
    first = spark.createDataFrame([(i, "x", "v", f"h{i}", "0") for i in range(40)], SCHEMA)
    second = spark.createDataFrame([(i, "x", "w", f"h{i % 30}", "0") for i in range(5, 45)], SCHEMA)
    store.replace("s", "t", first, KEYS)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(TableStore, "_save_digests", crash)
        with pytest.raises(RuntimeError):
            store.upsert("s", "t", second, KEYS, mirrored("1"), mirror=True)
    store.upsert("s", "t", second, KEYS, mirrored("2"), mirror=True)
    project = lambda df: df.withColumn("stamp", F.lit("1"))
    assert rows_of(store.current("s", "t")) == rows_of(cdc.apply_changes(second, first, KEYS, project).select(*first.columns))
    assert store.upsert("s", "t", second, KEYS, mirrored("3"), mirror=True) == {}


def test_columns_that_come_and_go(spark, store):
    """A source with other columns rewrites the table; unchanged rows are NULL in new ones."""
    store.replace("s", "t", spark.createDataFrame([(1, "x", "v", "h", "0"), (2, "x", "v", "h", "0")], SCHEMA), KEYS)
    source = spark.createDataFrame([(1, "x", "h", "0", 5), (2, "x", "new", "0", 6)], "a int, b string, _raw_hash string, stamp string, w int")
    assert store.upsert("s", "t", source, KEYS, mirrored("1"), mirror=True) == {"rewritten": 1}
    got = store.current("s", "t")
    assert set(got.columns) == {"a", "b", "_raw_hash", "stamp", "w"}
    assert rows_of(got.select("a", "stamp", "w")) == [(1, "0", None), (2, "1", 6)]
    assert store.upsert("s", "t", source, KEYS, mirrored("2"), mirror=True) == {}


def test_keys_of_another_type_meet(spark, store):
    store.replace("s", "t", spark.createDataFrame([(i, "x", "v", "h", "0") for i in range(20)], SCHEMA), KEYS)
    wide = spark.createDataFrame([(i, "x", "v", "h", "0") for i in range(20)], SCHEMA.replace("a int", "a long"))
    assert store.upsert("s", "t", wide, KEYS, mirrored("1"), mirror=True) == {}


def test_soft_deletes_touch_their_buckets_only(spark, store):
    schema = f"{SCHEMA}, _is_deleted boolean"
    rows = spark.createDataFrame([(i, "x", "v", "h", "0", False) for i in range(60)], schema)
    store.replace("s", "t", rows, KEYS)
    before = files(store, "t")
    kept = lambda s, t: cdc.apply_changes(s, t, KEYS, with_change_type=True, with_deletes=False)
    gone = spark.createDataFrame([(3, "x"), (3, "x"), (99, "x")], "a long, b string")
    store.upsert("s", "t", rows, KEYS, kept, gone=gone)
    assert [r.a for r in store.current("s", "t").where("_is_deleted").collect()] == [3]
    assert store.current("s", "t").count() == 60
    assert len({f for f in files(store, "t") if f in before}) >= 4


def test_empty_tables(spark, store):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "x", "v", "h", "0")], SCHEMA)
    assert store.replace("s", "t", none, KEYS) == 0 and store.current("s", "t").count() == 0
    assert store.upsert("s", "t", none, KEYS, mirrored("1"), mirror=True) == {}
    assert store.upsert("s", "t", some, KEYS, mirrored("2"), mirror=True)["insert"] == 1
    assert store.upsert("s", "t", none, KEYS, mirrored("3"), mirror=True)["delete"] == 1
    assert store.current("s", "t").count() == 0
    assert store.replace("s", "plain", some) == 1 and store.current("s", "plain").count() == 1
