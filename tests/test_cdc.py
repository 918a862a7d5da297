from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeward.operators import cdc
from lakeward.operators.keys import DuplicateKeyError

SCHEMA = "id int, name string, note string, _raw_hash string, _loaded string"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def project(stamp):
    return lambda s: s.withColumn("_loaded", F.lit(stamp))


@pytest.fixture
def target(spark):
    return spark.createDataFrame([
        (1, "a", "n1", "h1", "old"),
        (2, "b", "n2", "h2", "old"),
        (3, "c", "n3", None, "old"),   # NULL fingerprint in the target
        (4, "d", "n4", "h4", "old"),   # vanishes from the source
    ], SCHEMA)


@pytest.fixture
def staged(spark):
    return spark.createDataFrame([
        (1, "a", "n1", "h1", None),     # unchanged
        (2, "B", "n2", "h2x", None),    # changed fingerprint
        (3, "C", "n3", "h3", None),     # NULL on the target side: not a change
        (5, "e", "n5", "h5", None),     # new
    ], SCHEMA)


def test_apply_changes_classifies_every_key(spark, staged, target):
    out = cdc.apply_changes(staged, target, ["id"], project("new"), with_change_type=True)
    assert rows(out, "id", "name", "_loaded", "_change_type") == [
        (1, "a", "old", "unchanged"),
        (2, "B", "new", "update"),
        (3, "c", "old", "unchanged"),
        (4, "d", "old", "delete"),
        (5, "e", "new", "insert"),
    ]


def test_keys_after_run_equal_staged_keys(spark, staged, target):
    out = cdc.apply_changes(staged, target, ["id"], project("new"))
    assert sorted(r.id for r in out.collect()) == sorted(r.id for r in staged.collect())


def test_rerun_changes_nothing(spark, staged, target):
    first = cdc.apply_changes(staged, target, ["id"], project("run2"))
    again = cdc.apply_changes(staged, first, ["id"], project("run3"))
    assert rows(again, "id", "name", "_loaded") == rows(first, "id", "name", "_loaded")


def test_first_load_is_the_projection(spark, staged):
    out = cdc.apply_changes(staged, None, ["id"], project("first"))
    assert rows(out, "id", "_loaded") == [(1, "first"), (2, "first"), (3, "first"), (5, "first")]


def test_change_outside_fingerprint_is_not_propagated(spark, target):
    staged = target.where("id = 1").withColumn("note", F.lit("edited"))
    out = cdc.apply_changes(staged, target, ["id"], project("new"))
    assert rows(out, "id", "note", "_loaded") == [(1, "n1", "old")]


def test_stepwise_equals_single_pass(spark, staged, target):
    a = cdc.apply_changes(staged, target, ["id"], project("new"))
    b = cdc.apply_changes_stepwise(staged, target, ["id"], project("new"))
    cols = ("id", "name", "note", "_raw_hash", "_loaded")
    assert rows(a, *cols) == rows(b, *cols)


def test_change_feed_and_counts(spark, staged, target):
    feed = cdc.classify_changes(staged, target, ["id"])
    assert rows(feed, "id", "_change_type") == [
        (1, "unchanged"), (2, "update"), (3, "unchanged"), (4, "delete"), (5, "insert")]
    counts = {r["_change_type"]: r["rows"] for r in cdc.change_counts(feed).collect()}
    assert counts == {"unchanged": 2, "update": 1, "delete": 1, "insert": 1}


def test_composite_key_differing_in_one_part(spark):
    s = "o int, l int, _raw_hash string"
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], s)
    staged = spark.createDataFrame([(1, 1, "a"), (1, 3, "c")], s)
    out = cdc.apply_changes(staged, target, ["o", "l"], with_change_type=True)
    assert rows(out, "o", "l", "_change_type") == [(1, 1, "unchanged"), (1, 2, "delete"), (1, 3, "insert")]
    assert rows(cdc.delete_orphans(target, staged, ["o", "l"]), "o", "l") == [(1, 1)]
    assert rows(cdc.detect_changes(staged, target, ["o", "l"]), "o", "l") == [(1, 3)]


def test_duplicate_source_keys_raise(spark, target):
    dup = spark.createDataFrame([(1, "a", "", "h", None), (1, "b", "", "h", None)], SCHEMA)
    with pytest.raises(DuplicateKeyError):  # first load: checked before building
        cdc.apply_changes(dup, None, ["id"])
    with pytest.raises(Exception, match="not unique"):  # incremental: the job fails
        cdc.apply_changes(dup, target, ["id"]).collect()


def test_schema_sync(spark, staged, target):
    old = target.drop("note").withColumn("legacy", F.lit(1))
    out = cdc.apply_changes(staged, old, ["id"], project("new"))
    assert "legacy" not in out.columns and "note" in out.columns
    assert rows(out, "id", "note") == [(1, None), (2, "n2"), (3, None), (5, "n5")]
    synced = cdc.sync_columns(old, staged)
    assert synced.columns == staged.columns


def test_run_stamps_are_literals(spark, staged):
    from lakeward.operators.staging import loaded_at
    got = staged.select(loaded_at(datetime(2024, 1, 2, 3, 4, 5))).first()[0]
    assert got == datetime(2024, 1, 2, 3, 4, 5)


def test_null_keys_are_refused(spark, target):
    unkeyed = spark.createDataFrame([(None, "a", "", "h", None)], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        cdc.apply_changes(unkeyed, None, ["id"])
    with pytest.raises(Exception, match="not unique or NULL"):
        cdc.apply_changes(unkeyed, target, ["id"]).collect()
