"""Change-data-capture publishing of a staged table into a certified table.

The classic recipe runs three passes over the target:

1. :func:`delete_orphans` – drop target rows whose key left the source
   (hard deletes, and soft deletes because staging already dropped them);
2. :func:`detect_changes` – keep staged rows that are new or whose
   fingerprint differs;
3. :func:`merge_changes` – upsert those rows by key.

:func:`apply_changes` computes the same new state in **one** left join of
the staged rows with the target on the key (one shuffle per side): a single
projection picks the staged row (insert/update) or the old target row
(unchanged, so old load stamps survive); keys that left the source find no
staged row.  Its output stays partitioned by the staged key.  The typed form
is a full outer join that also returns the deleted target rows, and
:func:`classify_changes` is the change feed of keys and fingerprints.

Keys must be unique on both sides (checked on the staged side by
default), exactly as a SQL ``MERGE`` refuses a double match.  Unique keys
also mean the key join cannot be skewed.  On incremental runs the check is
a guard inside the join's own shuffle (no extra pass over the data); on a
first load it is one aggregation over the key columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.operators.keys import HIT, assert_unique_keys, guard_unique, presence_join
from lakeward.sources.schemas import RAW_HASH

CHANGE_TYPE = "_change_type"
INSERT, UPDATE, UNCHANGED, DELETE = "insert", "update", "unchanged", "delete"

Projection = Callable[[DataFrame], DataFrame]


def _identity(df: DataFrame) -> DataFrame:
    return df


def _changed(hash_col: str) -> Column:
    # s.hash <> t.hash with SQL three-valued logic: NULL on either side
    # is not a change.
    return F.coalesce(F.col("s_" + hash_col) != F.col("t_" + hash_col), F.lit(False))


def _change_type(s_hit: Column, t_hit: Column, hash_col: str) -> Column:
    return (
        F.when(~t_hit, INSERT)
        .when(~s_hit, DELETE)
        .when(_changed(hash_col), UPDATE)
        .otherwise(UNCHANGED)
    )


def classify_changes(
    staged: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    hash_col: str = RAW_HASH,
) -> DataFrame:
    """Change feed: ``keys``, ``_change_type`` and both fingerprints."""
    keys = list(keys)
    s = staged.select(*keys, hash_col)
    t = target.select(*keys, hash_col)
    joined, s_hit, t_hit = presence_join(s, t, keys, "s_", "t_")
    return joined.select(
        *keys,
        _change_type(s_hit, t_hit, hash_col).alias(CHANGE_TYPE),
        F.col("s_" + hash_col).alias("source_hash"),
        F.col("t_" + hash_col).alias("target_hash"),
    )


def change_counts(feed: DataFrame) -> DataFrame:
    """Rows per change type of a feed from :func:`classify_changes`."""
    return feed.groupBy(CHANGE_TYPE).agg(F.count(F.lit(1)).alias("rows"))


def delete_orphans(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key still exists in the staged source.

    ``DELETE ... WHERE key NOT IN (SELECT key FROM staged)`` written as a
    semi join (keys are NOT NULL, so the NULL-aware anti join is not needed).
    """
    keys = list(keys)
    return target.join(staged.select(*keys), on=keys, how="left_semi")


def detect_changes(
    staged: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    hash_col: str = RAW_HASH,
) -> DataFrame:
    """Staged rows that are new (no target row) or whose fingerprint differs."""
    keys = list(keys)
    t = target.select(
        *keys, F.col(hash_col).alias("t_" + hash_col), F.lit(True).alias("t_" + HIT)
    )
    s = staged.withColumnRenamed(hash_col, "s_" + hash_col)
    joined = s.join(t, on=keys, how="left")
    is_new = F.col("t_" + HIT).isNull()
    out = joined.where(is_new | _changed(hash_col))
    return out.select(*[F.col("s_" + hash_col).alias(hash_col) if c == "s_" + hash_col else F.col(c)
                        for c in s.columns])


def merge_changes(target: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``MERGE`` by key: changed rows replace or join the target rows."""
    keys = list(keys)
    kept = target.join(changed.select(*keys), on=keys, how="left_anti")
    return sync_columns(kept, changed).unionByName(changed)


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Align ``target`` to ``source``'s columns (``sync_all_columns``).

    Columns the source added come out NULL, columns it dropped are removed,
    and types follow the source.
    """
    types = dict(target.dtypes)
    cols = []
    for f in source.schema.fields:
        if f.name in types:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return target.select(*cols)


def apply_changes(
    staged: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    project: Projection = _identity,
    hash_col: str = RAW_HASH,
    validate_keys: bool = True,
    with_change_type: bool = False,
    with_deletes: bool = True,
) -> DataFrame:
    """New state of a certified table after one incremental run.

    ``project`` maps staged rows onto the certified layout (hashing PII,
    renaming, stamping the run time); it is applied to inserted and updated
    rows only, so unchanged rows keep every value of their previous load.
    ``target=None`` is the first load (or a full refresh): every staged row
    is inserted.

    ``with_change_type`` returns the change feed with whole rows instead: the
    new state with a ``_change_type`` per row, and each target row whose key
    left the source, with its old values, as ``delete``; ``with_deletes=False``
    leaves those out, and the state stays partitioned by its key.
    """
    keys = list(keys)
    if target is None:
        if validate_keys:
            assert_unique_keys(staged, keys, "staged source")
        out = project(staged)
        return out.withColumn(CHANGE_TYPE, F.lit(INSERT)) if with_change_type else out
    incoming = project(guard_unique(staged, keys, "staged source") if validate_keys else staged)

    joined, s_hit, t_hit = presence_join(
        incoming, target, keys, "s_", "t_", how="full_outer" if with_change_type and with_deletes else "left")
    take_source = s_hit & (~t_hit | _changed(hash_col))
    target_cols = set(target.columns)
    cols: list[Column] = []
    for f in incoming.schema.fields:
        if f.name in keys:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in target_cols:
            cols.append(
                F.when(take_source, F.col("s_" + f.name))
                .otherwise(F.col("t_" + f.name).cast(f.dataType))
                .alias(f.name)
            )
        else:  # column added since the last run: NULL on unchanged rows
            cols.append(F.when(take_source, F.col("s_" + f.name)).alias(f.name))
    if with_change_type:
        cols.append(_change_type(s_hit, t_hit, hash_col).alias(CHANGE_TYPE))
    return joined.select(*cols)


def apply_changes_stepwise(
    staged: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    project: Projection = _identity,
    hash_col: str = RAW_HASH,
) -> DataFrame:
    """The three-pass form (delete orphans, detect changes, merge).

    Same result as :func:`apply_changes`; kept as the literal recipe and
    used to cross-check the single-pass operator.
    """
    keys = list(keys)
    if target is None:
        return project(staged)
    survivors = delete_orphans(target, staged, keys)
    changed = project(detect_changes(staged, survivors, keys, hash_col))
    return merge_changes(survivors, changed, keys)
