"""Landing: stamp source rows with lineage and upsert them into a raw table.

* :func:`stamp` adds the seven lineage columns to a source extract.
* :func:`landing_reload` is the truncate-and-reload load: a full stamped copy.
* :func:`landing_merge` is the fingerprint-guarded upsert: one full outer
  join on the primary key classifies every key as inserted, updated,
  unchanged or kept (present only in the current table), and a single
  projection writes the new raw state.  Only the entity's listed update
  columns are overwritten on a changed row; everything else keeps its
  first-insert value.

Batch id and ingestion time are driver-side literals (one per table load),
never per-row ``uuid()``/``now()`` calls, so a load is deterministic and
re-runnable.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.hashing import row_fingerprint
from lakeward.functions.time import ntz
from lakeward.operators.keys import assert_unique_keys, guard_unique, presence_join
from lakeward.sources.schemas import (
    BATCH_ID,
    INGESTED_AT,
    IS_DELETED,
    LINEAGE,
    PIPELINE_NAME,
    RAW_HASH,
    SOURCE_ENTITY,
    SOURCE_SYSTEM,
    EntitySpec,
)

CHANGE_TYPE = "_change_type"
GONE = "__gone"


@dataclass(frozen=True)
class LoadStamp:
    """Batch id and UTC ingestion second shared by every row of one table load."""

    batch_id: str
    ingested_at: datetime

    @staticmethod
    def new(now: datetime | None = None) -> LoadStamp:
        now = now or datetime.now(UTC)
        return LoadStamp(str(uuid.uuid4()), now.replace(microsecond=0, tzinfo=None))

    def ingested_col(self) -> Column:
        return ntz(self.ingested_at)


def fingerprinted(source: DataFrame, spec: EntitySpec) -> DataFrame:
    """Add ``_raw_hash`` over the entity's fingerprint columns unless present."""
    if RAW_HASH in source.columns:
        return source
    return source.withColumn(
        RAW_HASH, row_fingerprint(list(spec.fingerprint), spec.fingerprint_encoding)
    )


def _payload_cols(spec: EntitySpec, prefix: str = "") -> list[Column]:
    return [F.col(prefix + f.name).cast(f.raw_type).alias(f.name) for f in spec.fields]


def stamp(source: DataFrame, spec: EntitySpec, load: LoadStamp) -> DataFrame:
    """Project a source extract onto the raw schema with fresh lineage columns."""
    src = fingerprinted(source, spec)
    return src.select(
        *_payload_cols(spec),
        load.ingested_col().alias(INGESTED_AT),
        F.lit(spec.system).alias(SOURCE_SYSTEM),
        F.lit(spec.name).alias(SOURCE_ENTITY),
        F.lit(spec.pipeline_name).alias(PIPELINE_NAME),
        F.lit(load.batch_id).alias(BATCH_ID),
        F.col(RAW_HASH).cast(T.StringType()).alias(RAW_HASH),
        F.lit(False).alias(IS_DELETED),
    )


def landing_reload(
    source: DataFrame, spec: EntitySpec, load: LoadStamp, validate_keys: bool = True
) -> DataFrame:
    """Truncate-and-reload: the new raw table is a stamped copy of the extract."""
    if validate_keys:
        assert_unique_keys(source, spec.key, f"landing source {spec.name}")
    return stamp(source, spec, load)


def landing_merge_feed(
    current: DataFrame | None,
    source: DataFrame,
    spec: EntitySpec,
    load: LoadStamp,
    validate_keys: bool = True,
    gone: DataFrame | None = None,
) -> DataFrame:
    """New raw state plus a ``_change_type`` column per row.

    ``_change_type`` is ``insert`` (key only in the extract), ``update``
    (both sides, fingerprints differ), ``unchanged`` (both sides, equal or
    NULL fingerprint) or ``kept`` (key only in the current table: the upsert
    never deletes).  A duplicate key in the extract would make the merge
    ambiguous, so it fails the job.

    ``gone`` holds different keys whose rows are flagged as soft-deleted after
    that.  They are looked up on both sides before these are joined: the state,
    which a full outer join leaves without a partitioning, is not shuffled again.
    """
    if current is None:
        return landing_reload(source, spec, load, validate_keys).withColumn(CHANGE_TYPE, F.lit("insert"))
    if validate_keys:  # guard inside the merge join's own shuffle: no extra pass, and fingerprints are made after it
        source = guard_unique(source, spec.key, f"landing source {spec.name}")
    stamped = stamp(source, spec, load)

    if gone is not None:
        marked = gone.select(*spec.key, F.lit(True).alias(GONE))
        stamped, current = (side.join(marked, list(spec.key), "left") for side in (stamped, current))
    joined, s_hit, t_hit = presence_join(stamped, current, list(spec.key), "s_", "t_")
    # Three-valued <>: a NULL fingerprint on either side is "not changed".
    changed = s_hit & t_hit & (F.col("s_" + RAW_HASH) != F.col("t_" + RAW_HASH))
    changed = F.coalesce(changed, F.lit(False))
    insert = s_hit & ~t_hit
    change_type = (
        F.when(insert, "insert")
        .when(changed, "update")
        .when(t_hit & ~s_hit, "kept")
        .otherwise("unchanged")
    )

    cols: list[Column] = []
    updatable = set(spec.update_columns)
    for f in spec.fields:
        name = f.name
        if name in spec.key:
            cols.append(F.col(name).cast(f.raw_type).alias(name))
        elif name in updatable:
            cols.append(
                F.when(insert | changed, F.col("s_" + name)).otherwise(F.col("t_" + name))
                .cast(f.raw_type).alias(name)
            )
        else:
            cols.append(
                F.when(insert, F.col("s_" + name)).otherwise(F.col("t_" + name))
                .cast(f.raw_type).alias(name)
            )
    restamped = {INGESTED_AT, BATCH_ID, RAW_HASH}
    for name in LINEAGE:
        if name in restamped:
            cols.append(F.when(insert | changed, F.col("s_" + name)).otherwise(F.col("t_" + name)).alias(name))
        elif name == IS_DELETED:
            # The flag is reset only on a changed row; an unchanged
            # soft-deleted row stays deleted.
            flag = F.when(insert | changed, F.lit(False)).otherwise(F.col("t_" + name))
            if gone is not None:
                flag = flag | F.coalesce("s_" + GONE, "t_" + GONE, F.lit(False))
            cols.append(flag.alias(name))
        else:
            cols.append(F.when(insert, F.col("s_" + name)).otherwise(F.col("t_" + name)).alias(name))
    cols.append(change_type.alias(CHANGE_TYPE))
    return joined.select(*cols)


def landing_merge(
    current: DataFrame | None,
    source: DataFrame,
    spec: EntitySpec,
    load: LoadStamp,
    validate_keys: bool = True,
) -> DataFrame:
    """Fingerprint-guarded upsert of an extract into the current raw table."""
    return landing_merge_feed(current, source, spec, load, validate_keys).drop(CHANGE_TYPE)


def rows_affected(feed: DataFrame) -> DataFrame:
    """Rows a merge inserted or updated (the load's affected-row count)."""
    return feed.where(F.col(CHANGE_TYPE).isin("insert", "update")).agg(
        F.count(F.lit(1)).alias("rows_affected")
    )


def append_stamp(source: DataFrame, source_system: str, load_ts: datetime) -> DataFrame:
    """Stamp an extract for the append-only landing layout.

    Adds ``_load_ts`` (load time), ``_load_dt`` (its date), ``_source_system``
    and ``_is_active = true``; the result is meant for
    ``df.write.mode("append")`` (each load adds rows, nothing is merged).
    """
    ts = ntz(load_ts)
    return source.select(
        "*",
        ts.alias("_load_ts"),
        ts.cast(T.DateType()).alias("_load_dt"),
        F.lit(source_system).alias(SOURCE_SYSTEM),
        F.lit(True).alias("_is_active"),
    )
