"""Staging: drop soft-deleted rows and cast every column to its declared type."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.time import ntz
from lakeward.operators.lineage import personal
from lakeward.sources.schemas import IS_DELETED, LINEAGE, LOADED_AT, EntitySpec


def live_rows(raw: DataFrame) -> DataFrame:
    """``WHERE _is_deleted = 0``: a NULL flag drops the row as well.

    A plain boolean predicate, so Parquet row groups are pruned by it.
    """
    return raw.where(F.col(IS_DELETED) == F.lit(False))


def loaded_at(run_ts: datetime):
    """The run's load stamp as a literal (deterministic across reruns)."""
    return ntz(run_ts).alias(LOADED_AT)


def stage(raw: DataFrame, spec: EntitySpec, run_ts: datetime) -> DataFrame:
    """Typed projection of the live rows of one raw table.

    Varchar widths truncate, numbers narrow with ANSI overflow checks, and
    the lineage columns pass through untouched.  Personal fields are marked.
    """
    return live_rows(raw).select(
        *[personal(f.staged(), f.name) if f.name in spec.pii else f.staged() for f in spec.fields],
        *[F.col(c) for c in LINEAGE],
        loaded_at(run_ts),
    )
