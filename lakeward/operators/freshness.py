"""Source freshness: age of the newest row against warn/error thresholds."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.operators.frames import union_all
from pyspark.sql import types as T

from lakeward.functions.time import ntz
from lakeward.sources.schemas import INGESTED_AT, EntitySpec


def freshness(
    df: DataFrame,
    source: str,
    as_of: datetime,
    warn_after_days: int,
    error_after_days: int,
    loaded_at_field: str = INGESTED_AT,
) -> DataFrame:
    """One row: newest load time, its age and ``pass`` / ``warn`` / ``error``.

    ``as_of`` is passed in (never ``now()`` inside the plan) so the check is
    reproducible.  A table with no rows has no newest load and is ``error``.
    """
    now = ntz(as_of)
    newest = F.max(F.col(loaded_at_field).cast(T.TimestampNTZType()))
    age_s = F.timestamp_diff("SECOND", newest, now)
    status = (
        F.when(newest.isNull(), "error")
        .when(age_s > error_after_days * 86400, "error")
        .when(age_s > warn_after_days * 86400, "warn")
        .otherwise("pass")
    )
    return df.agg(
        F.lit(source).alias("source"),
        newest.alias("max_loaded_at"),
        (age_s / 3600.0).alias("age_hours"),
        F.lit(warn_after_days).alias("warn_after_days"),
        F.lit(error_after_days).alias("error_after_days"),
        status.alias("status"),
    )


def check_freshness(raw_tables: Mapping[str, tuple[DataFrame, EntitySpec]], as_of: datetime) -> DataFrame:
    """Freshness of every raw table (name -> (DataFrame, spec)) in one DataFrame."""
    parts = [
        freshness(df, f"{spec.raw_schema_name}.{spec.name}", as_of,
                  spec.freshness_warn_days, spec.freshness_error_days)
        for _, (df, spec) in raw_tables.items()
    ]
    return union_all(parts)
