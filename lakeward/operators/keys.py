"""Key helpers shared by the landing and CDC operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HIT = "__hit"


class DuplicateKeyError(ValueError):
    """A merge source matched one target key more than once."""


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (NULL keys included).

    A plain aggregation: the partial (map-side) count collapses even a hot
    key to one row per input partition before the shuffle.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise :class:`DuplicateKeyError` if ``keys`` is not unique in ``df`` or holds a NULL.

    Brings at most one row to the driver.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    bad = counted.where((F.col("n") > 1) | _any_null(keys)).limit(1).collect()
    if bad:
        raise DuplicateKeyError(f"{what}: key {list(keys)} is not unique or NULL, e.g. {bad[0].asDict()}")


def guard_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """``df`` that fails its job when a key value repeats or is NULL.

    No extra pass: the guard is a ``row_number`` over ``partitionBy(keys)``,
    whose hash exchange and sort are exactly what a following sort-merge
    join on ``keys`` needs, so Spark reuses them.  The job fails when a
    duplicated key's group is evaluated (Spark's window operator buffers
    that group, spilling to disk if it is large).
    """
    keys = list(keys)
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    msg = F.concat(F.lit(f"{what}: key {keys} is not unique or NULL, e.g. "),
                   F.to_json(F.struct(*[F.col(k) for k in keys])))
    numbered = df.withColumn("__key_rn", rn)
    return numbered.where(F.when((F.col("__key_rn") > 1) | _any_null(keys), F.raise_error(msg)).isNull()).drop("__key_rn")


def presence_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_prefix: str,
    right_prefix: str,
    how: str = "full_outer",
) -> tuple[DataFrame, Column, Column]:
    """Join on ``keys`` with an explicit presence marker per side.

    Non-key columns are prefixed so both sides can be addressed; the key
    columns come out coalesced from a full outer join, and are the left side's
    from a left join, which so stays partitioned by them.  Presence is tested on the marker, never on
    ``key IS NULL``, so a NULL in a payload column cannot be mistaken for a
    missing row.
    """
    keys = list(keys)

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            *[F.col(k) for k in keys],
            *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys],
            F.lit(True).alias(prefix + HIT),
        )

    joined = side(left, left_prefix).join(side(right, right_prefix), on=keys, how=how)
    return joined, F.col(left_prefix + HIT).isNotNull(), F.col(right_prefix + HIT).isNotNull()
