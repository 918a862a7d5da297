"""Latest-row-per-key deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _ordering(c: str | Column) -> Column:
    # A bare name means "newest first"; pass a Column for another order.
    return F.col(c).desc() if isinstance(c, str) else c


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    tiebreak: Sequence[str | Column] = (),
) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order_by`` then ``tiebreak``.

    ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) = 1``.  Spark plans
    this as a partial ``WindowGroupLimit`` before the shuffle and a final one
    after it, so a hot key is cut down to one row per input partition before
    it is exchanged.  The tiebreak makes the pick deterministic when several
    rows share the newest timestamp (the normal case within one load).
    """
    order = [_ordering(c) for c in (*order_by, *tiebreak)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)
