"""Join helpers: NULL-key splitting and spreading of hot keys."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_split_nulls(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: str) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` with NULL-keyed left rows spread over all tasks.

    A NULL key can never match, yet a shuffle join would send every
    NULL-keyed row to one reducer; when a third of the rows lack the key that
    task would carry them all.  Such rows are dealt by a hash of ``spread_by``
    in the key's place (whole numbers or text), and the condition still refuses
    them, so ``left`` is scanned once and ``right`` is dealt by its own key.
    """
    kind = left.schema[left_key].dataType
    most = {"byte": 1 << 7, "short": 1 << 15}.get(kind.typeName(), 1 << 31)
    place = F.coalesce(left[left_key], F.pmod(F.xxhash64(left[spread_by]), F.lit(most)).cast(kind))
    return left.join(right, (place == right[right_key]) & left[left_key].isNotNull(), "left")


#: Keys that a sketch tracks, and the most that it reports.
TRACKED, REPORTED = 4096, 256


def heavy_keys(rows: DataFrame, key: str, least_share: float) -> dict[object, float]:
    """The values of ``key`` (NULL among them) with at least ``least_share`` of all rows, and their shares.

    One aggregation over the key column: a sketch of bounded size (at most
    ``REPORTED`` values come to the driver), which never counts a value too
    low by more than its error, a small part of ``least_share``.
    """
    counted = rows.agg(
        F.expr(f"approx_top_k(`{key}`, {REPORTED}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(key).isNull()).alias("nulls")).first()
    shares = {r["item"]: r["count"] / counted["n"] for r in counted["top"] or () if r["item"] is not None}
    if counted["n"]:
        shares[None] = counted["nulls"] / counted["n"]
    return {k: s for k, s in shares.items() if s >= least_share}


def left_join_spread(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: str, tasks: int | None = None,
) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` with the left rows of heavy keys spread over tasks.

    For a right side that is itself an aggregate (a distinct key set): AQE does
    not split skewed joins of that shape, so one hot key would be one task.  A
    key is heavy if it has more than a task's share of the left rows
    (``tasks`` is by default the number of shuffle partitions); it is spread
    over as many copies of its right rows as it has such shares, by a hash of
    ``spread_by``.  All other keys have one copy, and without heavy keys this
    is a plain join.  Heavy NULL keys match nothing and are spread over all tasks.
    """
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(left, left_key, 1 / tasks) if tasks > 1 else {}
    on = F.col(left_key) == F.col(right_key)
    copies = {k: min(tasks, ceil(share * tasks) + 1) for k, share in heavy.items() if k is not None}
    if not heavy:
        return left.join(right, on, "left")
    number = lambda key: reduce(
        lambda rest, k: F.when(F.col(key) == F.lit(k), F.lit(copies[k])).otherwise(rest), copies, F.lit(1))
    turn = F.xxhash64(spread_by)
    salt = F.when(F.col(left_key).isNull(), turn).otherwise(F.pmod(turn, number(left_key))) if None in heavy else F.pmod(
        turn, F.coalesce(number(left_key), F.lit(1)))
    left = left.withColumn("__turn", salt.cast("long"))
    right = right.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), number(right_key).cast("long") - 1)))
    return left.join(right, on & (F.col("__turn") == F.col("__copy")), "left").drop("__turn", "__copy")
