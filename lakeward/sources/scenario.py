"""Two-day change scenario for exercising incremental runs on driver data.

Day 2 ("today") is the stand-in operational data as is.  Day 1
("yesterday") is derived from it so that an incremental run sees every
kind of change:

* ``new``  – rows absent yesterday (today they are inserts);
* ``chg``  – rows whose fingerprinted payload differed yesterday (updates);
* ``gone`` – rows present only yesterday, under a key that no longer
  exists (orphans the run must delete);
* ``del``  – rows the source soft-deletes today (``_is_deleted``).

Which rows play which role is decided by a hash of the key and a role tag,
so the choice is spread evenly and reproducible in any SQL engine that has
``md5``.  The library code that runs on these inputs never sees the roles:
it has to find every change by joining and comparing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.sources.schemas import IS_DELETED

# Share of keys per role, in permille.
ROLE_PERMILLE = {"new": 80, "chg": 100, "gone": 50, "del": 30}


def role_threshold(permille: int) -> str:
    """Three-hex-digit upper bound selecting ``permille`` of md5 space."""
    return format(permille * 4096 // 1000, "03x")


def picked(keys: Sequence[str], role: str, permille: int | None = None) -> Column:
    """True for the keys that play ``role`` (md5 of role and key, prefix test)."""
    permille = ROLE_PERMILLE[role] if permille is None else permille
    text = F.concat_ws(":", F.lit(role), *[F.col(k).cast(T.StringType()) for k in keys])
    return F.substring(F.md5(text), 1, 3) < F.lit(role_threshold(permille))


@dataclass(frozen=True)
class Mutation:
    table: str                      # operational table holding the entity rows
    keys: tuple[str, ...]           # its key columns
    column: str                     # fingerprinted column that differed yesterday
    old_value: Callable[[Column], Column]


MUTATIONS = {
    "customers": Mutation("customer", ("CustomerID",), "AccountNumber",
                          lambda c: F.concat(c, F.lit("-OLD"))),
    "addresses": Mutation("address", ("AddressID",), "AddressLine1",
                          lambda c: F.concat(c, F.lit(" (old)"))),
    "order_headers": Mutation("sales_order_header", ("SalesOrderID",), "RevisionNumber",
                              lambda c: (c + 1).cast(T.ShortType())),
    "order_details": Mutation("sales_order_detail", ("SalesOrderID", "SalesOrderDetailID"), "OrderQty",
                              lambda c: (c + 1).cast(T.ShortType())),
    "products": Mutation("product", ("ProductID",), "ListPrice",
                         lambda c: (c + F.lit(Decimal(1))).cast(T.DecimalType(19, 4))),
    "employees": Mutation("employee", ("BusinessEntityID",), "JobTitle",
                          lambda c: F.concat(c, F.lit(" (old)"))),
    "departments": Mutation("department", ("DepartmentID",), "GroupName",
                            lambda c: F.concat(c, F.lit(" (old)"))),
}


def yesterday_table(today: DataFrame, m: Mutation, rates: dict[str, int] | None = None) -> DataFrame:
    """Yesterday's version of one operational entity table."""
    r = {**ROLE_PERMILLE, **(rates or {})}
    new, chg, gone = (picked(m.keys, role, r[role]) for role in ("new", "chg", "gone"))
    # One pass: each row yields itself (variant 0) unless it is new, plus a
    # copy under a vanished key (variant 1) if it is gone.
    variants = F.filter(
        F.array(F.when(~new, F.lit(0)), F.when(gone, F.lit(1))), lambda v: v.isNotNull()
    )
    first = m.keys[0]
    rows = today.withColumn("__variant", F.explode(variants))
    is_copy = F.col("__variant") == 1
    return rows.select(*[
        F.when(is_copy, (-(F.col(c) + 1)).cast(today.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c == first else
        F.when(~is_copy & chg, m.old_value(F.col(c))).otherwise(F.col(c)).alias(c)
        if c == m.column else F.col(c)
        for c in today.columns
    ])


def yesterday_ops(today_ops: dict[str, DataFrame], rates: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Operational tables as they were one day earlier."""
    ops = dict(today_ops)
    for m in MUTATIONS.values():
        ops[m.table] = yesterday_table(today_ops[m.table], m, rates)
    return ops


def mark_soft_deleted(raw: DataFrame, keys: Sequence[str], permille: int | None = None) -> DataFrame:
    """Flag the rows the source soft-deleted (``_is_deleted = true``)."""
    return raw.withColumn(IS_DELETED, F.col(IS_DELETED) | picked(keys, "del", permille))
