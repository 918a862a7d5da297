"""Fixed-point order maths with the source system's decimal widths.

Spark's decimal rules (``allowPrecisionLoss=true``) give ``decimal(38,6)``
for both products, which is exact for every value the staged widths can
hold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

QTY = DecimalType(18, 2)
PRICE = DecimalType(18, 4)
DISCOUNT = DecimalType(6, 4)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_total_net(qty: str | Column, price: str | Column, discount: str | Column) -> Column:
    """``qty * price * (1 - discount)`` at the staged decimal widths."""
    return _col(qty).cast(QTY) * _col(price).cast(PRICE) * (F.lit(1) - _col(discount).cast(DISCOUNT))


def discount_amount(qty: str | Column, price: str | Column, discount: str | Column) -> Column:
    """``qty * price * discount`` at the staged decimal widths."""
    return _col(qty).cast(QTY) * _col(price).cast(PRICE) * _col(discount).cast(DISCOUNT)
