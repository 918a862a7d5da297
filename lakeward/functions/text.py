"""Text scalars with the source system's semantics expressed as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: str | Column) -> Column:
    """Render any value as text (Spark's own text form for numbers)."""
    return _col(c).cast(StringType())


def clip(c: str | Column, length: int) -> Column:
    """``CAST(c AS VARCHAR(length))``: text truncated to ``length`` chars.

    Spark's own ``CAST AS VARCHAR(n)`` keeps the full string, so the
    truncation is explicit.
    """
    return F.left(as_text(c), F.lit(length))


def trim_spaces(c: str | Column) -> Column:
    """``LTRIM(RTRIM(c))``: strips spaces only; tabs and newlines stay."""
    return F.trim(_col(c))


def clean_upper(c: str | Column) -> Column:
    """Normalised display text: ``UPPER(LTRIM(RTRIM(c)))``."""
    return F.upper(trim_spaces(c))


def clean_lower(c: str | Column) -> Column:
    """Normalised e-mail style text: ``LOWER(LTRIM(RTRIM(c)))``."""
    return F.lower(trim_spaces(c))


def concat_nullsafe(*cols: str | Column) -> Column:
    """``CONCAT(a, b, ...)`` where NULL parts count as ''."""
    return F.concat(*[F.coalesce(as_text(c), F.lit("")) for c in cols])


def concat_strict(*cols: str | Column) -> Column:
    """``a + b + ...`` string concatenation: NULL if any part is NULL."""
    return F.concat(*[as_text(c) for c in cols])


def date_text(c: str | Column) -> Column:
    """``CONVERT(VARCHAR(10), d, 120)``: ISO ``yyyy-MM-dd`` text of a date."""
    return F.date_format(_col(c).cast(DateType()), "yyyy-MM-dd")
