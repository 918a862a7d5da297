"""Time literals that do not depend on any time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ntz(value: datetime) -> Column:
    """A ``TIMESTAMP_NTZ`` literal with exactly ``value``'s wall-clock time.

    Built from text, so neither the Python process's nor the Spark session's
    time zone can shift it (a ``datetime`` literal would pass through both).
    """
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast(T.TimestampNTZType())
