"""Readers for raw tables and for the driver's Parquet tables.

Every raw read uses an explicit schema (never inference), and drift fails
loudly.  Parquet and ORC files carry a schema, which is compared with the
declared one before reading: a column that is absent or has another type
raises :class:`SchemaDriftError`.  Text formats are read in ``FAILFAST`` mode,
so a value that does not parse fails the job that reads its column, and a CSV
header must name the declared columns.  An absent JSON field reads as NULL.
Parquet is the default because filters and column pruning reach its row
groups.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakeward.sources.schemas import EntitySpec


#: Formats whose files carry their schema.
SELF_DESCRIBING = ("parquet", "orc")


class SchemaDriftError(ValueError):
    """Files of a raw table do not have the declared columns and types."""


def read_raw(
    spark: SparkSession,
    path: str,
    spec: EntitySpec,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Scan a raw table in any Spark file format with its declared schema.

    Columns beyond the declared ones are not read.
    """
    if fmt in SELF_DESCRIBING:
        found = {f.name: f.dataType for f in spark.read.format(fmt).options(**options).load(path).schema.fields}
        drift = [f"{f.name}: {found[f.name].simpleString() if f.name in found else 'absent'}, declared "
                 f"{f.dataType.simpleString()}" for f in spec.raw_schema.fields if found.get(f.name) != f.dataType]
        if drift:
            raise SchemaDriftError(f"{path}: " + "; ".join(drift))
    else:
        options = {"mode": "FAILFAST", "enforceSchema": "false", **options}
    return spark.read.schema(spec.raw_schema).format(fmt).options(**options).load(path)


def raw_path(base_path: str, spec: EntitySpec) -> str:
    """``<base>/raw_<system>/<table>``: the configurable source location."""
    return os.path.join(base_path, spec.raw_schema_name, spec.name)


@dataclass
class DriverTables:
    """Lazy access to ``<sf_dir>/<name>.parquet`` (one DataFrame per name)."""

    spark: SparkSession
    sf_dir: str
    _cache: dict[str, DataFrame] = field(default_factory=dict)

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._cache[name]
