"""Declared tables: widths, defaults and required columns that every load must meet.

A :class:`DeclaredTable` is a Spark catalog table with CHAR / VARCHAR widths and
DEFAULT values, both of which Spark itself applies: a value over its width fails
the load, and a column that a load leaves out gets its default.  Spark does not
enforce NOT NULL on such tables, so :func:`load` adds the check to the rows that
it writes.  A NULL in a required column fails the job.

Loads are idempotent.  A load's rows lie in a partition of their own, named by
date and load id, and a load replaces its own partition alone (dynamic
partition overwrite).  So a load that is repeated after a crash, or is repeated
with other rows, adds nothing twice; a repeated load without rows leaves none.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.time import ntz

LOAD_TS, LOAD_DT, LOAD_ID = "_load_ts", "_load_dt", "_load_id"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class DeclaredColumn:
    name: str
    type: str                    # SQL type, e.g. VARCHAR(10)
    required: bool = False       # NOT NULL
    default: str | None = None   # SQL literal

    @property
    def ddl(self) -> str:
        return f"`{self.name}` {self.type}" + (f" DEFAULT {self.default}" if self.default else "")


@dataclass(frozen=True)
class DeclaredTable:
    name: str
    columns: tuple[DeclaredColumn, ...]

    def create(self, spark: SparkSession, database: str) -> str:
        """Create the table in ``database`` unless it is there; returns its full name."""
        full = f"`{database}`.`{self.name}`"
        lineage = (f"`{LOAD_TS}` TIMESTAMP_NTZ", f"`{LOAD_DT}` DATE", f"`{LOAD_ID}` STRING")
        columns = ", ".join((*[c.ddl for c in self.columns], *lineage))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet PARTITIONED BY ({LOAD_DT}, {LOAD_ID})")
        return full


def checked(rows: DataFrame, table: DeclaredTable) -> DataFrame:
    """``rows`` with a check on every required column; columns the table lacks, or required ones left out, raise here."""
    known = {c.name: c for c in table.columns}
    unknown = [c for c in rows.columns if c not in known]
    if unknown:
        raise ValueError(f"{table.name} has no columns {unknown}")
    absent = [c.name for c in table.columns if c.required and c.default is None and c.name not in rows.columns]
    if absent:
        raise ValueError(f"{table.name} needs {absent}")
    refuse = lambda c: F.raise_error(F.lit(f"{table.name}.{c} is NULL"))
    return rows.select(*[
        F.when(F.col(c).isNull(), refuse(c)).otherwise(F.col(c)).alias(c) if known[c].required else F.col(c)
        for c in rows.columns])


def load(rows: DataFrame, table: DeclaredTable, database: str, load_id: str, load_ts: datetime) -> int:
    """Write ``rows`` as load ``load_id`` in place of what that load wrote before; returns the number of rows."""
    spark, full, seen = rows.sparkSession, table.create(rows.sparkSession, database), Observation()
    stamped = checked(rows, table).select(
        "*", ntz(load_ts).alias(LOAD_TS), ntz(load_ts).cast("date").alias(LOAD_DT), F.lit(load_id).alias(LOAD_ID))
    stamped = stamped.observe(seen, F.count(F.lit(1)).alias("rows"))
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        spark.sql(f"INSERT OVERWRITE {full} BY NAME SELECT * FROM {{stamped}}", stamped=stamped)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
    written = seen.get.get("rows", 0)
    if not written:  # an overwrite without rows leaves the partition as it was
        spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION ({LOAD_DT} = DATE '{load_ts.date()}', {LOAD_ID} = '{load_id}')")
    return written


def history(spark: SparkSession, table: DeclaredTable, database: str) -> DataFrame:
    """All rows of all loads."""
    return spark.table(f"`{database}`.`{table.name}`").drop(LOAD_ID)
