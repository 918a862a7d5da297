"""Load audits: per-table row counts and per-source batch summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.operators.frames import union_all

from lakeward.sources.schemas import BATCH_ID, INGESTED_AT, SOURCE_ENTITY


def load_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, row_count)`` for every named table, ordered by name.

    One global count per table; the union runs as a single job.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
             for name, df in tables.items()]
    return union_all(parts).orderBy("table")


def batch_audit(raw_tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per source entity: rows, first load time and distinct batches.

    A first full load must show exactly one batch per entity.
    """
    cols = [SOURCE_ENTITY, INGESTED_AT, BATCH_ID]
    unioned = union_all([df.select(*cols) for df in raw_tables.values()])
    return unioned.groupBy(SOURCE_ENTITY).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(INGESTED_AT).alias("first_ingested_at"),
        F.count_distinct(BATCH_ID).alias("batches"),
    )


def tables_per_layer(models: Mapping[str, object]) -> list[tuple[str, int]]:
    """``(layer, number of models)`` from the model catalog (no data is read)."""
    counts: dict[str, int] = {}
    for info in models.values():
        counts[info.layer] = counts.get(info.layer, 0) + 1
    return sorted(counts.items())
