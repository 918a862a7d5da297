"""End-to-end wiring: driver tables -> operational stand-ins -> landing -> models.

:class:`TwoDayPipeline` lands the stand-in operational data for two
consecutive days (see :mod:`lakeward.sources.scenario`) and builds model
runs on top: day 1 is a first load, day 2 an incremental run against the
day-1 certified tables.  Load stamps and run times are fixed literals so
every result is reproducible.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lakeward.operators.keys import guard_unique
from lakeward.operators.landing import LoadStamp, landing_merge_feed, landing_reload
from lakeward.plans.landing_jobs import EXTRACTS, unprinted
from lakeward.plans.models import CDC_MODELS, Run
from lakeward.session import SHUFFLE_CLEANUP, settings
from lakeward.sources.readers import DriverTables
from lakeward.sources.scenario import ROLE_PERMILLE, mark_soft_deleted, yesterday_ops
from lakeward.sources.schemas import ENTITIES
from lakeward.sources.standin import operational_tables

# Fixed load stamps of the two scenario days (UTC, whole seconds).
INGESTED = {1: datetime(2024, 1, 1, 0, 0, 0), 2: datetime(2024, 1, 2, 0, 0, 0)}
RUN_TS = {1: datetime(2024, 1, 1, 1, 0, 0), 2: datetime(2024, 1, 2, 1, 0, 0)}


def load_stamp(entity: str, day: int) -> LoadStamp:
    return LoadStamp(f"batch-d{day}-{entity}", INGESTED[day])


class TwoDayPipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, validate_keys: bool = True,
                 rates: dict[str, int] | None = None):
        self.spark = spark
        self.tables = DriverTables(spark, sf_dir)
        self.validate_keys = validate_keys
        self.rates = {**ROLE_PERMILLE, **(rates or {})}
        self._raw: dict[tuple[str, int, bool], DataFrame] = {}
        self.written_sources: set[str] = set()
        self._runs: dict[int, Run] = {}

    @cached_property
    def today_ops(self) -> dict[str, DataFrame]:
        return operational_tables(self.tables)

    @cached_property
    def yesterday_ops(self) -> dict[str, DataFrame]:
        return yesterday_ops(self.today_ops, self.rates)

    def ops(self, day: int) -> dict[str, DataFrame]:
        return self.today_ops if day == 2 else self.yesterday_ops

    def write_source(self, table: str, folder: str) -> None:
        """Write an operational table in ``folder``; what is built from now on, of either day, reads it there.

        For several jobs over a source that takes a shuffle to make, as order lines do.
        """
        rows = self.today_ops[table]
        with settings(self.spark, {SHUFFLE_CLEANUP: "true"}):
            rows.write.option("compression", "zstd").parquet(f"{folder}/{table}")
        self.today_ops[table] = self.spark.read.schema(rows.schema).parquet(f"{folder}/{table}")
        self.__dict__.pop("yesterday_ops", None)  # made of today's
        self.written_sources.add(table)

    def extract(self, entity: str, day: int) -> DataFrame:
        return EXTRACTS[entity](self.ops(day))

    def raw(self, entity: str, day: int, by_key: bool = False) -> DataFrame:
        """The raw table after day ``day``'s full load; day 2 carries soft deletes.

        Order lines come as their numbering left them, dealt by their order
        (a written source is dealt so again, for the key check and the order
        fact); ``by_key`` deals them by their whole key, as joins of two days
        need them, before they get their fingerprints.
        """
        spec = ENTITIES[entity]
        by_key = by_key and len(spec.key) > 1
        if (entity, day, by_key) not in self._raw:
            rows = unprinted(entity, self.extract(entity, day))
            if by_key:
                rows = rows.repartition(*spec.key)
            elif entity == "order_details" and "sales_order_detail" in self.written_sources:
                rows = rows.repartition("sales_order_id")
            if self.validate_keys:
                # lazy guard inside the query's own plan (one job instead of two), before the fingerprints are made
                rows = guard_unique(rows, spec.key, f"landed {entity}")
            df = landing_reload(rows, spec, load_stamp(entity, day), validate_keys=False)
            if day == 2:
                df = mark_soft_deleted(df, spec.key, self.rates["del"])
            self._raw[(entity, day, by_key)] = df
        return self._raw[(entity, day, by_key)]

    def merge_feed(self, entity: str) -> DataFrame:
        """Day-2 upsert of today's extract into yesterday's raw table.

        Yesterday's table carries soft-deleted rows, so the merge also shows
        that an unchanged soft-deleted row stays deleted.
        """
        spec = ENTITIES[entity]
        current = mark_soft_deleted(self.raw(entity, 1, by_key=True), spec.key, self.rates["del"])
        source = unprinted(entity, self.extract(entity, 2))
        source = source.repartition(*spec.key) if len(spec.key) > 1 else source
        return landing_merge_feed(current, source, spec, load_stamp(entity, 2),
                                  self.validate_keys)

    def run(self, day: int) -> Run:
        if day not in self._runs:
            previous = (lambda name: None) if day == 1 else self._previous
            # a first load's staged rows are a projection of landed ones, whose keys the guard checks in the same plan
            self._runs[day] = Run(raw=lambda e, d=day: self.raw(e, d), run_ts=RUN_TS[day],
                                  previous=previous, validate_keys=self.validate_keys and day > 1,
                                  raw_by_key=lambda e, d=day: self.raw(e, d, by_key=True))
        return self._runs[day]

    def _previous(self, name: str) -> DataFrame | None:
        return self.run(1).ref(name) if name in CDC_MODELS else None
