"""The chain on written tables: landing upsert, landed tables, staging, certified tables.

Day 1 lands and publishes everything in full; day 2 upserts the new extracts
into the landed tables, flags what the source deleted and publishes what
changed.  So landed rows carry the batch and second of the load that last
changed them, and every run reads its previous state from storage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.frames import input_bytes
from lakeward.operators.landing import fingerprinted, landing_merge_feed, landing_reload
from lakeward.operators.table_store import TableStore
from lakeward.plans.landing_jobs import unprinted
from lakeward.plans.pipeline import RUN_TS, TwoDayPipeline, load_stamp
from lakeward.plans.runner import run_project, schema_of
from lakeward.session import shared_folder
from lakeward.sources.scenario import picked
from lakeward.sources.schemas import ENTITIES, IS_DELETED, RAW_HASH

#: Entities that one task reads.
SMALL = ("departments",)
#: Roles of keys whose extract has no fingerprint on day 1 and on day 2, and their share in permille.
UNPRINTED = {1: "nil", 2: "nul"}
UNPRINTED_PERMILLE = 20
#: Operational tables that a shuffle makes, which are written once, for three jobs read them.
WRITTEN = {"order_details": "sales_order_detail"}
#: Bytes of an extract's files for each bucket: about 0.4 M order lines, which a task sorts in memory with all columns that
#: landing adds.  Rows that are spilled take several times the table's size on disk.
BUCKET_BYTES, MOST_BUCKETS = 8 << 20, 8192


def scratch_store(spark: SparkSession, buckets: int | None = None) -> TableStore:
    """A store of its own in the shared folder, for one query."""
    name = f"lakeward_{uuid4().hex[:10]}"
    buckets = buckets or min(int(spark.conf.get("spark.sql.shuffle.partitions")), 64)
    return TableStore(spark, f"{shared_folder(spark)}/{name}", buckets, prefix=f"{name}_")


class StoredChain:
    """Two days of the scenario on a store's tables.

    ``unprinted`` leaves the fingerprint out of some keys' extracts.
    """

    def __init__(self, store: TableStore, source: TwoDayPipeline, unprinted: bool = False):
        self.store, self.source, self.unprinted = store, source, unprinted

    def unprinted_extract(self, entity: str, day: int) -> DataFrame:
        """The extract before :meth:`printed`: its fingerprints are made after the rows are dealt, where they can be."""
        return unprinted(entity, self.source.extract(entity, day))

    def printed(self, entity: str, day: int) -> Callable[[DataFrame], DataFrame]:
        spec = ENTITIES[entity]
        none = picked(spec.key, UNPRINTED[day], UNPRINTED_PERMILLE) if self.unprinted else F.lit(False)
        return lambda rows: fingerprinted(rows, spec).withColumn(RAW_HASH, F.when(~none, F.col(RAW_HASH)))

    def extract(self, entity: str, day: int) -> DataFrame:
        return self.printed(entity, day)(self.unprinted_extract(entity, day))

    def raw(self, entity: str, parts: Sequence[int] | None = None) -> DataFrame:
        """A landed table, or some of its buckets."""
        schema = ENTITIES[entity].raw_schema_name
        return self.store.current(schema, entity) if parts is None else self.store.part(schema, entity, parts)

    def buckets(self, entity: str) -> int:
        """As many buckets as an entity's landed and certified tables get: more than the store's number for large extracts."""
        if entity in SMALL:
            return 1
        return max(self.store.buckets, min(MOST_BUCKETS, ceil(input_bytes(self.source.extract(entity, 2)) / BUCKET_BYTES)))

    def write_source(self, entity: str) -> None:
        """Write what the entity's extracts shuffle to make, beside the store's tables, the first time it is asked for."""
        if entity in WRITTEN and WRITTEN[entity] not in self.source.written_sources:
            self.source.write_source(WRITTEN[entity], f"{self.store.base}/source")

    def land_full(self, entity: str) -> int:
        """Day 1: the landed table is a stamped copy of the extract; its keys are checked while it is written."""
        spec = ENTITIES[entity]
        self.write_source(entity)
        stamped = lambda rows: landing_reload(self.printed(entity, 1)(rows), spec, load_stamp(entity, 1), validate_keys=False)
        return self.store.replace(spec.raw_schema_name, entity, self.unprinted_extract(entity, 1), spec.key,
                                  buckets=self.buckets(entity), finish=stamped)

    def land_changes(self, entity: str) -> dict[str, int]:
        """Day 2: upsert the buckets of the landed table whose extract changed, and flag the landed rows the source deleted."""
        spec = ENTITIES[entity]
        deleted = picked(spec.key, "del", self.source.rates["del"])
        gone = lambda landed: landed.where(deleted & ~F.col(IS_DELETED)).select(*spec.key).distinct()
        # a key lies in one bucket, so what is gone of some buckets is found in these
        change = lambda source, current: landing_merge_feed(
            current, source, spec, load_stamp(entity, 2), gone=gone(current))
        return self.store.upsert(spec.raw_schema_name, entity, self.unprinted_extract(entity, 2), spec.key, change,
                                 touching=gone(self.raw(entity)), finish=self.printed(entity, 2))

    def first_day(self, entities=tuple(ENTITIES), select=None) -> dict[str, dict[str, int]]:
        for e in entities:
            self.land_full(e)
        # staged rows are a filtered projection of landed ones, whose keys were checked
        return run_project(self.store, self.raw, RUN_TS[1], select=select, validate_keys=False, laid=True)

    def second_day(self, entities=tuple(ENTITIES), select=None) -> dict[str, dict[str, int]]:
        counts = {e: self.land_changes(e) for e in entities}
        return {**counts, **run_project(self.store, self.raw, RUN_TS[2], select=select, laid=True)}

    def drop(self, entity: str, cert: str | None = None) -> None:
        """Remove an entity's landed table, and a certified one, that nothing reads any more."""
        self.store.drop(ENTITIES[entity].raw_schema_name, entity)
        if cert:
            self.store.drop(schema_of(cert), cert)
