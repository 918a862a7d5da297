"""Tables of a Spark catalog that incremental runs rewrite by key bucket.

A keyed table is written with Spark's own bucketing: ``n`` buckets of the key's
hash, each of them a partition directory too, so that

- a join on the key reads the table as it lies, without an exchange;
- a run overwrites the buckets it changed and no others (dynamic partition
  overwrite), and Spark's committer puts them in place at the end of the job;
  many buckets are overwritten by a few jobs, each of some buckets.

Beside each table lies a digest for every bucket: the number of source rows that
were last applied to it and two order-free sums of hashes of their keys and
fingerprints.  :meth:`TableStore.upsert` makes the same digests of the new source
in one aggregation over keys and fingerprints.  Where they are equal, the source
holds the rows it held when it was last applied, and applying it again would
change nothing; only the other buckets are read, joined and written.  A source
without changes joins no bucket and writes nothing.  (Two different sources
have equal digests with a probability of about 2^-120 for each bucket.)

Applying a source twice is the same as applying it once, and digests are written
after the data.  So a run that dies halfway is mended by the next one.

A full rewrite goes to a new table; a view by the table's name then points to it,
which is one step of the catalog, and the old one is dropped.  So a refused or
crashed write leaves the table as it was, and a table may be rewritten from
itself.  Tables lie in ``<base>/<schema>/``, a database for each layer's schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.keys import guard_unique
from lakeward.session import SHUFFLE_CLEANUP, settings
from lakeward.sources.schemas import IS_DELETED, RAW_HASH

PART = "_part"
CHANGE_TYPE = "_change_type"
CHANGES = ("insert", "update", "unchanged", "kept")
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
#: Files that a task holds open before its rows are sorted by file.  A task writes one bucket, so they never are: rows come
#: in the order of their keys, and a second sort would spill them at full width, with fingerprints and lineage.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
WRITING = {SHUFFLE_CLEANUP: "true", OPEN_FILES: "4"}
#: An upsert of more buckets than the first works in as many jobs as the second, which put their buckets in place one after
#: another, so shuffle files, spilled rows and the buckets' old and new files lie on disk for one job's share at a time.
JOB_BUCKETS, JOBS = 64, 4
#: Fingerprints and hashes are random hex digits, which take half as much in this as in Spark's default.
COMPRESSION = "zstd"

#: New state of the touched buckets, with a ``_change_type`` for each row, from source and current rows.
Change = Callable[[DataFrame, DataFrame], DataFrame]
#: Columns that are made from a row's others.
Finish = Callable[[DataFrame], DataFrame]
Digests = dict[int, tuple[int, int, int]]


def _as_is(rows: DataFrame) -> DataFrame:
    return rows


def part_of(keys: Sequence[str], buckets: int) -> Column:
    """A row's bucket: the same number as Spark's bucketing gives it."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def bucket_digests(rows: DataFrame, keys: Sequence[str], buckets: int, hash_col: str = RAW_HASH) -> DataFrame:
    """_part, n, d0, d1: for each bucket the number of rows and order-free sums of hashes of keys and fingerprints.

    Partial sums are made map-side, so one row of each task and bucket is shuffled.
    """
    facts = [*keys, F.col(hash_col).isNull(), hash_col]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *facts).cast("decimal(20,0)"))
    return rows.groupBy(part_of(keys, buckets).alias(PART)).agg(
        F.count(F.lit(1)).alias("n"), total(1).alias("d0"), total(2).alias("d1"))


class TableStore:
    """Tables under ``base``, in databases named ``prefix`` + schema."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = 16, prefix: str = ""):
        self.spark, self.base, self.buckets, self.prefix = spark, base.rstrip("/"), buckets, prefix

    # -- names --------------------------------------------------------------------------------------------------------

    def _view(self, schema: str, name: str) -> str:
        return f"`{self.prefix}{schema}`.`{name}`"

    def _written(self, schema: str, name: str) -> str | None:
        """The table that holds the rows, or None if there is none yet."""
        if not self.spark.catalog.tableExists(f"{self.prefix}{schema}.{name}"):
            return None
        facts = self.spark.sql(f"SHOW TBLPROPERTIES {self._view(schema, name)}").collect()
        return next(r["value"] for r in facts if r["key"] == "written")

    def _bucket_number(self, written: str) -> int:
        facts = self.spark.sql(f"DESCRIBE TABLE EXTENDED {written}").collect()
        return next(int(r["data_type"]) for r in facts if r["col_name"] == "Num Buckets")

    # -- reading ------------------------------------------------------------------------------------------------------

    def current(self, schema: str, name: str) -> DataFrame | None:
        """The table's rows, or None if it was never written."""
        written = self._written(schema, name)
        return None if written is None else self.spark.table(written).drop(PART)

    def part(self, schema: str, name: str, parts: Sequence[int]) -> DataFrame:
        """The rows of some of a table's buckets; no others are read."""
        return self.spark.table(self._written(schema, name)).where(F.col(PART).isin(list(parts))).drop(PART)

    def buckets_of(self, schema: str, name: str) -> int:
        """The number of a table's buckets."""
        return self._bucket_number(self._written(schema, name))

    def digests(self, schema: str, name: str) -> Digests:
        """What was last applied to each bucket; empty if that is not known."""
        table = f"{self._written(schema, name)}".replace("`", "") + "_digests"
        if not self.spark.catalog.tableExists(table):
            return {}
        return self._fetched(self.spark.table(table))

    def _fetched(self, digests: DataFrame) -> Digests:
        """A row for each bucket comes to the driver."""
        with settings(self.spark, {SHUFFLE_CLEANUP: "true"}):
            return {r[PART]: (r["n"], int(r["d0"]), int(r["d1"])) for r in digests.collect()}

    # -- writing ------------------------------------------------------------------------------------------------------

    def replace(
        self, schema: str, name: str, rows: DataFrame, keys: Sequence[str] = (), buckets: int | None = None,
        validate_keys: bool = True, hash_col: str = RAW_HASH, finish: Finish = _as_is, laid: bool = False,
    ) -> int:
        """Write the whole table anew, with ``keys`` in buckets and with digests; returns the number of rows.

        ``finish`` adds columns after the rows are dealt, so they are not
        shuffled.  ``laid`` says that the rows come from a table of as many
        buckets of the same keys, in which case they are not dealt again.

        A repeated or NULL key fails the write: the check works on the shuffle
        and the sort that the buckets need anyway, so ``rows`` is evaluated once.
        The rows are counted while they are written.
        """
        spark, database = self.spark, f"`{self.prefix}{schema}`"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.base}/{schema}'")
        old = self._written(schema, name)
        fresh = f"{database}.`{name}_{uuid4().hex[:12]}`"
        keys, n, seen = list(keys), buckets or self.buckets, Observation()
        counted = lambda df: df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if keys:
            dealt = rows if laid else rows.repartition(n, *keys)
            # rows that lie in buckets are read by bucket for the guard's sake
            checked = validate_keys or laid
            dealt = guard_unique(dealt, keys, f"{schema}.{name}") if checked else dealt.sortWithinPartitions(*keys)
            dealt = rows = finish(dealt)
            parted = counted(dealt.withColumn(PART, part_of(keys, n)))
            writer = parted.write.partitionBy(PART).bucketBy(n, *keys)
        else:
            rows = finish(rows)
            writer = counted(rows).write
        with settings(spark, WRITING):
            writer.format("parquet").option("compression", COMPRESSION).saveAsTable(fresh)
        if keys and hash_col in rows.columns:
            self._save_digests(fresh, self._fetched(bucket_digests(spark.table(fresh), keys, n, hash_col)))
        columns = ", ".join(f"`{c}`" for c in spark.table(fresh).columns if c != PART)
        spark.sql(f"CREATE OR REPLACE VIEW {self._view(schema, name)} TBLPROPERTIES ('written' = '{fresh}') "
                  f"AS SELECT {columns} FROM {fresh}")
        if old:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
            spark.sql(f"DROP TABLE IF EXISTS {self._digest_table(old)}")
        return seen.get.get("rows", 0)

    @staticmethod
    def _digest_table(written: str) -> str:
        return written[:-1] + "_digests`"

    def _save_digests(self, written: str, digests: Digests) -> None:
        rows = [(p, n, str(a), str(b)) for p, (n, a, b) in sorted(digests.items())]
        frame = self.spark.createDataFrame(rows, f"{PART} int, n long, d0 string, d1 string").coalesce(1)
        frame.write.mode("overwrite").format("parquet").saveAsTable(self._digest_table(written))

    def touched(self, schema: str, name: str, source: DataFrame, keys: Sequence[str], hash_col: str = RAW_HASH) -> tuple[list[int], Digests]:
        """The buckets whose source rows are not those last applied, and the digests of all buckets of the source."""
        n = self._bucket_number(self._written(schema, name))
        new, old = self._fetched(bucket_digests(source, keys, n, hash_col)), self.digests(schema, name)
        return sorted(p for p in {*new, *old} if new.get(p) != old.get(p)), new

    def upsert(
        self, schema: str, name: str, source: DataFrame, keys: Sequence[str], change: Change, mirror: bool = False,
        hash_col: str = RAW_HASH, gone: DataFrame | None = None, flag: str = IS_DELETED, finish: Finish = _as_is,
        laid: bool = False, touching: DataFrame | None = None, of_parts: Callable[[list[int]], DataFrame] | None = None,
        validate_keys: bool = True,
    ) -> dict[str, int]:
        """Apply ``source`` to the table's touched buckets; returns the number of their rows by change type.

        ``change`` gives the new state of source and current rows of some
        buckets.  With ``mirror`` the table holds the source's keys only, so a
        bucket that the source left is emptied.  ``gone`` holds keys whose rows
        get ``flag`` set after that (the source's soft deletes); their buckets
        are touched too.  If ``change`` returns other columns than the table
        has, the whole table is written anew.  The counts are observed while
        the rows are written; ``delete`` counts what the touched buckets lost.
        ``finish`` and ``laid`` are those of :meth:`replace`, for ``source``.
        ``touching`` holds keys whose buckets are touched too, whatever
        ``change`` does with them.

        Many buckets are put in place by several jobs.  A repeated or NULL key
        of ``source`` is then looked for before the first of them, so that it
        refuses them all (unless ``change`` checks none: ``validate_keys``).
        ``of_parts`` gives the rows of some buckets of a ``laid`` source,
        which reads all of it for each job otherwise.
        """
        keys, written = list(keys), self._written(schema, name)
        table, n = self.spark.table(written), self._bucket_number(written)
        types = dict(table.dtypes)
        typed = lambda df: df.withColumns({k: F.col(k).cast(types[k]) for k in keys})
        source, before = typed(source), table.drop(PART)
        whole = finish(source)
        state = change(whole, before)
        if {*state.columns} - {CHANGE_TYPE} != {*before.columns}:
            self.replace(schema, name, state.drop(CHANGE_TYPE), keys, n, validate_keys=False)
            self._save_digests(self._written(schema, name), self._fetched(bucket_digests(whole, keys, n, hash_col)))
            return {"rewritten": 1}
        new, old = self._fetched(bucket_digests(whole, keys, n, hash_col)), self.digests(schema, name)
        touched = {p for p in {*new, *old} if new.get(p) != old.get(p)}
        if gone is not None:
            gone = typed(gone.select(*keys))
        for df in (gone, touching):
            if df is not None:
                touched |= {r[PART] for r in typed(df.select(*keys)).select(part_of(keys, n).alias(PART)).distinct().collect()}
        if not touched:
            return {}
        counts = dict.fromkeys(CHANGES, 0)
        jobs = self._jobs(sorted(touched), n)
        if len(jobs) > 1:
            if validate_keys:
                self._refuse_repeated(source, keys, n, f"{schema}.{name}", laid)
            # should a later job die, no source is taken for the one that these buckets hold
            self._save_digests(written, {**old, **{p: (old.get(p, (0,))[0], -1, -1) for p in touched}})
        for parts in jobs:
            # dealt as the table lies, so neither the key check nor the joins shuffle again
            chosen = lambda df: df.withColumn(PART, part_of(keys, n)).where(F.col(PART).isin(parts)).drop(PART)  # noqa: B023, E731
            dealt = lambda df: chosen(df).repartition(n, *keys)  # noqa: B023, E731
            seen = Observation()
            rows = (typed(of_parts(parts)) if of_parts else chosen(source)) if laid else dealt(source)
            state = change(finish(rows), self.part(schema, name, parts))
            state = state.observe(seen, *[F.count_if(F.col(CHANGE_TYPE) == c).alias(c) for c in CHANGES])
            if gone is not None:
                state = state.join(dealt(gone).distinct().withColumn("__gone", F.lit(True)), keys, "left")
                state = state.withColumn(flag, F.col(flag) | F.coalesce("__gone", F.lit(False)))
            with settings(self.spark, {OVERWRITE_MODE: "dynamic", **WRITING}):
                state.select(*before.columns, part_of(keys, n).alias(PART)).write.insertInto(written, overwrite=True)
            counts = {c: k + seen.get.get(c, 0) for c, k in counts.items()}
        if mirror:
            self._drop_parts(written, [p for p in touched if p not in new])
        self._save_digests(written, new)
        lost = sum(old.get(p, (0,))[0] for p in touched) - counts["update"] - counts["unchanged"]
        return {**counts, "delete": lost if mirror else 0}

    @staticmethod
    def _jobs(parts: list[int], buckets: int) -> list[list[int]]:
        """The buckets of each job."""
        step = max(JOB_BUCKETS, -(-buckets // JOBS))
        return [parts[i:i + step] for i in range(0, len(parts), step)]

    def _refuse_repeated(self, source: DataFrame, keys: list[str], buckets: int, what: str, laid: bool) -> None:
        """Fail if a key of ``source`` repeats or is NULL: a job of its own over the keys alone."""
        only = source.select(*keys)
        with settings(self.spark, {SHUFFLE_CLEANUP: "true"}):
            guard_unique(only if laid else only.repartition(buckets, *keys), keys, what).agg(F.count(F.lit(1))).collect()

    def drop(self, schema: str, name: str) -> None:
        """Remove a table and its digests."""
        written = self._written(schema, name)
        self.spark.sql(f"DROP VIEW IF EXISTS {self._view(schema, name)}")
        for table in (written, self._digest_table(written)):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def _drop_parts(self, written: str, parts: Iterable[int]) -> None:
        for p in parts:  # buckets that are empty now, which an overwrite leaves as they were
            self.spark.sql(f"ALTER TABLE {written} DROP IF EXISTS PARTITION ({PART} = {p})")
