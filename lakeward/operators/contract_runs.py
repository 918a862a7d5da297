"""Contracts on written tables: every tested view is evaluated once.

:func:`run_contracts_once` writes the tested columns of each table to a shared
folder, and everything else reads what was written:

* NULLs and broken expressions are counted by the writing job itself, which
  observes the rows just below the write, so a repeated task counts once;
* a key of more than one column, or of text, is looked at by its 64-bit hash
  first: one long per row is shuffled, with partial counts before.  Equal keys
  have equal hashes, so a set of keys without a repeated hash has no repeated
  key.  Only the rows of repeated hashes are grouped by the keys themselves,
  which tells true repeats from hashes that met by chance;
* accepted values and relationships read only their columns of the files.

Tables of large files are written one at a time, and a job's shuffle files go
when it ends.

The results are those of :func:`lakeward.operators.contracts.run_contracts`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.operators.contracts import (
    ACCEPTED,
    EXPRESSION,
    NOT_NULL,
    RELATIONSHIPS,
    RESULT_SCHEMA,
    UNIQUE,
    UNIQUE_COMBO,
    ContractTest,
    bad_value_counts,
    orphan_rows,
    result_columns,
    scan_failures,
)
from lakeward.operators.frames import input_bytes, union_all
from lakeward.session import SHUFFLE_CLEANUP, settings

#: Writing jobs that the driver has under way at a time, and the bytes of files from which a table's job runs alone: it
#: keeps all cores busy by itself, and the shuffle files and spilled rows of one such job lie on disk at a time.
AT_ONCE, LARGE_BYTES = 4, 256 << 20

HashOf = Callable[..., Column]


def tested_columns(df: DataFrame, name: str, tests: Sequence[ContractTest]) -> list[str]:
    """The columns of table ``name`` that tests read after it is written, in the table's order."""
    read = {c for t in tests if t.model == name and t.test not in (NOT_NULL, EXPRESSION) for c in t.columns}
    read |= {t.field for t in tests if t.to == name}
    return [c for c in df.columns if c in read]


def write_tested(
    df: DataFrame, path: str, scanned: Sequence[ContractTest], columns: Sequence[str] | None = None
) -> tuple[DataFrame, list[int]]:
    """Write ``columns`` of ``df`` (all by default); returns the written rows and the failures of ``scanned``, counted while writing.

    Without columns nothing is written: the rows are counted alone.
    """
    seen, rows = Observation(), df
    columns = df.columns if columns is None else list(columns)
    if not columns:
        counts = df.agg(*scan_failures(df, scanned)).first().asDict()
        return df.select(), [counts[f"m{i}"] or 0 for i in range(len(scanned))]
    if scanned:
        rows = df.observe(seen, *scan_failures(df, scanned))
    rows = rows.select(*columns)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    counts = seen.get if scanned else {}
    return df.sparkSession.read.schema(rows.schema).parquet(path), [counts.get(f"m{i}", 0) for i in range(len(scanned))]


def _key_rows(df: DataFrame, columns: Sequence[str], skip_nulls: bool) -> DataFrame:
    keys = df.select(*columns)
    return keys.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])) if skip_nulls else keys


def _is_short(df: DataFrame, columns: Sequence[str]) -> bool:
    """One whole number: its hash would be no shorter than itself."""
    return len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, (T.IntegralType, T.DateType))


def repeated_hashes(df: DataFrame, columns: Sequence[str], skip_nulls: bool, hash_of: HashOf = F.xxhash64) -> DataFrame:
    """``__h``: what more than one row's key hashes to; short keys stand for themselves."""
    keys = _key_rows(df, columns, skip_nulls)
    hashed = F.col(columns[0]) if _is_short(df, columns) else hash_of(*[F.col(c) for c in columns])
    return keys.groupBy(hashed.alias("__h")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__h")


def repeated_keys(df: DataFrame, columns: Sequence[str], skip_nulls: bool, hash_of: HashOf = F.xxhash64) -> DataFrame:
    """``failures``: different keys of more than one row, found among the rows of repeated hashes."""
    keys = _key_rows(df, columns, skip_nulls).withColumn("__h", hash_of(*[F.col(c) for c in columns]))
    met = keys.join(repeated_hashes(df, columns, skip_nulls, hash_of), "__h", "left_semi")
    groups = met.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return groups.agg(F.count(F.lit(1)).alias("failures"))


def duplicate_counts(
    tables: Mapping[str, DataFrame], tests: Sequence[ContractTest], hash_of: HashOf = F.xxhash64
) -> list[int]:
    """Repeated keys of each uniqueness test: hashes first, exact keys where hashes repeat.

    Two jobs at most; each brings one number for each test to the driver.
    """
    def numbers(parts: Mapping[int, DataFrame]) -> dict[int, int]:
        rows = [df.select(F.lit(i).alias("i"), "failures") for i, df in parts.items()]
        return {r["i"]: r["failures"] for r in union_all(rows).collect()} if rows else {}

    sets = [(tables[t.model], list(t.columns), t.test == UNIQUE) for t in tests]
    count = F.count(F.lit(1)).alias("failures")
    hashes = numbers({i: repeated_hashes(*s, hash_of).agg(count) for i, s in enumerate(sets)})
    met = {i: n for i, n in hashes.items() if n and not _is_short(sets[i][0], sets[i][1])}
    exact = numbers({i: repeated_keys(*sets[i], hash_of) for i in met})
    return [exact.get(i, hashes[i]) for i in range(len(sets))]


def _status(severity: str) -> str:
    return "warn" if severity == "warn" else "fail"


def _counted(spark: SparkSession, counts: Sequence[tuple[ContractTest, int]]) -> DataFrame:
    """Result rows of tests whose failures are known: one for each declared test."""
    rows = [(t.model, t.column_name, t.test, t.severity, n, _status(t.severity) if n else "pass") for t, n in counts]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def run_contracts_once(
    tables: Mapping[str, DataFrame], tests: Sequence[ContractTest], folder: str, hash_of: HashOf = F.xxhash64
) -> DataFrame:
    """Evaluate ``tests`` on tables that are written to ``folder`` first, each once.

    ``folder`` is one of this run's own, which driver and executors share; the
    result is read from it, so the caller removes it afterwards.  The rows are
    those of ``run_contracts``.
    """
    if not tests:
        raise ValueError("no tests to run")
    names = sorted({t.model for t in tests} | {t.to for t in tests if t.to})

    def write(numbered: tuple[int, str]) -> tuple[str, DataFrame, list[tuple[ContractTest, int]]]:
        i, name = numbered
        scanned = [t for t in tests if t.model == name and t.test in (NOT_NULL, EXPRESSION)]
        columns = tested_columns(tables[name], name, tests)
        rows, failures = write_tested(tables[name], f"{folder.rstrip('/')}/t{i}", scanned, columns)
        return name, rows, list(zip(scanned, failures))

    spark = tables[names[0]].sparkSession
    large = {name for name in names if input_bytes(tables[name]) > LARGE_BYTES}
    keyed = [t for t in tests if t.test in (UNIQUE, UNIQUE_COMBO)]
    with settings(spark, {SHUFFLE_CLEANUP: "true"}):
        with ThreadPool(AT_ONCE) as pool:
            done = pool.map(write, [(i, name) for i, name in enumerate(names) if name not in large], chunksize=1)
        done += [write((i, name)) for i, name in enumerate(names) if name in large]
        written = {name: rows for name, rows, _ in done}
        counts = [c for _, _, known in done for c in known]
        if keyed:
            counts += zip(keyed, duplicate_counts(written, keyed, hash_of))
    parts = [_counted(spark, counts)] if counts else []
    for name in names:
        valued = [t for t in tests if t.model == name and t.test == ACCEPTED]
        if valued:
            rows = [F.struct(*result_columns(t, F.col(f"m{i}"))) for i, t in enumerate(valued)]
            found = bad_value_counts(written[name], valued).select(F.explode(F.array(*rows)).alias("r"))
            parts.append(found.select("r.*"))
    for t in tests:
        if t.test == RELATIONSHIPS:
            found = orphan_rows(written[t.model], t.columns[0], written[t.to], t.field)
            parts.append(found.select(*result_columns(t, F.col("failures"))))
    return union_all(parts).select(*[F.col(f.name).cast(f.dataType) for f in RESULT_SCHEMA.fields])
