"""Data contracts evaluated as Spark jobs.

Five test kinds, with the failure counts of the generic tests they mirror:

* ``not_null``        – rows where the column is NULL;
* ``accepted_values`` – distinct non-NULL values outside the accepted set;
* ``unique``          – distinct non-NULL values that occur more than once;
* ``unique_combination_of_columns`` – column combinations occurring more
  than once;
* ``relationships``   – non-NULL child rows whose value has no parent row;
* ``expression_is_true`` – rows where a SQL expression is false (NULL
  results do not fail), for documented identities such as totals.

Each test has a severity (``error`` by default, or ``warn``); the status
is ``pass`` without failures, else ``warn`` or ``fail`` by severity.

Cost per table: **one** aggregate pass for all of its not-null and expression
tests, one for its accepted-value tests (only values outside the accepted sets
leave the scan, so nothing is expanded per test), **one** grouping-sets aggregation for
all of its unique/combination tests (map-side partial counts collapse a hot
key before the shuffle) and, per relationship, a pre-aggregated child side
(one row per distinct value, so a hot foreign key is collapsed map-side)
anti-joined to the distinct parent keys.  Nothing is collected to the
driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.operators.frames import union_all
from pyspark.sql import types as T

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED = "accepted_values"
RELATIONSHIPS = "relationships"
UNIQUE_COMBO = "unique_combination_of_columns"
EXPRESSION = "expression_is_true"

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("column_name", T.StringType(), True),
    T.StructField("test", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("failures", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
])


@dataclass(frozen=True)
class ContractTest:
    model: str
    test: str
    columns: tuple[str, ...]
    severity: str = "error"
    values: tuple = ()                 # accepted_values
    to: str | None = None              # relationships: parent model
    field: str | None = None           # relationships: parent column
    expression: str | None = None      # expression_is_true
    case_insensitive: bool = False     # accepted_values: ignore case and trailing spaces

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


def not_null(model: str, column: str, severity: str = "error") -> ContractTest:
    return ContractTest(model, NOT_NULL, (column,), severity)


def unique(model: str, column: str, severity: str = "error") -> ContractTest:
    return ContractTest(model, UNIQUE, (column,), severity)


def accepted_values(model: str, column: str, values: Sequence, severity: str = "error",
                    case_insensitive: bool = False) -> ContractTest:
    """``case_insensitive`` compares like a case-insensitive, trailing-space
    insensitive collation ('m ' is accepted for 'M')."""
    return ContractTest(model, ACCEPTED, (column,), severity, values=tuple(values),
                        case_insensitive=case_insensitive)


def expression_is_true(model: str, name: str, expression: str, severity: str = "error") -> ContractTest:
    return ContractTest(model, EXPRESSION, (name,), severity, expression=expression)


def relationships(model: str, column: str, to: str, field: str, severity: str = "error") -> ContractTest:
    return ContractTest(model, RELATIONSHIPS, (column,), severity, to=to, field=field)


def unique_combination(model: str, columns: Sequence[str], severity: str = "error") -> ContractTest:
    return ContractTest(model, UNIQUE_COMBO, tuple(columns), severity)


# ---------------------------------------------------------------------------
# failure counts
# ---------------------------------------------------------------------------

def _bad_value(t: ContractTest) -> Column:
    c = F.col(t.columns[0])
    if t.case_insensitive:
        folded = F.lower(F.rtrim(c.cast(T.StringType())))
        allowed = [str(v).lower().rstrip() for v in t.values]
        return F.when(c.isNotNull() & ~folded.isin(allowed), folded)
    return F.when(c.isNotNull() & ~c.isin(list(t.values)), c)


def _scan_metric(t: ContractTest) -> Column:
    if t.test == NOT_NULL:
        return F.count(F.when(F.col(t.columns[0]).isNull(), F.lit(1)))
    if t.test == EXPRESSION:
        return F.count(F.when(~F.expr(t.expression), F.lit(1)))
    raise ValueError(f"{t.test} is not counted in a scan")


def bad_value_counts(df: DataFrame, tests: Sequence[ContractTest]) -> DataFrame:
    """Distinct values outside each accepted-values test's set, as one row ``m0, m1, ...``.

    Good values are dropped before anything is grouped.
    """
    bad = F.array(*[
        F.struct(F.lit(i).alias("i"), _bad_value(t).cast(T.StringType()).alias("v")) for i, t in enumerate(tests)])
    values = df.select(F.explode(F.filter(bad, lambda b: b["v"].isNotNull())).alias("b")).select("b.i", "b.v").distinct()
    return values.agg(*[F.count(F.when(F.col("i") == i, F.lit(1))).alias(f"m{i}") for i in range(len(tests))])


def scan_failures(df: DataFrame, tests: Sequence[ContractTest]) -> list[Column]:
    """Aggregate columns ``m0, m1, ...`` with each test's failure count.

    Meant for a single ``df.agg(...)`` pass over the table (not-null and
    expression tests); the caller turns them into rows.
    """
    return [_scan_metric(t).alias(f"m{i}") for i, t in enumerate(tests)]


def duplicate_groups(df: DataFrame, columns: Sequence[str], skip_nulls: bool) -> DataFrame:
    """Number of key values (or combinations) that occur more than once."""
    src = df.select(*columns)
    if skip_nulls:
        src = src.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    groups = src.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return groups.agg(F.count(F.lit(1)).alias("failures"))


def duplicate_group_counts(df: DataFrame, sets: Sequence[tuple[tuple[str, ...], bool]]) -> DataFrame:
    """Duplicated-value counts for several key sets of one table in one pass.

    ``sets`` holds ``(columns, skip_nulls)`` pairs.  One ``groupingSets``
    aggregation counts rows per value of every set (a single scan and a
    single shuffle, with map-side partial counts), then a global aggregate
    counts the values occurring more than once per set.  Returns one row
    with columns ``d0, d1, ...``.
    """
    cols: list[str] = []
    for columns, _ in sets:
        cols += [c for c in columns if c not in cols]
    # tests that share a column set share its grouping set: given twice, its rows would count twice
    distinct = {frozenset(c): list(c) for c, _ in sets}
    grouped = df.groupingSets(list(distinct.values()), *cols).agg(
        F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__gid"))
    metrics = []
    for i, (columns, skip_nulls) in enumerate(sets):
        gid = sum(1 << (len(cols) - 1 - j) for j, c in enumerate(cols) if c not in columns)
        cond = (F.col("__gid") == gid) & (F.col("__n") > 1)
        if skip_nulls:
            cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], cond)
        metrics.append(F.count(F.when(cond, F.lit(1))).alias(f"d{i}"))
    return grouped.agg(*metrics)


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child rows whose value is absent from ``parent.field``."""
    counts = (child.where(F.col(column).isNotNull())
              .groupBy(F.col(column).alias("__v")).agg(F.count(F.lit(1)).alias("n")))
    parents = parent.select(F.col(field).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    missing = counts.join(parents, "__v", "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast(T.LongType()).alias("failures"))


def result_columns(t: ContractTest, failures: Column) -> list[Column]:
    """A result row's columns for a test with ``failures``."""
    status = (F.when(failures == 0, F.lit("pass"))
              .when(F.lit(t.severity) == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return [
        F.lit(t.model).alias("model"),
        F.lit(t.column_name).alias("column_name"),
        F.lit(t.test).alias("test"),
        F.lit(t.severity).alias("severity"),
        failures.cast(T.LongType()).alias("failures"),
        status.alias("status"),
    ]


def run_contracts(
    tables: Mapping[str, DataFrame],
    tests: Sequence[ContractTest],
) -> DataFrame:
    """Evaluate ``tests`` against ``tables`` (model name -> DataFrame).

    Returns ``(model, column_name, test, severity, failures, status)`` with
    one row per test, as one lazy DataFrame.
    """
    parts: list[DataFrame] = []
    by_model: dict[str, list[ContractTest]] = {}
    for t in tests:
        by_model.setdefault(t.model, []).append(t)
    for model_name, model_tests in by_model.items():
        df = tables[model_name]
        scanned = [t for t in model_tests if t.test in (NOT_NULL, EXPRESSION)]
        valued = [t for t in model_tests if t.test == ACCEPTED]
        for group, agg in ((scanned, lambda g: df.agg(*scan_failures(df, g))), (valued, lambda g: bad_value_counts(df, g))):
            if group:
                rows = [F.struct(*result_columns(t, F.col(f"m{i}"))) for i, t in enumerate(group)]
                parts.append(agg(group).select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
        keyed = [t for t in model_tests if t.test in (UNIQUE, UNIQUE_COMBO)]
        if keyed:
            sets = [(t.columns, t.test == UNIQUE) for t in keyed]
            counts = duplicate_group_counts(df, sets)
            rows = [F.struct(*result_columns(t, F.col(f"d{i}"))) for i, t in enumerate(keyed)]
            parts.append(counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
        for t in model_tests:
            if t.test == RELATIONSHIPS:
                res = orphan_rows(df, t.columns[0], tables[t.to], t.field)
                parts.append(res.select(*result_columns(t, F.col("failures"))))
    if not parts:
        raise ValueError("no tests to run")
    out = union_all(parts)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in RESULT_SCHEMA.fields])


def gate(results: DataFrame) -> None:
    """Raise if any ``error``-severity test failed, naming all of them (one row per declared test comes back at most)."""
    failed = results.where(F.col("status") == "fail").collect()
    if failed:
        names = ", ".join(f"{r.model}.{r.column_name}:{r.test}={r.failures}" for r in failed)
        raise AssertionError(f"contract errors: {names}")
