"""Personal data followed through a plan: which columns still carry clear values.

A column is marked personal by its metadata (``pii``) where it is staged.  The
mark follows the values through any expression, rename, join, window, union or
aggregate of the analysed plan, and only the one-way hash functions clear it.  So
a clear value is found under any name and in any expression, and tables that
are written keep the mark, for Spark stores column metadata with their schema.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PII, ORIGINAL, ALGORITHM = "pii", "original_field", "hash_algorithm"
#: What turns a value into one that says nothing about it.
ONE_WAY = ("Sha2", "Md5")


def personal(col: Column, name: str) -> Column:
    """``col`` as a column ``name`` that is marked as personal data."""
    return col.alias(name, metadata={PII: True})


def hashed(col: Column, name: str, original: str, algorithm: str = "SHA2_256") -> Column:
    """A hash as a column ``name`` that says which field it stands for."""
    return col.alias(name, metadata={ORIGINAL: original, ALGORITHM: algorithm})


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


class _Plan:
    """What defines each attribute of an analysed plan."""

    def __init__(self, plan):
        self.defined: dict[int, list] = {}
        self.known: dict[int, bool] = {}
        self._collect(plan)

    def _collect(self, node) -> None:
        kind, children = node.nodeName(), _items(node.children())
        for e in _items(node.expressions()):
            if e.nodeName() == "Alias":
                self.defined.setdefault(e.exprId().id(), []).append(e)
        if kind == "Union":
            for column in zip(_items(node.output()), *[_items(c.output()) for c in children]):
                self._from(column[0], [a for a in column[1:] if a.exprId().id() != column[0].exprId().id()])
        elif kind == "Generate":
            for a in _items(node.generatorOutput()):
                self._from(a, [node.generator()])
        for c in children:
            self._collect(c)

    def _from(self, attribute, expressions: list) -> None:
        self.defined.setdefault(attribute.exprId().id(), []).extend(expressions)

    def clear(self, e) -> bool:
        """Does the expression carry clear personal values?"""
        kind = e.nodeName()
        if kind in ONE_WAY:
            return False
        if kind == "WindowExpression":  # what rows are parted and ordered by is no value of theirs
            return self.clear(e.windowFunction())
        if kind in ("AttributeReference", "Alias"):
            if f'"{PII}":true' in e.metadata().json():
                return True
            if kind == "AttributeReference":
                key = e.exprId().id()
                if key not in self.known:
                    self.known[key] = False  # an attribute that defines itself adds nothing
                    self.known[key] = any([self.clear(x) for x in self.defined.get(key, [])])
                return self.known[key]
        return any([self.clear(c) for c in _items(e.children())])


def clear_columns(df: DataFrame) -> list[str]:
    """The columns of ``df`` that carry clear personal values, under whatever name."""
    plan = df._jdf.queryExecution().analyzed()
    found = _Plan(plan)
    return [a.name() for a in _items(plan.output()) if found.clear(a)]


def column_metadata(df: DataFrame) -> list[tuple[str, str | None, str | None]]:
    """(column, original field, hash algorithm) of each column."""
    return [(f.name, f.metadata.get(ORIGINAL), f.metadata.get(ALGORITHM)) for f in df.schema.fields]


def value_leaks(published: Mapping[str, DataFrame], clear: Iterable[Column], vault: DataFrame) -> DataFrame:
    """model, column_name, leaked_values: how many different values of published text columns are clear values of a vault.

    The data's own check beside that of the plans.  Values are made distinct
    map-side before they are joined, so common ones are few rows.
    """
    secrets = vault.select(F.explode(F.array(*clear)).alias("value")).where("value != ''").distinct()
    parts = []
    for model, df in published.items():
        texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and not f.name.startswith("_")]
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in texts])
        values = df.select(F.inline(pairs)).distinct()
        hits = values.join(secrets, "value", "left_semi").groupBy("column_name").agg(F.count(F.lit(1)).alias("leaked_values"))
        names = df.sparkSession.createDataFrame([(model, c) for c in texts], "model string, column_name string")
        parts.append(names.join(hits, "column_name", "left").select(
            "model", "column_name", F.coalesce("leaked_values", F.lit(0).cast("long")).alias("leaked_values")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
