"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

Leaves are paths through a tree of columns (domain, language, source).  A
budget of tokens goes down the tree: each node's budget is shared among its
children by their target weights, but no child gets more than its subtree can
supply (its tokens times the largest number of epochs).  What a child cannot
use goes to its siblings, by weight (water filling); only what a whole group
of siblings cannot use stays with their parent, whose own siblings had been
offered it already, because a parent's supply is the sum of its children's.

A leaf whose budget holds more than all its tokens repeats them for whole
epochs; the rest is a prefix, by tokens, of the next epoch's seeded order.
A document belongs to the prefix if it ends within the rest.

Prefix sums are made by levels of the order key's leading hex digits: over 256
bins of a leaf, over the 256 bins of each of these, and then over rows, so a
leaf with a third of all rows is spread over all tasks.  All budgets are integers; shares round down.

Defined results: NULL levels are a value of their own; NULL text counts as
empty and has no tokens (such documents belong to every prefix that reaches
their place); NULL ids are ordered as the id 0; rows that repeat an id are separate
documents with the same place; weights missing for a value count as the
default weight, and a weight of zero gives nothing; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import stage, text_or_empty

MAX_EPOCHS = 4
SEED = 7
#: Leading hex digits of the order key at which prefix sums are made, coarse to fine.
PREFIX_DIGITS = (2, 4)


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def _wide(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(38,0)")


def _weight(level: str, weights: Mapping[str, int], default: int) -> Column:
    out = F.lit(default)
    for value, w in weights.items():
        out = F.when(F.col(level) == value, F.lit(w)).otherwise(out)
    return out.cast("long")


def share(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """``budget`` of each child from its parent's ``given``, its ``weight`` and its ``supply``.

    Children are taken by supply / weight.  As long as a child's supply is at
    most its share of what the children before it have left, it gets its whole
    supply; the others share the rest by weight.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("supply") / F.col("weight")), "supply", "node")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    df = children.withColumn("used", F.coalesce(F.sum("supply").over(before), F.lit(0))).withColumn(
        "open", F.sum("weight").over(onward)
    )
    left = F.greatest(F.lit(0), F.col("given") - F.col("used"))
    df = df.withColumn("fills", _wide("supply") * _wide("open") <= _wide(left) * _wide("weight"))
    # the first child that does not fill sets the level; all from it on share by weight
    first = F.min(F.when(~F.col("fills"), F.struct("at", "used", "open"))).over(Window.partitionBy(*parent))
    df = df.withColumn("at", F.row_number().over(order)).withColumn("level", first)
    rest = F.greatest(F.lit(0), F.col("given") - F.col("level.used"))
    part = F.call_function("div", _wide(rest) * _wide("weight"), _wide("level.open")).cast("long")
    budget = F.when(F.col("level").isNull() | (F.col("at") < F.col("level.at")), F.col("supply")).otherwise(
        F.least(F.col("supply"), part))
    return df.withColumn("budget", budget).drop("used", "open", "fills", "at", "level")


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], budget: Column, weights: Mapping[str, Mapping[str, int]], default_weight: int = 1,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``levels``, tokens, budget of leaves (``levels``, tokens); ``budget`` is an aggregate over them.

    The tree has a row for each leaf: statistics, not documents.
    """
    weight = lambda name: _weight(name, weights.get(name, {}), default_weight)
    given = leaves.agg(budget.cast("long").alias("given")).withColumn("node", F.lit(""))
    # a leaf below a node of weight zero supplies nothing, so that nothing is offered to it
    usable = leaves
    for name in levels:
        usable = usable.where(weight(name) > 0)
    parents: list[str] = []
    node = lambda cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}) if cols else F.lit("")
    for name in levels:
        below = [*parents, name]
        kids = usable.groupBy(*below).agg((F.sum("tokens") * max_epochs).alias("supply"), F.sum("tokens").alias("tokens"))
        kids = kids.withColumn("up", node(parents)).withColumn("node", node(below)).withColumn("weight", weight(name))
        up = given.select(F.col("node").alias("up"), "given")
        given = share(kids.join(up, "up"), ["up"]).withColumn("given", F.col("budget"))
        parents = below
    return given.select(*levels, "node", "tokens", "budget")


def _tokens_before(rows: DataFrame, bins: Sequence[str]) -> DataFrame:
    """node, ``bins``, before: a leaf's tokens in all bins before each of its finest bins."""
    out, above = None, ["node"]
    for name in bins:
        keys = [*above, name]
        sums = rows.groupBy(*keys).agg(F.sum("tokens").alias("in_bin"))
        earlier = Window.partitionBy(*above).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        here = sums.select(*keys, F.coalesce(F.sum("in_bin").over(earlier), F.lit(0)).alias("here"))
        if out is None:
            out = here.withColumnRenamed("here", "before")
        else:
            out = here.join(out, above).select(*keys, (F.col("before") + F.col("here")).alias("before"))
        above = keys
    return out


def mix(
    docs: DataFrame, levels: Sequence[str], fraction: float, weights: Mapping[str, Mapping[str, int]] | None = None,
    default_weight: int = 1, max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``levels``, tokens, budget (the leaf's), epochs (0 if not selected).

    The whole budget is ``fraction`` of the tokens of all documents.
    """
    node = F.to_json(F.struct(*levels), {"ignoreNullFields": "false"})
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), *levels, n_tokens(text_or_empty(text_col)).alias("tokens"),
    ).withColumn("node", node)
    rows = stage(rows, "tokens")
    leaves = stage(rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens")), "leaves")
    whole = F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(str(fraction)).cast("decimal(9,6)"))
    # written first, so that the join with the rows of a hot leaf is one that AQE can split
    plan = stage(
        leaf_budgets(leaves, levels, whole, weights or {}, default_weight, max_epochs).select(
            "node", "budget",
            F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).alias("full"),
            F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(F.lit(0)).alias("rest"),
        ),
        "plan",
    )
    rows = rows.join(plan, "node", "left").withColumn("full", F.coalesce("full", F.lit(0))).withColumn(
        "rest", F.coalesce("rest", F.lit(0))
    )
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.coalesce("doc_id", F.lit(0)).cast("string")))
    rows = rows.withColumn("place", key)
    bins = [f"bin{d}" for d in PREFIX_DIGITS]
    for d in PREFIX_DIGITS:
        rows = rows.withColumn(f"bin{d}", F.substring("place", 1, d))
    rows = stage(rows, "places")
    before = _tokens_before(rows, bins)
    within = Window.partitionBy("node", *bins).orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.withColumn("within", F.sum("tokens").over(within)).join(before, ["node", *bins])
    chosen = (F.col("before") + F.col("within") <= F.col("rest")) & (F.col("rest") > 0)
    return ends.select(
        "doc_id", *levels, "tokens", F.coalesce("budget", F.lit(0)).alias("budget"),
        (F.col("full") + chosen.cast("long")).cast("long").alias("epochs"),
    )


def select_mixture(
    docs: DataFrame, levels: Sequence[str], fraction: float, weights: Mapping[str, Mapping[str, int]] | None = None,
    id_col: str = "doc_id", text_col: str = "text", **options,
) -> DataFrame:
    """The rows of ``docs`` that enter the mixture, each once, with all their columns."""
    chosen = mix(docs, levels, fraction, weights, id_col=id_col, text_col=text_col, **options).where("epochs > 0")
    node = F.to_json(F.struct(*levels), {"ignoreNullFields": "false"})
    key = lambda c: F.coalesce(F.col(c).cast("long").cast("string"), F.lit("-"))
    # rows with the same id and leaf have the same place in its order, so they share the decision
    theirs = chosen.select(key("doc_id").alias("__key"), node.alias("__node"))
    mine = docs.withColumns({"__key": key(id_col), "__node": node})
    return mine.join(theirs, ["__key", "__node"], "left_semi").drop("__key", "__node")
