"""Positions of all matches of a regular expression, by DataFrame functions.

Spark's functions return matched strings, not positions.  The pieces between
the matches (``split``) and the matches (``regexp_extract_all``) together make
up the text, so running sums of their lengths are the positions.  Lengths and
positions count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Running sums are made within blocks of so many matches, so that their cost
#: stays far from the square of the number of matches in one text.
BLOCK = 512

SPAN_TYPE = "array<struct<s:int,e:int,m:string,c:string,r:string>>"


def with_spans(df: DataFrame, name: str, text: Column, pattern: str, context: int = 0) -> DataFrame:
    """``df`` with an array column ``name`` of (s, e, m, c, r) for each match.

    Start, exclusive end, the matched text, and up to ``context`` characters
    before and after it, as far as the next match on that side at most.

    ``pattern`` must not match the empty string and must have no effect
    beyond its match (``split`` and ``regexp_extract_all`` then agree).
    """
    t, g, b, o = (f"__{name}_{x}" for x in ("t", "g", "b", "o"))
    df = df.withColumn(t, text)
    matches = F.regexp_extract_all(F.col(t), F.lit(pattern), F.lit(0))
    gaps = F.split(F.col(t), pattern, -1)
    found = F.zip_with(gaps, matches, lambda p, m: F.struct(
        F.length(p).alias("gap"), m.alias("m"), (F.right(p, F.lit(context)) if context else F.lit("")).alias("c")))
    if context:  # what follows a match is the next gap
        found = F.zip_with(found, F.slice(gaps, F.lit(2), F.size(matches)), lambda x, after: F.struct(
            x["gap"].alias("gap"), x["m"].alias("m"), x["c"].alias("c"), F.left(after, F.lit(context)).alias("r")))
    df = df.withColumn(g, F.filter(found, lambda x: x["m"].isNotNull())).drop(t)
    blocks = F.when(F.size(g) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(g) - 1) / BLOCK).cast("int")),
        lambda i: F.slice(F.col(g), i * BLOCK + 1, BLOCK),
    ))
    df = df.withColumn(b, blocks).drop(g)
    length = F.transform(b, lambda blk: F.aggregate(
        blk, F.lit(0), lambda acc, x: acc + x["gap"] + F.length(x["m"])))
    offsets = F.aggregate(length, F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
    df = df.withColumn(o, offsets)

    def placed(blk: Column, off: Column) -> Column:
        zero = F.struct(off.alias("at"), F.array().cast(SPAN_TYPE).alias("out"))
        return F.aggregate(blk, zero, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
            F.array_append(acc["out"], F.struct(
                (acc["at"] + x["gap"]).alias("s"),
                (acc["at"] + x["gap"] + F.length(x["m"])).alias("e"),
                x["m"].alias("m"),
                x["c"].alias("c"),
                (x["r"] if context else F.lit("")).alias("r"),
            )).alias("out"),
        ))["out"]

    spans = F.flatten(F.zip_with(b, F.slice(o, F.lit(1), F.size(b)), placed))
    return df.withColumn(name, F.coalesce(spans, F.array().cast(SPAN_TYPE))).drop(b, o)


def joined(spans: Column) -> Column:
    """kind:start:end of spans (kind, s, e), comma-joined in the given order."""
    return F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
