"""Restricted PII vault access: point lookups and hash cross-verification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.hashing import pii_hash


def lookup(vault: DataFrame, column: str, value, returning: Sequence[str]) -> DataFrame:
    """Rows of ``vault`` where ``column = value`` (a pushed-down filter)."""
    return vault.where(F.col(column) == F.lit(value)).select(*returning)


def lookup_by_clear_value(vault: DataFrame, hash_column: str, clear_value: str,
                          returning: Sequence[str]) -> DataFrame:
    """Find keys by a clear-text value without exposing it: hash, then match.

    Every absent value hashes like '', so an empty probe is refused rather
    than matching every row whose value is missing.
    """
    if clear_value is None or clear_value == "":
        raise ValueError("an empty value matches every missing value; refusing")
    probe = pii_hash(F.lit(clear_value).cast(T.StringType()))
    return vault.where(F.col(hash_column) == probe).select(*returning)


def cross_verify(vault: DataFrame, published: DataFrame, key: str,
                 hash_columns: Sequence[str]) -> DataFrame:
    """Per hash column: rows compared and rows whose hashes disagree.

    Joins the restricted vault with the published table on the surrogate key
    and compares each hash NULL-safely; a single aggregate pass.
    """
    v = vault.select(key, *[F.col(c).alias("v_" + c) for c in hash_columns])
    p = published.select(key, *[F.col(c).alias("p_" + c) for c in hash_columns])
    joined = v.join(p, key, "inner")
    aggs = [F.count(F.lit(1)).alias("compared")]
    aggs += [F.count(F.when(~F.col("v_" + c).eqNullSafe(F.col("p_" + c)), 1)).alias(c) for c in hash_columns]
    row = joined.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("hash_column"), F.col("compared"), F.col(c).alias("mismatches"))
        for c in hash_columns
    ]))
    return row.select(stacked.alias("r")).select("r.*")
