"""Shared helpers: staged tables in the cluster's shared folder, table reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only when the session has none (plain local tests) a scratch folder is
    created; a session on a cluster must name a folder all executors see.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="lakeward-shared-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage with a table that survives lost executors, and makes
    later steps read only the columns they need.  The folder is new for each
    call; whoever owns the shared folder clears it after the application.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/lakeward-stages/{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: Column | str) -> Column:
    """Text with NULL as the empty string."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def rows_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, once: bool = False) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id and text's SHA-256 are in ``chosen`` (doc_id, sha).

    NULL ids match NULL ids.  ``once``: of rows that repeat id and text one is left.
    """
    key = lambda c: F.coalesce(F.col(c).cast("long").cast("string"), F.lit("-"))
    mine = docs.withColumns({"__key": key(id_col), "__sha": F.sha2(text_or_empty(text_col), 256)})
    if once:  # collapsed map-side, and on the join's own partitioning
        mine = mine.dropDuplicates(["__key", "__sha"])
    theirs = chosen.select(key("doc_id").alias("__key"), F.col("sha").alias("__sha"))
    return mine.join(theirs, ["__key", "__sha"], "left_semi").drop("__key", "__sha")
