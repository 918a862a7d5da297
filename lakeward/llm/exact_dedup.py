"""Exact dedup by composable polynomial fingerprints.

A text is cut into chunks that are hashed on their own.  With the text's
bytes b_0 .. b_{n-1} as the coefficients of a polynomial in the base 256,

    fingerprint(A + B) = fingerprint(A) * 256^len(B) + fingerprint(B)   (mod p)

so each chunk's hash is shifted by the length of what follows it, and the
shifted hashes of a text simply add up: Spark sums them with map-side
partial sums, whatever task hashed which chunk.  Two 48-bit primes and the
byte length make the fingerprint.

Texts with equal fingerprints are then compared chunk by chunk with the
smallest document of their group.  Texts that differ from it in spite of an
equal fingerprint go into a further round among themselves, until none is
left, so the result is exact for any primes.

Defined results: NULL text counts as empty; empty texts are copies of each
other; NULL ids sort after all others; of rows that repeat id and text one
stays; an empty table gives an empty result; other columns are not read, so
their names may clash with this module's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import rows_of, stage, text_or_empty

#: Two primes below 2^48: sums of up to 2^15 shifted chunk hashes fit a long.
PRIMES = (217747151580923, 272627090574743)
CHUNK_BYTES = 1 << 20
WHITESPACE = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(text, WHITESPACE, " ")


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    raw = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(raw).alias("t"), F.sha2(raw, 256).alias("raw")).select(
        "doc_id", "raw", F.sha2("t", 256).alias("sha"), F.col("t").cast("binary").alias("body")
    )


def _chunk(body: str, no: str, chunk_bytes: int) -> Column:
    return F.substring(F.col(body), (F.col(no) * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes))


def _with_chunks(df: DataFrame, chunk_bytes: int) -> DataFrame:
    """A row for each chunk: ``no``, ``chunk`` instead of ``body``; one (empty) chunk for an empty body."""
    last = F.greatest(F.lit(0), F.floor((F.length("body") - 1) / chunk_bytes)).cast("int")
    return df.withColumn("no", F.explode(F.sequence(F.lit(0), last))).withColumn(
        "chunk", _chunk("body", "no", chunk_bytes)
    ).drop("body")


def chunk_hash(chunk: bytes, bytes_after: int, primes: tuple[int, int] = PRIMES) -> tuple[int, int]:
    """The chunk's polynomial hash, shifted by the length of what follows it."""
    p, q = primes
    shifted = int.from_bytes(chunk, "big") % (p * q) * pow(256, bytes_after, p * q)
    return shifted % p, shifted % q


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    primes: tuple[int, int] = PRIMES, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, raw and sha (of the text as it stands and normalised), n_bytes, f0, f1."""
    bodies = _bodies(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()).withColumn(
        "n_bytes", F.length("body").cast("long")
    )
    after = F.greatest(F.lit(0).cast("long"), F.col("n_bytes") - (F.col("no") + 1) * F.lit(chunk_bytes))
    chunks = _with_chunks(bodies, chunk_bytes).select("row", "doc_id", "raw", "sha", "n_bytes", after.alias("after"), "chunk")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pairs = [chunk_hash(c, a, primes) for c, a in zip(pdf["chunk"], pdf["after"].tolist())]
            out = pdf[["row", "doc_id", "raw", "sha", "n_bytes"]].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["h0"] = [x[0] for x in pairs]
            out["h1"] = [x[1] for x in pairs]
            yield out

    hashes = chunks.mapInPandas(hashed, "row long, doc_id long, raw string, sha string, n_bytes long, h0 long, h1 long")
    return hashes.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("raw").alias("raw"),
        F.first("sha").alias("sha"),
        F.first("n_bytes").alias("n_bytes"),
        (F.sum("h0") % primes[0]).alias("f0"),
        (F.sum("h1") % primes[1]).alias("f1"),
    )


KEY = ["n_bytes", "f0", "f1"]


def _different(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """doc_id, sha of the texts in ``rows`` that differ in a chunk from their group's first text."""
    # copies of a row (same id and text) are one, on both sides and before any chunk is cut
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-")).alias("key")
    pairs = rows.where((F.col("size") > 1) & (F.col("row") != F.col("rep.row")))
    members = pairs.select(key("doc_id"), "doc_id", "sha", F.col("rep.row").alias("rep"))
    firsts = pairs.select(key("rep.doc_id"), F.col("rep.doc_id").alias("doc_id"), F.col("rep.sha").alias("sha"), F.col("rep.row").alias("rep"))
    wanted = members.withColumn("is_rep", F.lit(False)).union(firsts.withColumn("is_rep", F.lit(True))).distinct()
    bodies = _bodies(docs, id_col, text_col).select(key("doc_id"), "sha", "body").dropDuplicates(["key", "sha"])
    texts = bodies.join(wanted, ["key", "sha"])
    chunks = stage(_with_chunks(texts.select("doc_id", "sha", "rep", "is_rep", "body"), chunk_bytes), "chunks")
    of_rep = chunks.where("is_rep").select("rep", "no", F.col("chunk").alias("rep_chunk"))
    both = chunks.where("not is_rep").join(of_rep, ["rep", "no"], "left")
    return both.where(~F.col("chunk").eqNullSafe(F.col("rep_chunk"))).select("doc_id", "sha").distinct()


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    primes: tuple[int, int] = PRIMES, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_bytes, raw_sha256.

    Groups are texts equal after white-space normalisation; the smallest
    doc_id of a group stays.  Group statistics are summed map-side and written
    before they are joined back, so a group with a third of all rows is a
    skewed join that AQE splits, never one task's work.
    """
    todo = stage(fingerprints(docs, id_col, text_col, primes, chunk_bytes), "fingerprints")
    done: list[DataFrame] = []
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "sha"))
    while True:
        groups = stage(
            todo.groupBy(*KEY).agg(first.alias("rep"), F.count(F.lit(1)).alias("size")).where("size > 1"), "groups"
        )
        rows = todo.join(groups, KEY, "left")
        # groups without a copy need no comparison
        rows = rows.withColumn("size", F.coalesce("size", F.lit(1).cast("long"))).withColumn(
            "rep", F.coalesce("rep", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "sha"))
        )
        rows = stage(rows, "rows")
        differing = stage(_different(docs, rows, id_col, text_col, chunk_bytes), "differing")
        if differing.isEmpty():
            done.append(rows)
            break
        same = (F.col("r.doc_id").eqNullSafe(F.col("d.doc_id"))) & (F.col("r.sha") == F.col("d.sha"))
        done.append(rows.alias("r").join(differing.alias("d"), same, "left_anti"))
        todo = stage(rows.alias("r").join(differing.alias("d"), same, "left_semi").drop("rep", "size"), "todo")
    out = reduce(DataFrame.unionByName, done)
    if len(done) > 1:  # a fingerprint was shared by different texts: count the groups anew
        sizes = stage(out.groupBy(F.col("rep.row").alias("rep_row")).agg(F.count(F.lit(1)).alias("n")), "sizes")
        out = out.drop("size").join(sizes, F.col("rep.row") == F.col("rep_row")).withColumnRenamed("n", "size")
    return out.select(
        "doc_id",
        F.col("rep.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("rep.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "n_bytes",
        F.col("raw").alias("raw_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows repeating a kept row's id and text are reduced to one.
    """
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select("doc_id", F.col("raw_sha256").alias("sha"))
    return rows_of(docs, kept, id_col, text_col, once=True)
