"""The registered queries of the operators, with production parameters on their whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import (
    bagminhash, bpe, exact_dedup, hard_negatives, line_dedup, mixing, pii, secret_ledger, simhash, spelling, topk, toxicity, warc)
from lakeward.llm.common import shared_dir, table
from lakeward.llm.spans import joined

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of documents: which row of each group of equal texts stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web-archive records made of the pages: three captures of each, some of them not-modified revisits.

    A stand-in for archive files, which the test tables lack.
    """
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"))
    v = pages.withColumn("visit", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    # visits 1 and 2 are revisits for some pages, with a tag, a date, a stale tag or no validator
    kind = (F.col("page_id") + F.col("visit")) % 5
    revisit = (F.col("visit") > 0) & (kind != 0)
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    dated = pair("Last-Modified", F.lit("Mon, 01 Jan 2024 00:00:00 GMT"))
    served = pair("Date", F.concat(F.lit("visit "), F.col("visit").cast("string")))
    length = pair("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.lit("1")))
    own = (
        F.when(~revisit, F.array(pair("ETag", tag), dated, pair("Content-Type", F.lit("text/html"))))
        .when(kind == 1, F.array(pair("etag", tag)))
        .when(kind == 2, F.array(dated))
        .when(kind == 3, F.array(pair("ETag", F.lit('"stale"'))))
        .otherwise(F.array(pair("Content-Type", F.lit("text/plain"))))
    )
    seconds = F.col("visit") * 86400 + F.col("page_id") % 86400
    return v.select(
        (F.col("page_id") * 3 + F.col("visit")).alias("record_id"), "url",
        F.timestamp_seconds(F.lit(1704067200) + seconds).alias("ts"),
        F.when(revisit, F.lit(warc.NOT_MODIFIED)).otherwise(F.lit(warc.FULL)).alias("status"),
        F.concat(own, F.array(served, length)).alias("headers"),
        F.when(~revisit, F.col("digest")).alias("payload_digest"),
    )


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every capture of the pages with the payload and the headers that it resolves to."""
    out = warc.resolve_revisits(captures(spark, sf_dir))
    text = F.array_join(F.transform("headers", lambda h: F.concat_ws("=", h["name"], h["value"])), ";")
    return out.select("record_id", "url_key", "outcome", "source_id", "payload_digest", text.alias("headers"))


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of documents: multisets of five words, weighted Jaccard similarity of 0.8 or more."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """Where the public tokenizer file is; a cluster sets its own path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded to token ids and decoded again."""
    out = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return digests(out)


def digests(out: DataFrame) -> DataFrame:
    """What the query returns of encoded documents."""
    return out.select(
        "doc_id", F.expr("length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of documents, learned from the labelled rows that are not held out."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def op3_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of documents: base spans, and those found by bootstrapped contexts."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[_count(k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op7_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the later occurrences of repeated three-line windows."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_windows", "n_removed",
                      F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op9_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of documents through a blob ledger that first met an earlier state of the history, the odd ids.

    The second scan, of all documents, searches only the blobs that the first one lacked.
    """
    docs = table(spark, sf_dir, "documents")
    ledger = f"{shared_dir(spark).rstrip('/')}/lakeward-ledgers/{uuid.uuid4().hex}"
    secret_ledger.scan_history(docs.where(F.col("doc_id") % 2 == 1), ledger)
    found = secret_ledger.scan_history(docs, ledger).withColumnRenamed("spans", "base")
    text = joined(F.col("base"))
    return found.select(
        "doc_id",
        *[_count(r.kind).alias(f"n_{r.kind}") for r in secret_ledger.RULES],
        F.sha2(text, 256).alias("base_sha256"),
        text.alias("spans"),
        F.lower(F.hex("blob")).alias("blob_sha256"),
    )


#: The mixture's tree and target weights: a domain is a class of sources.
LEVELS = ("domain", "lang", "source")
WEIGHTS = {"domain": {"d0": 5, "d1": 3, "d2": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}}
FRACTION = 0.8


def with_domain(docs: DataFrame) -> DataFrame:
    """Documents with a domain, which the test tables lack: by the last character of the source."""
    return docs.withColumn("domain", F.concat(F.lit("d"), (F.ascii(F.right("source", F.lit(1))) % 3).cast("string")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document enters a mixture of 80 % of all tokens by domain, language and source weights."""
    return mixing.mix(with_domain(table(spark, sf_dir, "documents")), LEVELS, FRACTION, WEIGHTS)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents, some of them misspelt by rule, with the form that each is a variant of."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"), typo_every=spelling.TYPO_EVERY)
    return spelling.spelling_variants(words)


def op12_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of documents and the components that links of at most four differing bits make."""
    return simhash.near_components(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; every seventh vector's label is moved first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


QUERIES: dict[str, Query] = {
    q.__name__: q for q in (
        op1_exact_dedup, op2_warc_revisits, op3_contextual_pii, op4_bagminhash, op5_bpe, op6_toxicity, op7_line_windows,
        op8_exact_topk, op9_secret_ledger, op10_mixing, op11_spelling_variants, op12_simhash_variants, op13_hard_negatives,
    )
}
