"""A training corpus from documents, by five of the operators.

Toxic documents go, then exact copies, then near copies (one document of each
group stays); the rest is mixed to target weights, and what is selected is
encoded.  Each stage's result is written to the shared folder and read
again, so a later stage never recomputes an earlier one.

NULL texts count as empty; NULL ids, repeated rows, empty tables and further
columns have the results that the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeward.llm import bagminhash, bpe, exact_dedup, mixing, queries, toxicity
from lakeward.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return bagminhash.drop_near_duplicates(docs)


def select_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mixture of 80 % of the tokens by target weights, each document at most once."""
    domains = queries.with_domain(docs)
    chosen = mixing.select_mixture(domains, queries.LEVELS, queries.FRACTION, queries.WEIGHTS, max_epochs=1)
    return chosen.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with what they decode to, as counts and digests."""
    return queries.digests(bpe.encode(docs, queries.tokenizer_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", select_mixture),
    ("bpe", encode),
]

#: SQL expresses neither the learned classifier nor near-duplicate classes nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
