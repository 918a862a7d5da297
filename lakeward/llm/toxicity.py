"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the hashed words, pairs of neighbouring words and pairs
of words with one word between them that it holds (each once).  FTRL-proximal
keeps per coordinate the sums z and n of its gradients and their squares: the
learning rate falls with n, and a weight is zero while |z| is within the L1
bound, so the weights are few and small enough to broadcast.

Training is distributed: the labelled rows are dealt into shards, each shard
runs FTRL over its rows from the common state, and after each epoch the
shards' changes are averaged per coordinate.  The state has ``2 ** bits``
coordinates however much data there is.

The labelled sample is bounded by ``max_rows`` (a documented parameter; rows
with the smallest hashes of their ids are taken).  Scores cover all rows and
whole texts.

Defined results: NULL text counts as empty and is scored by the bias alone;
labels that are NULL are not learned from; of repeated labels of an id the
larger counts; a model that saw no label scores 0 everywhere; rows that repeat an id give a row each; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import stage, text_or_empty
from lakeward.llm.words import hashes, mixed, words

BITS = 19
MAX_ROWS = 16_000
SHARDS = 4
EPOCHS = 6


@dataclass(frozen=True)
class Ftrl:
    """Rate ``alpha``, ``beta`` and the L1 and L2 strengths."""

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0


def features(text: str, bits: int = BITS) -> np.ndarray:
    """Hashed features of a text, with repeats; the bias is the coordinate 0 and not among them."""
    w = hashes(words(text))
    if not len(w):
        return np.empty(0, np.int64)
    parts = [mixed(w)]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(w) > gap:
            parts.append(mixed(w[:-gap] * np.uint64(salt) + mixed(w[gap:])))
    slots = np.uint64((1 << bits) - 1)
    return (np.concatenate(parts) % slots).astype(np.int64) + 1


def weights_of(z: np.ndarray, n: np.ndarray, p: Ftrl) -> np.ndarray:
    """FTRL-proximal's weights in closed form."""
    return np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def probability(margin):
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35.0, 35.0)))


def learn(z: np.ndarray, n: np.ndarray, idx: np.ndarray, label: int, p: Ftrl) -> None:
    """One example: ``idx`` are its different coordinates, the bias among them."""
    zi, ni = z[idx], n[idx]
    w = weights_of(zi, ni, p)
    g = float(probability(w.sum())) - label
    z[idx] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / p.alpha * w
    n[idx] = ni + g * g


@dataclass(frozen=True)
class Model:
    """The coordinates whose weight is not zero, and their weights."""

    idx: np.ndarray
    weight: np.ndarray
    bits: int

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits)
        w[self.idx] = self.weight
        return w


def held_out(id_col: str) -> Column:
    """Whether the remainder of crc32 of the id's text by 5 is 0; rows without an id count as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _epoch(state, epoch: int, params: Ftrl):
    """A shard's changes to the common state by one pass over its rows, in an order of the epoch's own."""

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [p for p in batches if len(p)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)  # a part of the bounded sample
        z0, n0 = (x.astype(np.float64) for x in state.value)
        z1, n1 = z0.copy(), n0.copy()
        order = rows["doc_id"].map(lambda i: zlib.crc32(f"{epoch}:{i}".encode())).to_numpy()
        for i in np.lexsort((rows["doc_id"].to_numpy(), order)):
            learn(z1, n1, rows["idx"].iat[i], int(rows["label"].iat[i]), params)
        yield pd.DataFrame({"dz": [(z1 - z0).astype(np.float32).tobytes()], "dn": [(n1 - n0).astype(np.float32).tobytes()]})

    return shard


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = MAX_ROWS, shards: int = SHARDS, epochs: int = EPOCHS, bits: int = BITS, params: Ftrl = Ftrl(),
) -> Model:
    """Learn from at most ``max_rows`` labelled rows that are not held out."""
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(
        F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
    # at most max_rows pairs of an id and a label: a bounded broadcast, so that texts stay where they are
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            idx = [np.unique(np.append(features(t, bits), 0)).astype(np.int32) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "idx": pd.Series(idx, dtype=object)})

    rows = texts.join(F.broadcast(sample), "doc_id").mapInPandas(featured, "doc_id long, label int, idx array<int>")
    # rows that repeat an id are one (the smallest), so the bound holds for rows too
    rows = rows.groupBy("doc_id", "label").agg(F.min("idx").alias("idx"))
    # dealt by a hash and written once; each epoch's tasks then read their shards where they lie
    rows = stage(rows.repartition(shards, F.xxhash64("doc_id", F.lit(1))), "sample").coalesce(shards)
    sc = docs.sparkSession.sparkContext
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    for epoch in range(epochs):
        state = sc.broadcast((z.astype(np.float32), n.astype(np.float32)))
        # at most ``shards`` rows of 2^bits coordinates, whatever the input
        got = rows.mapInPandas(_epoch(state, epoch, params), "dz binary, dn binary").collect()
        for r in got:
            z += np.frombuffer(r["dz"], np.float32) / len(got)
            n += np.frombuffer(r["dn"], np.float32) / len(got)
        del got
        state.destroy()
    w = weights_of(z, n, params)
    idx = np.flatnonzero(w)
    return Model(idx, w[idx], bits)


def scorer(spark: SparkSession, model: Model):
    """A pandas UDF from a text to its score; the model's few weights are broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, bits = shared.value.dense(), shared.value.bits
        for texts in parts:
            margins = []
            for text in texts:
                idx = features(text, bits)
                margins.append(w[0] + w[np.unique(idx[w[idx] != 0])].sum())
            yield pd.Series(probability(np.array(margins, float)) if len(shared.value.idx) else np.zeros(len(texts)))

    return lambda text: scored(text_or_empty(text))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= 0.5, else 0)."""
    score = scorer(docs.sparkSession, train(docs, labels, id_col, text_col, **training))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), score(text_col).alias("score")).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    score = scorer(docs.sparkSession, train(docs, labels, id_col, text_col, **training))
    return docs.where(score(text_col) < 0.5)
