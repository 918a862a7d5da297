"""Exact top-k inner-product search by tiled matrix products.

Queries and candidates are dealt into blocks of bounded size.  Every (query
block, candidate shard) pair is one tile: a task multiplies the two matrices
and keeps each query's best ``k`` of the shard.  The per-tile lists are merged
in a tree: first within groups of neighbouring shards, then per query.

Vectors are fixed-point integers floor(scale * x), so scores are exact: a
tile multiplies in float64 where no sum can reach 2^53 and in Python
integers otherwise.  Scores beyond a long rank exactly and are reported as the
end of its range.

Defined results: rows with a NULL id, or whose vector is NULL, empty or holds
a NULL or non-finite component, take no part.  A query's own id is never
among its candidates.  Rows repeating an id each count as a candidate; a
repeated query id is searched once, with its smallest vector.  Vectors of
different lengths are compared only within their length.  Other columns are
not read.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import stage
from lakeward.llm.hard_negatives import fixed_point
from lakeward.llm.scores import as_long, beyond

SCALE = 1024
QUERY_BLOCK = 1024
SHARD_ROWS = 1024
MERGE_FANIN = 16


def _usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.transform(vec_col, lambda x: x.cast("double"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & finite)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))


def _best(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's ``k`` best candidates of one tile, by score, then by id."""
    if q.dtype != object and c.dtype != object and float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < 2**53:
        scores = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        whole = lambda x: np.array([int(v) for v in x.ravel()], object).reshape(x.shape)
        scores = whole(q) @ whole(c).T
    out = []
    for row, q_id in zip(scores, q_ids):
        idx = np.flatnonzero(c_ids != q_id)
        if len(idx) > k and scores.dtype != object:
            own = row[idx]
            idx = idx[own >= np.partition(own, len(own) - k)[len(own) - k]]  # all ties of the k-th stay for now
        best = sorted(zip((-row[idx]).tolist(), c_ids[idx].tolist()))[:k]
        out += [(int(q_id), int(i), as_long(int(-s)), beyond(int(-s))) for s, i in best]
    return _hits(out)


def _hits(rows: list[tuple[int, int, int, str | None]]) -> pd.DataFrame:
    ids = {name: np.array([r[k] for r in rows], np.int64) for k, name in enumerate(("query_id", "vec_id", "score"))}
    return pd.DataFrame({**ids, "cut_off": pd.Series([r[3] for r in rows], dtype=object)})


def _limit_per_query(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc_nulls_last("cut_off"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
    scale: int = SCALE, query_block: int = QUERY_BLOCK, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest scores, ties to the smaller vec_id."""
    # a number of its own spreads rows that repeat an id and a vector
    cand = _usable(candidates, id_col, vec_col).withColumn("own", F.monotonically_increasing_id())
    quer = stage(_usable(queries, id_col, vec_col).groupBy("vec_id").agg(F.min("vec").alias("vec")), "queries")
    sizes = [cand.count(), quer.count()]
    shards, blocks = max(1, -(-sizes[0] // shard_rows)), max(1, -(-sizes[1] // query_block))
    dealt = lambda df, by, n: df.withColumn("part", F.pmod(F.xxhash64(by), F.lit(n)).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tile_c = dealt(cand, "own", shards).drop("own").withColumnRenamed("part", "shard").withColumn("block", every(blocks))
    tile_q = dealt(quer, "vec_id", blocks).withColumnRenamed("part", "block").withColumn("shard", every(shards))

    def tile(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = []
        for n, qs in q.groupby(q["vec"].str.len()) if len(q) else ():
            cs = c[c["vec"].str.len() == n]
            if len(cs):
                whole = lambda rows: fixed_point(np.stack(rows["vec"]), scale)
                found.append(_best(whole(qs), qs["vec_id"].to_numpy(), whole(cs), cs["vec_id"].to_numpy(), k))
        return (pd.concat(found) if found else _hits([])).assign(shard=key[0])

    lists = (
        tile_q.groupBy("shard", "block").cogroup(tile_c.groupBy("shard", "block"))
        .applyInPandas(tile, "query_id long, vec_id long, score long, cut_off string, shard int")
    )
    while shards > 1:  # merge the lists of neighbouring shards, level by level
        shards = -(-shards // MERGE_FANIN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / MERGE_FANIN).cast("int"))
        lists = _limit_per_query(lists, ["query_id", "shard"], k).drop("rank")
    return _limit_per_query(lists, ["query_id"], k).select("query_id", "rank", "vec_id", "score")
