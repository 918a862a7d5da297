"""Hard negatives by angular triangle filtering.

Vectors are fixed-point integers floor(scale * x), kept as doubles, which
hold them exactly.  Every vector is stored with its norm and with its angles
to a few fixed reference directions.  Angles obey the triangle inequality: two
vectors whose angles to a direction are s and t lie between |s - t| and
min(s + t, 2 pi - s - t) apart.  The narrowest interval over all directions gives
an interval of the cosine, and times both norms bounds of the score, which are
widened by more than any rounding in them.  Only rows whose bounds overlap the
window of scores that is searched get integer scoring:

- positives: rows of the anchor's label from the k-th highest lower bound on;
- negatives: rows of other labels between 50 % and 95 % of a positive's score,
  from the third highest lower bound of the rows surely inside on.

Anchors and rows are dealt into blocks of bounded size, those of one label for
the positives; each pair of blocks is one task's tile, and the tiles' best
lists are merged per anchor (and positive).  Scores that doubles cannot hold
are made of Python integers; those beyond a long rank exactly and are reported as the
range's end.

Defined results: rows with a NULL id or label, or whose vector is NULL or holds
a NULL or non-finite component, take no part; an empty vector scores 0; of rows
that repeat an id one stays (the smallest label, then the smallest vector);
vectors of different lengths are never compared; a window of a negative positive
score is empty, that of 0 holds 0; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import stage
from lakeward.llm.scores import as_long, beyond, restored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is between these percentages of the positive's.
LOW, HIGH = 50, 95
REFERENCES, SEED = 8, 7
ANCHOR_BLOCK, SHARD_ROWS = 4096, 4096

HIT = "anchor_id long, vec_id long, score long, cut_off string"


@lru_cache(maxsize=8)
def directions(size: int, n: int = REFERENCES, seed: int = SEED) -> np.ndarray:
    """The fixed reference directions for vectors of ``size`` components: at most ``n``, perpendicular to each other."""
    if not size:
        return np.zeros((0, 0))
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((size, min(n, size))))[0].T


def fixed_point(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as doubles, or as Python integers where it is too large for one."""
    with np.errstate(over="ignore"):
        out = np.floor(x * float(scale))
    if np.isfinite(out).all():
        return out
    # the scale is a power of two, and such a component is a whole number
    return np.array([int(v) if np.isfinite(v) else int(c) * scale for v, c in zip(out.ravel(), x.ravel())], object).reshape(x.shape)


def angles_and_norm(x: np.ndarray, scale: int = SCALE) -> tuple[np.ndarray, float]:
    """The fixed-point vector's angles to the directions, and its norm; a zero vector's angles are right ones."""
    v = fixed_point(x, scale)
    top = max((abs(c) for c in v), default=0)
    d = directions(len(v))
    if not top:
        return np.full(len(d), np.pi / 2), 0.0
    u = np.array([float(c / top) for c in v]) if v.dtype == object else v / top
    length = float(np.linalg.norm(u))
    with np.errstate(over="ignore"):
        norm = length * float(top) if top < 2**1023 else np.inf
    return np.arccos(np.clip(d @ u / length, -1.0, 1.0)), norm


def bounds(angles: np.ndarray, norm: float, all_angles: np.ndarray, norms: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of one vector's scores with all rows that hold in spite of every rounding.

    ``all_angles`` has a line for each direction.
    """
    if not len(all_angles):
        return np.zeros(len(norms)), np.zeros(len(norms))
    # an error e of a cosine moves an angle by sqrt(2 e) at most
    slack = 4 * np.sqrt(2 * (size + 8) * 2.0**-52)
    mine = angles[:, None]
    apart, total = all_angles - mine, all_angles + mine
    least = np.maximum(np.abs(apart, out=apart).max(axis=0) - slack, 0.0)
    most = np.minimum(np.minimum(total.min(axis=0), 2 * np.pi - total.max(axis=0)) + slack, np.pi)
    with np.errstate(over="ignore", invalid="ignore"):
        product = norm * norms
        more = product * (1e-12 * (size + 8))
        low, high = product * np.cos(most) - more, product * np.cos(least) + more
    if not np.isfinite(product).all():
        low, high = np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)
    return low, high


def largest(x: np.ndarray) -> int | float:
    """The largest absolute value."""
    return np.abs(x).max() if x.size else 0


def exact_scores(q: np.ndarray, rows: np.ndarray, top: int | float) -> np.ndarray:
    """Integer inner products of one fixed-point vector and rows with components up to ``top``, as int64 or as Python integers."""
    if not len(q):
        return np.zeros(len(rows), np.int64)
    if q.dtype != object and rows.dtype != object and largest(q) * top * len(q) < 2**53:
        return (rows @ q).astype(np.int64)
    whole = lambda x: np.array([int(c) for c in x.ravel()], object).reshape(x.shape)
    return whole(rows) @ whole(q) if len(rows) else np.zeros(0, np.int64)


def _usable(df: DataFrame, id_col: str, vec_col: str, label: Column, scale: int) -> DataFrame:
    """vec_id, label, vec (array<double>), angles, norm, row order as given; a row for each id."""
    vec = F.transform(vec_col, lambda x: x.cast("double"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vec_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), vec.alias("vec"))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("v")).select("vec_id", "v.label", "v.vec")

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [angles_and_norm(np.asarray(v, float), scale) for v in pdf["vec"]]
            yield pdf.assign(angles=[a for a, _ in found], norm=[n for _, n in found])

    return rows.mapInPandas(measured, "vec_id long, label long, vec array<double>, angles array<double>, norm double")


def _tiled(anchors: DataFrame, rows: DataFrame, by: list[str], work, schema: str) -> DataFrame:
    """``work`` on every pair of an anchor block and a row block of a group ``by``: each block goes to all of the other side."""
    blocks = lambda df, size, name: df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    counts = stage(blocks(anchors, ANCHOR_BLOCK, "blocks").join(blocks(rows, SHARD_ROWS, "shards"), by), "blocks")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        number = F.pmod(F.xxhash64("vec_id"), F.col(f"{own}s")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))
        return df.join(counts, by).withColumn(own, number).withColumn(other, every).drop("blocks", "shards")

    tile = [*by, "block", "shard"]
    return dealt(anchors, "block", "shard").groupBy(*tile).cogroup(dealt(rows, "shard", "block").groupBy(*tile)).applyInPandas(work, schema)


class _Rows:
    """A block's rows as arrays."""

    def __init__(self, pdf: pd.DataFrame, scale: int):
        self.ids, self.norms, self.labels = (pdf[c].to_numpy() for c in ("vec_id", "norm", "label"))
        stacked = lambda c: np.stack(pdf[c].to_list()) if len(pdf) else np.zeros((0, 0))
        self.vecs = fixed_point(stacked("vec"), scale)
        self.top = largest(self.vecs)
        self.angles = np.ascontiguousarray(stacked("angles").T)

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        return exact_scores(q, self.vecs[at], self.top)


def _hits(hits: list[tuple[int, int, int]]) -> pd.DataFrame:
    out = pd.DataFrame({
        "anchor_id": [a for a, _, _ in hits], "vec_id": [v for _, v, _ in hits],
        "score": np.array([as_long(s) for _, _, s in hits], np.int64), "cut_off": pd.Series([beyond(s) for _, _, s in hits], dtype=object)})
    return out.astype({"anchor_id": "int64", "vec_id": "int64"})


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The ``k`` highest (id, score), ties to the smaller id."""
    if len(ids) > k and scores.dtype != object:
        first = scores >= np.partition(scores, -k)[-k]  # with all ties of the k-th
        ids, scores = ids[first], scores[first]
    ranked = sorted((-int(s), int(i)) for s, i in zip(scores, ids))[:k]
    return [(i, -s) for s, i in ranked]


def window(score: int, low_pct: int, high_pct: int) -> tuple[float, float]:
    """The window of a positive's score as doubles, a little wider than it is."""
    try:
        low, high = float(score) * low_pct / 100, float(score) * high_pct / 100
    except OverflowError:
        return -np.inf, np.inf
    return low - abs(low) * 1e-12, high + abs(high) * 1e-12


def _positives(anchors: DataFrame, rows: DataFrame, k: int, scale: int) -> DataFrame:
    """anchor_id, vec_id, score, cut_off: each anchor's first rows of its label."""

    def work(key, a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        hits, rows = [], _Rows(r, scale)
        for i, q, angles, norm in zip(a["vec_id"], a["vec"], a["angles"], a["norm"]) if len(r) else ():
            low, high = bounds(angles, norm, rows.angles, rows.norms, len(q))
            other = rows.ids != i
            if other.sum() > k:
                other &= high >= np.partition(low[other], -k)[-k]
            at = np.flatnonzero(other)
            hits += [(i, v, s) for v, s in best_of(rows.ids[at], rows.scores(fixed_point(q, scale), at), k)]
        return _hits(hits)

    return _first(_tiled(anchors, rows, ["label", "size"], work, HIT), ["anchor_id"], k)


def _negatives(anchors: DataFrame, rows: DataFrame, k: int, scale: int, low_pct: int, high_pct: int) -> DataFrame:
    """anchor_id, positive_id, vec_id, score, cut_off, positive_score: of each positive the first rows of other labels in its window."""

    def work(key, a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        hits, of, rows = [], [], _Rows(r, scale)
        for i, q, angles, norm, label, positives, p_scores, cuts in zip(*[a[c] for c in (
                "vec_id", "vec", "angles", "norm", "label", "positives", "scores", "cuts")]) if len(r) else ():
            low, high = bounds(angles, norm, rows.angles, rows.norms, len(q))
            goals = [(p, s, restored(int(s), c)) for p, s, c in zip(positives, p_scores, cuts)]
            windows = {s: window(s, low_pct, high_pct) for _, _, s in goals}
            # rows of other labels that overlap any window, and of these the ones that each window needs
            at = np.flatnonzero((rows.labels != label) & (high >= min(w[0] for w in windows.values()))
                                & (low <= max(w[1] for w in windows.values())))
            low, high = low[at], high[at]
            wanted = np.zeros(len(at), bool)
            for score, (since, to) in windows.items():
                overlap = (high >= since) & (low <= to)
                if np.isfinite(since):
                    inside = low[(low >= score * low_pct / 100) & (high <= score * high_pct / 100)]
                    if len(inside) >= k:
                        overlap &= high >= np.partition(inside, -k)[-k]
                wanted |= overlap
            at = at[wanted]
            scores = rows.scores(fixed_point(q, scale), at)
            for positive, reported, score in goals if len(at) else ():
                inside = ((100 * scores >= low_pct * score) & (100 * scores <= high_pct * score)).astype(bool)
                found = best_of(rows.ids[at][inside], scores[inside], k)
                hits += [(i, v, s) for v, s in found]
                of += [(positive, reported)] * len(found)
        return _hits(hits).assign(
            positive_id=np.array([p for p, _ in of], np.int64), positive_score=np.array([s for _, s in of], np.int64))

    found = _tiled(anchors, rows, ["size"], work, f"{HIT}, positive_id long, positive_score long")
    return _first(found, ["anchor_id", "positive_id"], k)


def _first(hits: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc_nulls_last("cut_off"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label",
    n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low_pct: int = LOW, high_pct: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the given columns.  Positives are the
    ``n_positives`` rows of the anchor's label with the highest scores; of each,
    the first ``n_negatives`` rows of other labels that score between ``low_pct``
    and ``high_pct`` percent of it are returned.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = stage(_usable(vectors, id_col, vec_col, label, scale), "vectors").withColumn("size", F.size("vec"))
    chosen = vectors.where(anchors).select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    mine = stage(rows.join(chosen, "vec_id", "left_semi"), "anchors").withColumn("size", F.size("vec"))
    positives = stage(_positives(mine, rows, n_positives, scale), "positives")
    lists = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("vec_id", "score", "cut_off")).alias("p")).select(
        "vec_id", F.col("p.vec_id").alias("positives"), F.col("p.score").alias("scores"), F.col("p.cut_off").alias("cuts"))
    with_positives = stage(mine.drop("size").join(lists, "vec_id"), "goals").withColumn("size", F.size("vec"))
    found = _negatives(with_positives, rows, n_negatives, scale, low_pct, high_pct)
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
