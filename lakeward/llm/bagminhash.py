"""Near-duplicates by BagMinHash signatures of word-shingle multisets.

Weighted Jaccard similarity of two multisets is the sum of the smaller
counts over the sum of the larger ones.  A signature component is the
first point of a Poisson process over (shingle, weight): every shingle has
points with a time, a component and a weight level, drawn from a generator
that the shingle seeds, and a text sees the points whose level lies below the
shingle's count in it.  Two texts then agree in a component with a probability
of exactly their weighted Jaccard similarity.

Levels form a hierarchy of cells [0,1), [1,2), [2,4), [4,8) ...: a cell's
process is drawn as a whole, its points arrive in the order of time, and a
point's level says in which part of the cell it lies.  A text takes the cells
below its count, and from the last one the points below it.  A text's cells
give points until the next one is later than the latest first point of all
components, so a signature costs about as many points as the text has
shingles, not that many times the signature's length.

Texts with equal words are one class from the start.  Signatures are cut into
bands; texts that agree in a band share a bucket.  Buckets are dealt and sorted,
and each task scans its buckets twice.  The first scan sees signatures only: two
texts are candidates if they agree in enough components, have lengths that allow
the similarity, and share no earlier band, so a pair is a candidate in one bucket
only.  It keeps the texts that have a candidate, in groups that candidates
connect.  Their words are then fetched, and the second scan compares the
multisets themselves.  Both scans follow links from text to text: what is linked to the
first text leaves the rest of the group, then what is linked to those, so a
family of copies costs about its length, and a pair is compared only as long as
its texts are not joined by other links.  All pairs that share a bucket are
settled this way, and no pair becomes a row; the links' connected components are
the classes.

A bucket of more texts than a block is cut into tiles of two blocks, so no task
holds a whole bucket; a text then travels once for each tile and band where it
has a candidate.  The work of a crowded bucket grows with the pairs of texts that are candidates and
stay apart.

Defined results: words are runs of letters and digits, in lower case; a text
of fewer words than a shingle has one shingle of all its words; NULL text counts as empty,
and texts without words are one class; NULL ids sort after all others; rows
that repeat an id are separate members; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import rows_of, stage, text_or_empty
from lakeward.llm.graph import components
from lakeward.llm.words import hashes, mixed, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
#: Pairs whose signatures agree in fewer components are not compared: with a
#: similarity of 0.8 that happens once in about 10^8 pairs (six standard deviations).
SLACK_SD = 6.0
#: Texts of a block, and shingles that are compared at once.
BLOCK, COMPARED = 512, 2_000_000
#: Shingles whose points are drawn at once in a task.
AT_ONCE = 300_000

C_POINT, C_CELL, C_PART, C_LEVEL = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAAAAAAAAAAAAAAAB))


def shingles(w: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Different shingle hashes of word hashes, sorted, and their counts."""
    n = max(1, len(w) - width + 1)
    h = np.zeros(n, np.uint64)
    for j in range(min(width, len(w))):
        h = mixed(h + w[j:j + n] * C_POINT + np.uint64(j))
    if len(w) < width:
        h = mixed(h + np.uint64(len(w)) + C_PART)
    return np.unique(h, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets as :func:`shingles` gives them."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """One row of ``size`` point hashes for each multiset."""
    lengths = [len(b[0]) for b in bags]
    doc = np.repeat(np.arange(len(bags)), lengths)
    key = np.concatenate([b[0] for b in bags])
    weight = np.concatenate([b[1] for b in bags]).astype(np.float64)
    # a row for each cell: the first covers [0, 1), the k-th [2^(k-2), 2^(k-1))
    cells = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    at = np.repeat(np.arange(len(key)), cells)
    cell = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
    low = np.where(cell > 0, 2.0 ** (cell - 1), 0.0)
    width = np.where(cell > 0, low, 1.0)
    doc, seed, above = doc[at], mixed(key[at] + cell.astype(np.uint64) * C_CELL), weight[at] - low
    time, first = np.zeros(len(at)), np.full((len(bags), size), np.inf)
    point = np.zeros((len(bags), size), np.uint64)
    latest = np.full(len(bags), np.inf)
    while len(doc):
        seed = mixed(seed + C_POINT)
        time = time - np.log(_unit(seed)) / (size * width)
        soon = time <= latest[doc]
        doc, seed, above, width, time = doc[soon], seed[soon], above[soon], width[soon], time[soon]
        seen = (above >= width) | (_unit(mixed(seed + C_LEVEL)) * width <= above)
        d, t, s = doc[seen], time[seen], seed[seen]
        part = (mixed(s + C_PART) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, (d, part), t)
        best = first[d, part] == t
        point[d[best], part[best]] = s[best]
        latest = first.max(axis=1)
    return point


def _signed(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, width: int) -> DataFrame:
    """row, doc_id, sha, same (hash of the words), size (shingles), bands (array of long), sig (array of short), words."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        text_or_empty(text_col).alias("text"),
    ).withColumn("sha", F.sha2("text", 256))
    size = bands * rows

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(part: pd.DataFrame, found: list[str], bags: list) -> pd.DataFrame:
            sig = signatures(bags, size)
            band = np.zeros((len(bags), bands), np.uint64)
            for r in range(rows):
                band = mixed(band * C_POINT + sig[:, r::rows])
            return pd.DataFrame({
                "row": part["row"].to_numpy(), "doc_id": part["doc_id"].astype("Int64").array, "sha": part["sha"].to_numpy(),
                "same": [hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=16).digest() for x in found],
                "size": [int(b[1].sum()) for b in bags],
                "bands": list(band.view(np.int64)), "sig": list((sig >> np.uint64(48)).astype(np.uint16).view(np.int16)),
                "words": found,
            })

        for pdf in batches:
            start, found, bags, n = 0, [], [], 0
            for i, text in enumerate(pdf["text"]):
                w = words(text)
                found.append(" ".join(w))
                bags.append(shingles(hashes(w), width))
                n += len(bags[-1][0])
                if n >= AT_ONCE:
                    yield out(pdf.iloc[start:i + 1], found, bags)
                    start, found, bags, n = i + 1, [], [], 0
            if bags:
                yield out(pdf.iloc[start:], found, bags)

    return texts.mapInPandas(
        signed, "row long, doc_id long, sha string, same binary, size long, bands array<long>, sig array<short>, words string")


class _Texts:
    """The texts of one run of a tile: which pairs of them are candidates, and which are similar."""

    def __init__(self, run: pd.DataFrame, threshold: float, least: float):
        self.row, self.side, self.size = (run[c].to_numpy() for c in ("row", "side", "size"))
        self.bands, self.sig = np.stack(run["bands"].to_list()), np.stack(run["sig"].to_list())
        self.band, self.two = int(run["band"].iloc[0]), run["a"].iloc[0] != run["b"].iloc[0]
        self.threshold, self.least = threshold, least

    def candidates(self, i: int, rest: np.ndarray) -> np.ndarray:
        """Those of ``rest`` that may be similar to text ``i`` and share this band as their first one with it."""
        if self.two:
            rest = rest[self.side[rest] != self.side[i]]
        n = self.size[rest]
        rest = rest[np.minimum(n, self.size[i]) >= self.threshold * np.maximum(n, self.size[i])]
        rest = rest[(self.sig[rest] == self.sig[i]).sum(axis=1) >= self.least]
        return rest[(self.bands[rest] == self.bands[i]).argmax(axis=1) == self.band]

    def with_words(self, found: list[str], width: int) -> _Texts:
        bags = [shingles(hashes(x.split()), width) for x in found]
        self.keys, at = np.unique(np.concatenate([b[0] for b in bags]), return_inverse=True)
        self.places = np.split(at, np.cumsum([len(b[0]) for b in bags])[:-1])
        self.counts = [b[1] for b in bags]
        return self

    def similar(self, i: int, rest: np.ndarray) -> np.ndarray:
        """The candidates in ``rest`` whose multisets are similar enough to that of text ``i``."""
        j, out = self.candidates(i, rest), []
        if not len(j):
            return j
        count = np.zeros(len(self.keys), np.int64)
        count[self.places[i]] = self.counts[i]
        while len(j):
            take = max(1, int(np.searchsorted(np.cumsum([len(self.places[k]) for k in j]), COMPARED)))
            now, j = j[:take], j[take:]
            where = np.concatenate([self.places[k] for k in now])
            starts = np.cumsum([0] + [len(self.places[k]) for k in now[:-1]])
            common = np.add.reduceat(np.minimum(count[where], np.concatenate([self.counts[k] for k in now])), starts)
            out.append(now[common >= self.threshold * (self.size[i] + self.size[now] - common)])
        return np.concatenate(out)


def forest(n: int, linked) -> list[tuple[int, int]]:
    """A spanning forest of places 0 .. n - 1, where ``linked(i, rest)`` gives the places of ``rest`` that i has a link to."""
    rest, out = np.arange(n), []
    while len(rest) > 1:
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            found = linked(i, rest)
            if len(found):
                rest = np.setdiff1d(rest, found, assume_unique=True)
                out += [(i, int(j)) for j in found]
                todo += found.tolist()
    return out


def whole_runs(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Each run of equal ``by`` of sorted batches, in one piece."""
    rest: list[pd.DataFrame] = []  # of one run, which may go on
    for pdf in batches:
        if not len(pdf):
            continue
        keys = [pdf[c].to_numpy() for c in by]
        starts = np.flatnonzero(np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])))
        if rest and tuple(rest[0][c].iloc[0] for c in by) != tuple(k[0] for k in keys):
            yield pd.concat(rest)
            rest = []
        for at, to in zip(starts, [*starts[1:], len(pdf)]):
            rest.append(pdf.iloc[at:to])
            if to < len(pdf):
                yield pd.concat(rest) if len(rest) > 1 else rest[0]
                rest = []
    if rest:
        yield pd.concat(rest)


TILE = ["band", "value", "a", "b"]
FACTS = "size long, bands array<long>, sig array<short>"


def _tiles(buckets: DataFrame, block: int) -> DataFrame:
    """band, value, a, b (the tile), side, row: every text of a bucket of several, in each tile of its block."""
    shared = buckets.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # what is looked up grows with the corpus, so it is never broadcast
    rows = buckets.join(stage(shared, "shared").hint("merge"), ["band", "value"])
    blocks = F.ceil(F.col("n") / block).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("row"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select("band", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"), "row")


def _with_candidates(tiles: DataFrame, threshold: float, least: float) -> DataFrame:
    """The rows that have a candidate in their tile, with the first row of the group that candidates connect."""

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in whole_runs(batches, TILE):
            if len(run) < 2 or run["a"].iloc[0] != run["b"].iloc[0] and run["side"].nunique() < 2:
                continue
            texts, group = _Texts(run, threshold, least), np.full(len(run), -1)
            for i, j in forest(len(run), texts.candidates):
                if group[i] < 0:
                    group[i] = i  # trees are given from their root on
                group[j] = group[i]
            if (group >= 0).any():
                yield run.assign(leader=texts.row[np.maximum(group, 0)])[group >= 0]

    dealt = tiles.repartition(*TILE).sortWithinPartitions(*TILE)
    return dealt.mapInPandas(scanned, f"band int, value long, a int, b int, side int, row long, {FACTS}, leader long")


def _links(rows: DataFrame, threshold: float, least: float, width: int) -> DataFrame:
    """a, b: links that join all texts which similar pairs of a tile's groups join."""
    group = [*TILE, "leader"]

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in whole_runs(batches, group):
            texts = _Texts(run, threshold, least).with_words(run["words"].to_list(), width)
            found = forest(len(run), texts.similar)
            if found:
                i, j = np.array(found).T
                yield pd.DataFrame({"a": texts.row[i], "b": texts.row[j]})

    return rows.repartition(*group).sortWithinPartitions(*group).mapInPandas(linked, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY,
    bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE, block: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of the class), class_size, kept, n_links, raw_sha256.

    ``n_links`` counts the verified links that joined the document's text to
    different texts; equal texts share it.
    """
    signed = stage(_signed(docs, id_col, text_col, bands, rows, width), "signed")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    equal = stage(signed.groupBy("same").agg(F.min(place).alias("rep")).select("same", F.col("rep.row").alias("rep")), "equal")
    rep_rows = equal.select(F.col("rep").alias("row"))
    # joined before the bands become rows
    banded = signed.select("row", "bands").join(rep_rows, "row").select("row", F.posexplode("bands").alias("band", "value"))
    tiles = stage(_tiles(stage(banded, "banded"), block or BLOCK), "tiles")
    some = stage(tiles.select("row").distinct(), "some")
    facts = stage(signed.select("row", "size", "bands", "sig").join(some.hint("merge"), "row"), "facts")
    n = bands * rows
    least = threshold * n - SLACK_SD * (n * threshold * (1 - threshold)) ** 0.5
    near = stage(_with_candidates(tiles.join(facts.hint("merge"), "row").select(*TILE, "side", "row", "size", "bands", "sig"),
                                  threshold, least), "near")
    texts = signed.select("row", "words").join(near.select("row").distinct().hint("merge"), "row")
    links = stage(_links(near.join(stage(texts, "texts").hint("merge"), "row"), threshold, least, width), "links")
    labels = stage(components(links), "labels")
    ends = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    of_rep = equal.join(labels, F.col("rep") == F.col("node"), "left").join(ends, "rep", "left").select(
        "same", F.coalesce("label", "rep").alias("label"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    members = stage(signed.select("row", "doc_id", "sha", "same").join(stage(of_rep, "of_rep"), "same"), "members")
    classes = stage(members.groupBy("label").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("class_size")), "classes")
    return members.join(classes, "label").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "n_links", F.col("sha").alias("raw_sha256"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The first row of each class, with all its columns."""
    kept = near_duplicates(docs, id_col, text_col, **options).where("kept").select("doc_id", F.col("raw_sha256").alias("sha"))
    return rows_of(docs, kept, id_col, text_col, once=True)
