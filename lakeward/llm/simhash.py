"""Near-duplicates by SimHash fingerprints and deletion-variant signatures.

A text's fingerprint has a bit set where more than half of its shingles' hashes
have it.  Two fingerprints are linked if at most ``max_bits`` bits differ.  The
64 bits are cut into so few segments that one of them differs by one bit at
most (three segments for four bits).  A segment has a signature for each of
its bits: the segment without that bit, which is a wildcard.  Two segments that
differ by at most one bit have a signature in common, so equal signatures
find every link: 64 rows for each different fingerprint, joined by equality.

The rows are dealt by signature and sorted, and each task scans its runs of
equal signatures with exact bit counts.  A linked pair belongs to the first
signature it shares, and in each run only a spanning forest of such pairs is
emitted: starting from any fingerprint, those linked to it leave the rest of the
run, and then those linked to them, so a run of fingerprints that belong
together costs its length, not its square.  A run larger than a block (known
beforehand from the counts of whole segments, three rows for each fingerprint)
is cut into tiles of two blocks, so that no task holds a whole run.

Copies are one fingerprint from the start.  The forests' connected components
are the classes, and so all links count.

Defined results: NULL text counts as empty; texts without words have the
fingerprint zero, which is linked like any other; a component's id is its
smallest doc_id, NULL if all are NULL; rows that repeat an id are separate
members and NULL ids give a row; an empty table gives an empty result; a very
long text is held once by its task, its hashes ``AT_ONCE`` at a time; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import stage, text_or_empty
from lakeward.llm.graph import components

BITS = 64
SHINGLE, SEED = 4, 42
MAX_BITS, SEGMENTS = 4, 3
#: Fingerprints of a run that are compared in one piece.
BLOCK = 32_768
#: Runs of at most so many fingerprints are compared by shifting the rows.
SMALL = 8
#: Shingle hashes whose bits are counted at once.
AT_ONCE = 1 << 16


def fingerprint(text: str, width: int = SHINGLE, seed: int = SEED) -> int:
    """The text's fingerprint as a signed 64-bit integer."""
    w = text.encode().lower().split()  # bytes have ASCII cases and ASCII white space only
    if not w:
        return 0
    body, hashed = b" ".join(w), xxhash.xxh64_intdigest
    if len(w) <= width:
        return int(np.uint64(hashed(body, seed)).astype(np.int64))
    sizes = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[:len(w) - width + 1].tolist(), ends[width - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), AT_ONCE):
        h = np.array([hashed(body[a:b], seed) for a, b in zip(starts[at:at + AT_ONCE], ends[at:at + AT_ONCE])], np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp (long) for each row of ``docs``."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"),
                "fp": np.array([fingerprint(t, width, seed) for t in pdf["text"]], np.int64)})

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return texts.mapInPandas(made, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def segments(n: int = SEGMENTS) -> list[tuple[int, int]]:
    """First and last bit (exclusive) of each segment."""
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def _mask(low: int, high: int, without: int | None = None) -> int:
    full = (1 << high) - (1 << low)
    return _signed(full if without is None else full & ~(1 << without))


def _signature(pos: Column, parts: list[tuple[int, int]]) -> Column:
    """What is left of the fingerprint's segment of bit ``pos`` without that bit."""
    masks = [F.lit(_mask(a, b, p)) for a, b in parts for p in range(a, b)]
    return F.col("fp").bitwiseAND(F.element_at(F.array(*masks), pos + 1))


def _crowded(fps: DataFrame, parts: list[tuple[int, int]], block: int) -> DataFrame:
    """pos, value, n: signatures that may have more than ``block`` fingerprints, with the blocks they are cut into.

    A signature has the fingerprints of two whole segments; one of them has
    more than half a block if both together have more than one.
    """
    whole = fps.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("segment"), F.col("fp").bitwiseAND(F.lit(_mask(a, b))).alias("fp")) for i, (a, b) in enumerate(parts)
    ])).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * 2 > block)
    bits = F.element_at(F.array(*[F.sequence(F.lit(a), F.lit(b - 1)) for a, b in parts]), F.col("s.segment") + 1)
    each = whole.select("s.fp", "n", F.explode(bits).alias("pos")).withColumn("value", _signature(F.col("pos"), parts))
    counts = each.groupBy("pos", "value").agg(F.ceil(F.sum("n") / block + 0.5).cast("int").alias("n"))
    return counts.where("n > 1")


def _rows(fps: DataFrame, parts: list[tuple[int, int]], block: int) -> DataFrame:
    """pos, value, a, b (the tile), side, fp: a row for each signature of a fingerprint, and tile it is in."""
    rows = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("pos")).withColumn(
        "value", _signature(F.col("pos"), parts))
    zero = F.lit(0)
    crowded = stage(_crowded(fps, parts, block), "crowded")
    if crowded.isEmpty():
        return rows.select("pos", "value", zero.alias("a"), zero.alias("b"), zero.alias("side"), "fp")
    rows = rows.join(crowded, ["pos", "value"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return rows.select(
        "pos", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp")


def _first_signature(x: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """The first signature two fingerprints share, from their differing bits ``x``."""
    out = np.full(len(x), BITS, np.int64)
    for a, b in reversed(parts):
        diff = x & np.uint64(_mask(a, b) % (1 << BITS))
        n = np.bitwise_count(diff)
        out = np.where(n == 0, a, np.where(n == 1, np.bitwise_count(diff - np.uint64(1)), out))
    return out


def linked(x: np.ndarray, pos: np.ndarray | int, max_bits: int, parts: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs, given by their differing bits, are links and share no signature before ``pos``."""
    near = np.bitwise_count(x) <= max_bits
    at = np.flatnonzero(near)
    near[at] = _first_signature(x[at], parts) == (pos[at] if isinstance(pos, np.ndarray) else pos)
    return near


def forest(fp: np.ndarray, side: np.ndarray, pos: int, max_bits: int, parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A spanning forest, as pairs of places, of the links between the two sides, or within the one side there is."""
    two = bool(side.any())
    rest, out = np.arange(len(fp)), []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            hit = linked(fp[rest] ^ fp[i], pos, max_bits, parts)
            if two:
                hit &= side[rest] != side[i]
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                out += [(i, j) for j in found]
                todo += found.tolist()
    return out


def _links(rows: DataFrame, max_bits: int, parts: list[tuple[int, int]]) -> DataFrame:
    """a, b: links whose components are those of all links."""
    tile = ["pos", "value", "a", "b"]

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_run = None

        def pairs(run: list[np.ndarray]) -> pd.DataFrame:
            pos, fp, side = run[0], run[5].view(np.uint64), run[4]
            new = np.ones(len(pos), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in run[:4]])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(pos)))
            size = np.repeat(sizes, sizes)
            one, other = [], []
            for step in range(1, SMALL):  # neighbours in small runs
                i = np.flatnonzero((size[:-step] > step) & (size[:-step] <= SMALL))
                i = i[~np.logical_or.reduce([new[i + k] for k in range(1, step + 1)])] if len(i) else i
                tile_ok = (run[2][i] == run[3][i]) | (side[i] != side[i + step])
                i = i[tile_ok]
                i = i[linked(fp[i] ^ fp[i + step], pos[i], max_bits, parts)]
                one.append(fp[i])
                other.append(fp[i + step])
            for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
                own, sides = fp[s:s + n], side[s:s + n]
                if run[2][s] != run[3][s] and sides.min() == sides.max():
                    continue  # a tile with one of its blocks empty
                found = forest(own, sides, int(pos[s]), max_bits, parts)
                if found:
                    ends = np.array(found)
                    one.append(own[ends[:, 0]])
                    other.append(own[ends[:, 1]])
            return pd.DataFrame({"a": np.concatenate(one).view(np.int64), "b": np.concatenate(other).view(np.int64)})

        for pdf in batches:
            if not len(pdf):
                continue
            columns = [pdf[c].to_numpy() for c in (*tile, "side", "fp")]
            if open_run is not None:
                columns = [np.concatenate(c) for c in zip(open_run, columns)]
            # the last run may go on in the next batch
            last = np.logical_and.reduce([c == c[-1] for c in columns[:4]])
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut:
                yield pairs([c[:cut] for c in columns])
            open_run = [c[cut:] for c in columns]
        if open_run is not None:
            yield pairs(open_run)

    dealt = rows.repartition(*tile).sortWithinPartitions(*tile)
    return dealt.mapInPandas(scanned, "a long, b long")


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, n_segments: int = SEGMENTS,
    width: int = SHINGLE, seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, component_size (rows)."""
    if max_bits >= 2 * n_segments:
        raise ValueError("a segment could differ by two bits; take more segments")
    parts = segments(n_segments)
    of_docs = stage(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    fps = stage(of_docs.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "different")
    links = stage(_links(_rows(fps.select("fp"), parts, block), max_bits, parts), "links")
    labels = stage(components(links), "components")
    labelled = stage(fps.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), "first", "n"), "labelled")
    least = stage(labelled.groupBy("label").agg(F.min("first").alias("component_id"), F.sum("n").alias("component_size")), "least")
    of_fp = stage(labelled.join(least, "label").select("fp", "component_id", "component_size"), "of-fingerprint")
    return of_docs.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size")
