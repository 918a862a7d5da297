"""Line dedup by overlapping three-line windows, with DataFrame functions only.

Every line is hashed, and every three consecutive lines make a window whose
key is the hash of its three line hashes.  A window that occurs more than
once in the corpus is repeated: its first occurrence (smallest doc_id, then
position) stays, and the lines that later occurrences cover are removed.
Windows overlap, so the positions to remove are the union of what the later
occurrences cover.

A line is what stands between line feeds, without surrounding blanks and tabs;
blank lines are no part of a window and always stay.  Keys are two 64-bit
hashes with different salts (128 bits).

Defined results: NULL text counts as empty; texts of fewer than three
non-blank lines have no window and stay whole; a window repeated inside one
text loses its later occurrences there too; NULL ids sort after all others;
rows that repeat an id are separate texts whose later copy loses its windows;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import stage, text_or_empty

WIDTH = 3
BLANKS = " \t\r"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, doc_id, lines (array of struct of the full line and whether it counts)."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.split(text_or_empty(text_col), "\n", -1).alias("lines"),
    )


def windows(lines: DataFrame, width: int = WIDTH) -> DataFrame:
    """row, doc_id, w0, w1, pos: a row for each window; ``pos`` counts the text's non-blank lines from 0."""
    bare = F.filter(F.transform("lines", lambda x: F.trim(x, F.lit(BLANKS))), lambda x: x != "")
    hashed = lines.select("row", "doc_id", F.transform(bare, lambda x: F.struct(
        F.xxhash64(F.lit(0), x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))).alias("h"))
    hashed = hashed.where(F.size("h") >= width)
    keys = F.transform(
        F.sequence(F.lit(0), F.size("h") - width),
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(*[F.get(F.col("h"), i + j)["a"] for j in range(width)]).alias("w0"),
            F.xxhash64(*[F.get(F.col("h"), i + j)["b"] for j in range(width)]).alias("w1"),
        ),
    )
    return hashed.select("row", "doc_id", F.inline(keys))


def repeated_lines(lines: DataFrame, width: int = WIDTH) -> DataFrame:
    """row, covered: the sorted positions of non-blank lines to remove, for texts that have any."""
    found = stage(windows(lines, width), "windows")
    # one row per repeated window, written so that a hot window is a skewed join AQE can split
    firsts = stage(
        found.groupBy("w0", "w1")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "pos")).alias("first"),
             F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("w0", "w1", F.col("first.row").alias("f_row"), F.col("first.pos").alias("f_pos")),
        "firsts",
    )
    later = found.join(firsts, ["w0", "w1"]).where((F.col("row") != F.col("f_row")) | (F.col("pos") != F.col("f_pos")))
    # a text's windows are at most as many as its lines
    starts = later.groupBy("row").agg(F.collect_set("pos").alias("starts"))
    merged = F.array_sort(F.array_distinct(F.flatten(
        F.transform("starts", lambda p: F.sequence(p, p + (width - 1))))))
    return starts.select("row", merged.alias("covered"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (what stays), n_lines, n_windows, n_removed."""
    lines = stage(_lines(docs, id_col, text_col), "lines")
    gone = repeated_lines(lines, width)
    out = lines.join(gone, "row", "left").withColumn("covered", F.coalesce("covered", F.array().cast("array<int>")))
    marked = F.transform("lines", lambda x, i: F.struct(i.alias("i"), (F.trim(x, F.lit(BLANKS)) != "").alias("full")))
    places = F.transform(F.filter(marked, lambda x: x["full"]), lambda x: x["i"])  # of the non-blank lines
    out = out.withColumn("places", places)
    out = out.withColumn("n_lines", F.size("places")).withColumn(
        "gone", F.transform("covered", lambda p: F.get(F.col("places"), p))
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    return out.select(
        "doc_id",
        F.when(F.size("covered") == 0, F.array_join("lines", "\n")).otherwise(text).alias("text"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.greatest(F.lit(0), F.col("n_lines") - (width - 1)).cast("long").alias("n_windows"),
        F.size("covered").cast("long").alias("n_removed"),
    )
