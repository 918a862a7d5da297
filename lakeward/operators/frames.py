"""DataFrame list helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL BY NAME`` of many DataFrames, combined as a balanced tree.

    Each ``unionByName`` re-analyses its inputs, so a left-deep chain over
    n parts costs O(n^2) analysis; pairing them costs O(n log n).  The
    physical plan is the same flat union either way.
    """
    level = list(parts)
    if not level:
        raise ValueError("nothing to union")
    while len(level) > 1:
        level = [level[i].unionByName(level[i + 1]) if i + 1 < len(level) else level[i]
                 for i in range(0, len(level), 2)]
    return level[0]


#: What Spark takes for the size of rows that come from no files, if it does not know it.
UNKNOWN_BYTES = (1 << 63) - 1


def input_bytes(df: DataFrame) -> int:
    """Bytes of what ``df``'s scans read, as Spark's file index gives them; no job runs, and unknown sizes count as none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(n for n in sizes if n < UNKNOWN_BYTES)
