"""Join helper: a side is broadcast only after it was written and measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.session import cut_lineage, measured_bytes

# Default ceiling for a broadcast side, in bytes of its rows in memory.
BROADCAST_LIMIT = 16 * 1024 * 1024
# Files this much smaller are within it without a look at the rows: they are compressed, but not that far.
FILE_RATIO = 16
# What a row takes besides its values.
ROW_BYTES = 64


def row_bytes(df: DataFrame) -> int:
    """What the rows of a written table take in memory, by the length of their values as JSON."""
    one = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()
    return one["n"] * ROW_BYTES + (one["b"] or 0)


def join_small(big: DataFrame, small: DataFrame, on: str | list[str] | Column, how: str = "inner", limit_bytes: int = BROADCAST_LIMIT,
               made: list[DataFrame] | None = None) -> DataFrame:
    """Join ``small`` onto ``big`` without shuffling ``big`` where ``small`` proves to be small.

    ``small`` (an aggregate: one row per cluster, run or partition) is written to the scratch folder and its files
    are measured, and its rows where the compressed files leave it open.  Within ``limit_bytes`` it is broadcast, so a hot key of ``big`` stays where it is; past it the join
    is a shuffle join, whose skewed keys adaptive execution may split.  The written table is added to ``made``, for who discards it.
    """
    small = cut_lineage(small, "small")
    if made is not None:
        made.append(small)
    files = measured_bytes(small)
    if FILE_RATIO * files <= limit_bytes or (files <= limit_bytes and row_bytes(small) <= limit_bytes):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
