"""Numbered reference list: dense 1..n numbering in a global order.

``row_number() OVER (ORDER BY ...)`` would move every row into one task.
Instead rows are range-partitioned and sorted, each row's position inside
its partition comes from ``monotonically_increasing_id`` (partition index in
the upper bits, position in the lower 33 bits), the partition sizes (one
row per partition) are summed by a window into offsets, and the offset
is joined back, broadcast if measured small.  The ordered frame is checkpointed to the
shared folder first, so ids stay fixed even if executors are lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.core import SENTINEL, is_present
from lectern.operators.joins import join_small
from lectern.session import cut_lineage

_LOW_BITS = (1 << 33) - 1

# Fixed value: text when no record has a usable citation.
NO_CITATIONS = "No valid citations found."


def _ranged(df: DataFrame, order: Sequence[str], partitions: int | None) -> DataFrame:
    """``df`` sorted across range partitions and written, with ``_mid``: partition and position in it.

    Without an explicit count the session's shuffle partitions are used, which
    adaptive execution merges where the data is small.
    """
    cols = [F.col(c) for c in order]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return cut_lineage(ranged.sortWithinPartitions(*cols).withColumn("_mid", F.monotonically_increasing_id()))


def global_ordinal(df: DataFrame, order: str, out: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` (ties -> arbitrary but stable)."""
    ranged = _ranged(df, [order], partitions).withColumn("_p", F.shiftright(F.col("_mid"), 33))
    sizes = ranged.groupBy(F.col("_p").alias("_rp")).agg(F.count(F.lit(1)).alias("_c"))  # one row per partition
    before = Window.orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_rp", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    joined = join_small(ranged, offsets, F.col("_p") == F.col("_rp"), "inner")
    pos = F.col("_before") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)) + F.lit(1)
    return joined.withColumn(out, pos.cast("long")).drop("_mid", "_p", "_rp", "_before")


def group_ordinal(
    df: DataFrame, group: Sequence[str], order: str, out: str = "ordinal", partitions: int | None = None
) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its ``group``, in ``order``.

    ``row_number() OVER (PARTITION BY group ORDER BY order)`` sorts a whole
    group in one task, so a hot group (a third of all rows) would sit in one
    task.  Here rows are range-partitioned on ``(group..., order)``, which
    spreads a hot group over many partitions; inside a partition each group
    is one contiguous run.  Per run, its start and size are aggregated (one
    row per run: at most groups + partitions rows), a window over each
    group's runs (at most one per partition) gives the rows in earlier
    partitions, and that offset joins back onto the rows.
    """
    group = list(group)
    ranged = _ranged(df, [*group, order], partitions)
    ranged = ranged.withColumn("_p", F.shiftright(F.col("_mid"), 33)).withColumn(
        "_low", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
    runs = ranged.groupBy("_p", *group).agg(F.min("_low").alias("_start"), F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("_p").alias("_rp"), *[F.col(g).alias(f"_r_{g}") for g in group], "_start",
        F.coalesce(F.sum("_c").over(before), F.lit(0)).cast("long").alias("_before"),
    )
    # Null-safe keys: NULL is a group of its own, as in GROUP BY.
    cond = F.col("_p") == F.col("_rp")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_r_{g}"))
    joined = join_small(ranged, runs, cond, "inner")
    pos = F.col("_before") + F.col("_low") - F.col("_start") + F.lit(1)
    drop = ["_mid", "_p", "_low", "_rp", "_start", "_before", *[f"_r_{g}" for g in group]]
    return joined.withColumn(out, pos.cast("long")).drop(*drop)


def group_running(df: DataFrame, group: Sequence[str], order: str, sums: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Add, for each ``out: column`` of ``sums``, the sum of ``column`` over the earlier rows of the row's ``group``, in ``order``.

    The weighted form of :func:`group_ordinal`: rows are range-partitioned on (group, order), so a hot group is spread over many
    tasks; a window inside one group's part of one partition gives running sums there, and the totals of the parts before
    it (one row per part) are joined on.  Nulls count as 0.  Ties of ``order`` keep some fixed order.
    """
    group = list(group)
    ranged = _ranged(df, [*group, order], partitions).withColumn("_p", F.shiftright(F.col("_mid"), 33))
    columns = {o: F.coalesce(F.col(c), F.lit(0)).cast("long") for o, c in sums.items()}
    part = Window.partitionBy("_p", *group).orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({f"_in_{o}": F.coalesce(F.sum(c).over(part), F.lit(0)) for o, c in columns.items()})
    parts = ranged.groupBy("_p", *group).agg(*[F.sum(c).alias(f"_t_{o}") for o, c in columns.items()])
    before = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_p").alias("_rp"), *[F.col(g).alias(f"_r_{g}") for g in group],
                         *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_b_{o}") for o in sums])
    cond = F.col("_p") == F.col("_rp")
    for g in group:  # NULL is a group of its own, as in GROUP BY
        cond = cond & F.col(g).eqNullSafe(F.col(f"_r_{g}"))
    joined = join_small(inside, parts, cond, "inner")
    joined = joined.withColumns({o: (F.col(f"_in_{o}") + F.col(f"_b_{o}")).cast("long") for o in sums})
    return joined.drop("_mid", "_p", "_rp", *[f"_r_{g}" for g in group], *[f"_{x}_{o}" for o in sums for x in ("in", "b")])


def number_references(df: DataFrame, order: str, citation: str = "citation") -> DataFrame:
    """Keep rows with a citation, number them from 1 in ``order``: ``[i] text``.

    Missing citations are filtered out *before* numbering, so there are no gaps.
    """
    valid = df.where(is_present(citation))
    numbered = global_ordinal(valid, order, "ref_no")
    return numbered.withColumn(
        "reference", F.concat(F.lit("["), F.col("ref_no").cast("string"), F.lit("] "), F.col(citation))
    )


def references_or_message(numbered: DataFrame) -> DataFrame:
    """The numbered lines, or one row with the fixed message when there are none."""
    if numbered.isEmpty():
        spark = numbered.sparkSession
        return spark.createDataFrame([(0, NO_CITATIONS)], "ref_no long, reference string")
    return numbered.select("ref_no", "reference")


__all__ = ["NO_CITATIONS", "SENTINEL", "global_ordinal", "group_ordinal", "group_running", "number_references", "references_or_message"]
