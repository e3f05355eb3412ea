"""CSV with line breaks inside cells, read by many tasks from one file.

Whether a line break ends a record depends on the number of quotes before it in the whole file, so a reader that starts in the
middle cannot tell.  Two passes can.  The first one reads byte ranges as lines and counts, for each, its quotes modulo two and
how many lines would start a record if the range began outside, or inside, a quoted cell; that is one row per range.  A
prefix sum over these rows says how every range begins and how many records there were before it.  The second pass
numbers the lines' records with that and puts the lines of one record together; records of a single line stay where
they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators.joins import join_small
from lectern.session import cut_lineage

# As the library writes it: cells with separators, quotes or line breaks are quoted, quotes inside are doubled.
_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true", "maxCharsPerColumn": "-1"}


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, value, quotes, odd, n0, n1): the lines of byte ranges, written once.

    ``odd`` tells whether an odd number of quotes is before the line in its range; ``n0`` and ``n1`` number its record in the range,
    if the range begins outside or inside a cell.  The windows are one byte range each, no longer than the session
    cuts files into (``spark.sql.files.maxPartitionBytes``).
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value", (F.length("value") - F.length(F.translate("value", '"', ""))).alias("quotes"))
    own = Window.partitionBy("file", "block").orderBy("at")
    odd = F.coalesce(F.sum("quotes").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumn("odd", odd.cast("int"))
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumns({"n0": F.sum(1 - F.col("odd")).over(upto), "n1": F.sum("odd").over(upto)})
    return cut_lineage(lines, "lines")


def block_starts(lines: DataFrame) -> DataFrame:
    """(file, block, inside, before): whether a range begins inside a cell, and the records that began before it; a row per range."""
    blocks = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.max("n0").alias("n0"), F.max("n1").alias("n1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).cast("int"))
    begun = F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1"))
    return blocks.select("file", "block", "inside", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("before"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, value): the text of every record, numbered from 1 in each file; blank lines between records are left out."""
    lines = csv_lines(spark, path)
    placed = join_small(lines, block_starts(lines), ["file", "block"])
    outside = F.col("inside") == 0
    placed = placed.select(
        "file", "block", "at", "value", "quotes", (F.col("before") + F.when(outside, F.col("n0")).otherwise(F.col("n1"))).alias("record"),
        ((F.col("odd") + F.col("inside")) % 2 == 0).alias("starts"))
    whole = F.col("starts") & (F.col("quotes") % 2 == 0)
    single = placed.where(whole).select("file", "record", "value")
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    several = placed.where(~whole).groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    text = F.when(F.endswith("value", F.lit("\r")), F.substring("value", F.lit(1), F.length("value") - 1)).otherwise(F.col("value"))
    return single.unionByName(several).withColumn("value", text).where("value <> ''")


def read_split_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The records of a file or folder with a header, as string columns; every file is read by as many tasks as it has ranges.

    The first record of every file is its header.  A record with another number of cells than ``columns`` is an error.
    """
    names = [f"c{i}" for i in range(len(columns))]
    rows = csv_records(spark, path).where("record > 1")
    schema = ", ".join(f"{n} string" for n in names)
    cells = rows.select(F.from_csv("value", schema, _OPTIONS).alias("r"))
    return cells.select(*[F.col(f"r.{n}").alias(c) for n, c in zip(names, columns, strict=True)])
