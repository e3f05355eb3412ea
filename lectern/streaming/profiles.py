"""Profiles of clusters that are kept up to date from new batches alone.

What a profile counts can be added up: per cluster its rows, and per cluster and field how often each value occurs.  A batch leaves
these counts in a folder of its own, overwritten when the batch is tried again; nothing that arrived earlier is read.  A
profile sums the counts, which are as many as there are different values, not rows.  Folders are merged into generations
as they become many: a generation is written whole and listed afterwards, readers take the newest listed one and the
batches behind it, so a merge that dies changes nothing, and one that is repeated gives the same sums.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.streaming.ingest import incremental_ingest

# Rows of a cluster are the counts of this field's one value.
ROWS = ""
# Batches behind the newest generation before they are merged.
MERGE_AFTER = 16


def value_counts(df: DataFrame, cluster: str, fields: Sequence[str]) -> DataFrame:
    """(cluster, field, value, cnt): how often each value of each field occurs in each cluster, and its rows.

    Values are strings; nulls are not counted, but their rows are.  One aggregate, partial before the shuffle, whatever the number
    of fields; a hot cluster's counts are dealt by value.
    """
    items = F.array(F.struct(F.lit(ROWS).alias("field"), F.lit("").alias("value")), *[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    rows = df.select(F.col(cluster).cast("string").alias("cluster"), F.explode(items).alias("i"))
    return rows.where("i.value IS NOT NULL").groupBy("cluster", "i.field", "i.value").agg(F.count(F.lit(1)).alias("cnt"))


def _merged(counts: DataFrame) -> DataFrame:
    return counts.groupBy("cluster", "field", "value").agg(F.sum("cnt").alias("cnt"))


class ProfileStore:
    """Counts of all batches so far under ``path``, a folder that all executors share."""

    _SCHEMA = "cluster string, field string, value string, cnt long, batch_id long"

    def __init__(self, spark: SparkSession, path: str, fields: Sequence[str], merge_after: int = MERGE_AFTER) -> None:
        self.spark, self.path, self.fields, self.merge_after = spark, path, list(fields), merge_after

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(os.path.join(self.path, name))
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return self.spark.createDataFrame([], schema)

    def generation(self) -> int:
        """The last batch that the newest listed generation holds; -1 where there is none."""
        last = self._read("generations", "upto long").agg(F.max("upto")).first()[0]
        return -1 if last is None else last

    def _behind(self, upto: int) -> DataFrame:
        return self._read("batches", self._SCHEMA).where(F.col("batch_id") > upto)

    def add(self, batch: DataFrame, batch_id: int, cluster: str) -> None:
        """Count a batch; the same number again replaces its counts, unless a generation already holds them."""
        upto = self.generation()
        if batch_id <= upto:
            return
        value_counts(batch, cluster, self.fields).write.mode("overwrite").parquet(os.path.join(self.path, "batches", f"batch_id={batch_id}"))
        if batch_id - upto >= self.merge_after:
            self.merge()

    def merge(self) -> None:
        """Merge all batches behind the newest generation but the last one, which may still be tried again, into a new one."""
        upto = self.generation()
        last = self._behind(upto).agg(F.max("batch_id")).first()[0]
        if last is None or last - 1 <= upto:
            return
        counts = _merged(self._generation(upto).unionByName(self._behind(upto).where(F.col("batch_id") < last).drop("batch_id")))
        counts.write.mode("overwrite").parquet(os.path.join(self.path, f"upto-{last - 1}"))
        self.spark.createDataFrame([(last - 1,)], "upto long").coalesce(1).write.mode("append").parquet(os.path.join(self.path, "generations"))

    def _generation(self, upto: int) -> DataFrame:
        schema = "cluster string, field string, value string, cnt long"
        return self._read(f"upto-{upto}", schema) if upto >= 0 else self.spark.createDataFrame([], schema)

    def counts(self) -> DataFrame:
        """(cluster, field, value, cnt) of all batches so far."""
        upto = self.generation()
        return _merged(self._generation(upto).unionByName(self._behind(upto).drop("batch_id")))

    def sizes(self) -> DataFrame:
        """(cluster, size)."""
        return self.counts().where(F.col("field") == ROWS).select("cluster", F.col("cnt").alias("size"))

    def top_values(self, n: int = 3) -> DataFrame:
        """(cluster, field, rank, value, cnt): the n most frequent values, ties to the smaller value."""
        w = Window.partitionBy("cluster", "field").orderBy(F.col("cnt").desc(), F.col("value").asc())
        ranked = self.counts().where(F.col("field") != ROWS).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
        return ranked.select("cluster", "field", "rank", "value", "cnt")

    def histogram(self, field: str) -> DataFrame:
        """(cluster, value, cnt) of one field."""
        return self.counts().where(F.col("field") == field).select("cluster", "value", "cnt")


def incremental_profile(
    spark: SparkSession, source: str, schema: T.StructType, store: ProfileStore, checkpoint: str, cluster: str,
    glob: str | None = None, max_files_per_trigger: int | None = None,
) -> None:
    """Count every new file of ``source`` into ``store``, then end; a restart with the same checkpoint sees new files only."""
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        store.add(batch, batch_id, cluster)

    incremental_ingest(spark, source, schema, store.path, checkpoint, lambda b: b, glob=glob, max_files_per_trigger=max_files_per_trigger, batch_writer=run_batch)
