"""Incremental ingest with Structured Streaming.

New files in a source folder are picked up once each (the file source keeps
its log in the checkpoint), every micro-batch runs a DataFrame transform and
writes its result under ``<sink>/batch_id=<n>/`` in overwrite mode, so a
retried batch rewrites the same folder (idempotent).  ``availableNow``
processes everything present and stops; a restart with the same checkpoint
only sees files that arrived since.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lectern.operators.text import assemble_pages
from lectern.session import delete_path, is_folder, scratch_path


def incremental_ingest(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    batch_writer: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Run ``transform`` over every new file of ``source`` and append results to ``sink``.

    ``batch_writer(batch, batch_id)`` replaces the default writer (which puts
    ``transform(batch)`` under ``<sink>/batch_id=<n>/``, overwriting it).
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    q = (
        stream.writeStream.foreachBatch(batch_writer or write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


# Default number of key buckets of the stored pages (the unit of partition pruning).
PAGE_BUCKETS = 64
# Batches of pages behind the newest generation before they are merged into a new one.
MERGE_AFTER = 16


def page_generation(spark: SparkSession, sink: str) -> int:
    """The last batch whose pages the newest listed generation holds; -1 where there is none."""
    try:
        last = spark.read.schema("upto long").parquet(os.path.join(sink, "generations")).agg({"upto": "max"}).first()[0]
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        last = None
    return -1 if last is None else last


def _pages(spark: SparkSession, sink: str, upto: int, batch_id: int) -> DataFrame:
    """All pages up to a batch: the generation's, and those of the batches behind it."""
    from pyspark.sql import functions as F

    new = spark.read.parquet(os.path.join(sink, "pages")).where((F.col("batch_id") > upto) & (F.col("batch_id") <= batch_id)).drop("batch_id")
    if upto < 0:
        return new
    return spark.read.parquet(os.path.join(sink, f"pages-upto-{upto}")).unionByName(new)


def merge_pages(spark: SparkSession, sink: str, before: int) -> None:
    """Merge the pages of all batches below ``before``, which must be complete, into one generation, few files per bucket.

    The generation is written whole, then listed, then what it replaces is deleted; dying in between loses nothing, and whatever
    was not deleted is not read again.
    """
    upto = page_generation(spark, sink)
    if before - 1 <= upto:
        return
    merged = os.path.join(sink, f"pages-upto-{before - 1}")
    _pages(spark, sink, upto, before - 1).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(merged)
    spark.createDataFrame([(before - 1,)], "upto long").coalesce(1).write.mode("append").parquet(os.path.join(sink, "generations"))
    for b in range(upto + 1, before):
        delete_path(spark, os.path.join(sink, "pages", f"batch_id={b}"))
    if upto >= 0:
        delete_path(spark, os.path.join(sink, f"pages-upto-{upto}"))


def incremental_documents(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    key: str,
    order: str,
    text: str,
    buckets: int = PAGE_BUCKETS,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    merge_after: int = MERGE_AFTER,
) -> None:
    """Pages arriving in files -> assembled documents, kept current as pages arrive.

    A document's pages may span files and micro-batches.  Each micro-batch
    stores its pages under ``<sink>/pages/batch_id=<n>/bucket=<b>/`` (b a
    hash bucket of the key), then re-assembles only the documents it touched,
    from all their pages so far, into ``<sink>/docs/batch_id=<n>/``.  Only
    the buckets that the batch touches are read: give so many ``buckets`` that
    a batch touches a small part of them.  After ``merge_after`` batches their
    pages are merged into one generation, so a bucket's files stay few however
    many batches there are.  Both writes
    overwrite their batch folder, so a retried batch is idempotent;
    :func:`latest_documents` reads the newest version of each document.
    """
    from pyspark.sql import functions as F

    pages_path, docs_path = os.path.join(sink, "pages"), os.path.join(sink, "docs")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        # a batch begins when those before it are complete: they are never tried again
        if batch_id - page_generation(spark, sink) > merge_after:
            merge_pages(spark, sink, batch_id)
        upto = page_generation(spark, sink)
        new = batch.select(key, order, text).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        # Few files per bucket instead of one per input task and bucket; AQE
        # splits a hot bucket across tasks, so one hot key is not one task.
        new = new.hint("rebalance", "bucket")
        new.write.mode("overwrite").partitionBy("bucket").parquet(os.path.join(pages_path, f"batch_id={batch_id}"))
        touched = spark.read.parquet(os.path.join(pages_path, f"batch_id={batch_id}")).select(key, "bucket").distinct()
        # at most ``buckets`` numbers: literals, so that other buckets' folders are never read
        some = [r["bucket"] for r in touched.select("bucket").distinct().collect()]
        history = _pages(spark, sink, upto, batch_id).where(F.col("bucket").isin(some))
        mine = history.join(touched, [key, "bucket"], "left_semi")
        docs = assemble_pages(mine, key, order, text)
        docs.write.mode("overwrite").parquet(os.path.join(docs_path, f"batch_id={batch_id}"))

    incremental_ingest(spark, source, schema, sink, checkpoint, lambda b: b, glob=glob,
                       max_files_per_trigger=max_files_per_trigger, batch_writer=run_batch)


def latest_documents(spark: SparkSession, sink: str, key: str) -> DataFrame:
    """The newest assembled version of every document (one row per key)."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(os.path.join(sink, "docs"))
    cols = [c for c in docs.columns if c not in (key, "batch_id")]
    newest = docs.groupBy(key).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("_d"))
    return newest.select(key, "_d.*")


def incremental_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations streamed from the table's file or folder of files and assembled per
    conversation (turn = page), kept current across micro-batches, then the
    newest version of each read back from the sink."""
    table = os.path.join(sf_dir, "conversations.parquet")
    conv_schema = spark.read.parquet(table).schema
    sink = scratch_path(spark, "ingest-sink")
    ckpt = scratch_path(spark, "ingest-ckpt")
    # a stream reads a folder: the table's own, or the one that its single file is in
    source, glob = (table, None) if is_folder(spark, table) else (sf_dir, "conversations.parquet")
    incremental_documents(spark, source, conv_schema, sink, ckpt, "conv_id", "turn", "text", glob=glob)
    return latest_documents(spark, sink, "conv_id")
