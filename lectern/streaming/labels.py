"""Documents extracted and labelled as they arrive.

Clustering is a batch job; what it leaves behind is a model: the number of documents, the document frequency of every term, and the
centres as rows (cluster, term, weight).  Models are stored as numbered versions and never change.  New documents are
extracted, weighed by the model's frequencies and given the nearest centre's label, one micro-batch at a time.  A
micro-batch notes its model version before it begins, and its results overwrite its own folder, so a batch that is tried again
gives the same rows even if a newer model has been stored meanwhile.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import feature_text
from lectern.operators.sparse import sparse_assign, sparse_centroids
from lectern.operators.vectors import document_frequencies, term_counts, weigh_terms
from lectern.plans.extract import extract_records
from lectern.session import cut_lineage
from lectern.sources.records import FEATURE_FIELDS
from lectern.streaming.ingest import incremental_ingest


@dataclass
class LabelModel:
    version: int
    n: int                  # documents that the frequencies count
    frequencies: DataFrame  # term, df
    centres: DataFrame      # cluster, term, weight


def fit_model(texts: DataFrame, labels: DataFrame, id_col: str, text_col: str, version: int) -> LabelModel:
    """A model of labelled texts: ``labels`` (id, cluster) may come from any clustering; a centre is its members' mean vector."""
    tf = cut_lineage(term_counts(texts, text_col, id_col), "tf")
    frequencies, n = cut_lineage(document_frequencies(tf), "frequencies"), texts.count()
    weights = weigh_terms(tf, frequencies, n, id_col)
    return LabelModel(version, n, frequencies, sparse_centroids(weights, labels, id_col, "cluster"))


def _versions(spark: SparkSession, path: str) -> list[int]:
    try:
        return sorted(r["version"] for r in spark.read.schema("version int").parquet(os.path.join(path, "versions")).distinct().collect())
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return []


def store_model(model: LabelModel, path: str) -> None:
    """Store a model as its version; a version that is there already is an error.

    The version is listed last, so nobody reads half a model.
    """
    spark = model.frequencies.sparkSession
    if model.version in _versions(spark, path):
        raise ValueError(f"model version {model.version} is there already")
    base = os.path.join(path, f"v{model.version}")
    model.frequencies.write.mode("overwrite").parquet(os.path.join(base, "frequencies"))
    model.centres.write.mode("overwrite").parquet(os.path.join(base, "centres"))
    spark.createDataFrame([(model.n,)], "n long").write.mode("overwrite").parquet(os.path.join(base, "size"))
    spark.createDataFrame([(model.version,)], "version int").coalesce(1).write.mode("append").parquet(os.path.join(path, "versions"))


def load_model(spark: SparkSession, path: str, version: int | None = None) -> LabelModel:
    """A stored model, by default the highest version."""
    there = _versions(spark, path)
    if not there or (version is not None and version not in there):
        raise ValueError(f"no model version {'' if version is None else version} in {path}")
    version = there[-1] if version is None else version
    base = os.path.join(path, f"v{version}")
    n = spark.read.parquet(os.path.join(base, "size")).first()["n"]
    return LabelModel(version, n, spark.read.parquet(os.path.join(base, "frequencies")), spark.read.parquet(os.path.join(base, "centres")))


def label_texts(texts: DataFrame, id_col: str, text_col: str, model: LabelModel) -> DataFrame:
    """(id, cluster): every text's nearest centre; a text without terms, or a null one, is a zero vector."""
    weights = weigh_terms(cut_lineage(term_counts(texts, text_col, id_col), "tf"), model.frequencies, model.n, id_col)
    return sparse_assign(weights, texts.select(id_col), model.centres, id_col)


def _pinned(spark: SparkSession, sink: str, batch_id: int, model_path: str) -> LabelModel:
    note = os.path.join(sink, "model_versions", f"batch_id={batch_id}")
    try:
        version = spark.read.schema("version int").parquet(note).first()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        version = None
    if version is not None:
        return load_model(spark, model_path, version["version"])
    model = load_model(spark, model_path)
    spark.createDataFrame([(model.version,)], "version int").coalesce(1).write.mode("overwrite").parquet(note)
    return model


def label_batch(batch: DataFrame, batch_id: int, sink: str, model_path: str, fn: Callable[[str], str], key: str, text: str, calls: Mapping[str, Any]) -> None:
    """Extract, weigh and label one micro-batch into ``<sink>/records/batch_id=<n>``."""
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    model = _pinned(spark, sink, batch_id, model_path)
    records = cut_lineage(extract_records(batch, fn, key, text, **calls), "records")
    texts = records.select(key, feature_text(FEATURE_FIELDS).alias("feature_text"))
    labels = label_texts(texts, key, "feature_text", model)
    out = records.join(labels, key).withColumn("model_version", F.lit(model.version))
    out.write.mode("overwrite").parquet(os.path.join(sink, "records", f"batch_id={batch_id}"))


def incremental_labels(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    model_path: str,
    fn: Callable[[str], str],
    key: str = "filename",
    text: str = "text",
    calls: Mapping[str, Any] | None = None,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> None:
    """New files of documents (key, text) -> records with ``cluster`` and ``model_version`` under ``<sink>/records``.

    Everything that is there is processed, then the call ends; a restart with the same checkpoint sees new files only.  A key is
    one document: documents whose pages span files are assembled first (``incremental_documents``).  ``calls`` are options of
    ``extract_records``; with a ``store`` among them a batch that is tried again makes no call twice.  Empty texts give no record.
    """
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        label_batch(batch, batch_id, sink, model_path, fn, key, text, dict(calls or {}))

    incremental_ingest(spark, source, schema, sink, checkpoint, lambda b: b, glob=glob, max_files_per_trigger=max_files_per_trigger, batch_writer=run_batch)


def labelled_records(spark: SparkSession, sink: str) -> DataFrame:
    """All records labelled so far."""
    return spark.read.parquet(os.path.join(sink, "records")).drop("batch_id")
