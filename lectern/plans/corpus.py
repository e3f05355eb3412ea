"""End-to-end compositions in one Spark session (no hand-off files):

* ``build_table``  documents -> records -> clustered records + profile
* ``cluster_table`` records -> clustered records + per-cluster profile
* ``review``        clustered records -> ordered report lines (sections + references)
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import feature_text
from lectern.operators import profile, vectors
from lectern.operators.clustering import DEFAULT_K, DEFAULT_MAX_ITER, DEFAULT_RESTARTS, DEFAULT_SEED, TOLERANCE, kmeans
from lectern.operators.sparse import sparse_kmeans, sparse_representatives
from lectern.operators.inference import CALL_PAUSE, REVIEW_RETRIES, TABLE_BACKOFF
from lectern.operators.references import global_ordinal, number_references, references_or_message
from lectern.operators.report import DEFAULT_FAN_IN, narrate_clusters, report_lines, review_sections
from lectern.session import cut_lineage
from lectern.sources.records import (
    FEATURE_FIELDS, REQUIRED_FIELDS, REQUIRED_FOR_REVIEW, require_non_empty, validate_columns,
)

# Default bound of a batch of records in one request, in bytes of JSON.
DEFAULT_BATCH_BYTES = 100_000

# Fallback labelling when clustering fails.
FAILED_DESCRIPTION = "Clustering failed"


@dataclass
class Clustered:
    records: DataFrame   # input columns + cluster INT + cluster_description
    profile: DataFrame   # one row per cluster (description, size, maps, representatives)
    k: int
    centers: Any = None  # rows (cluster, term, weight), or a list of vectors where an embedder was given


def with_row_id(df: DataFrame, id_col: str = "row_id", order: str | None = None) -> DataFrame:
    """Stable row id, fixed by a written table: the position in ``order`` from 1.

    Without an ``order`` column ids follow the scan's partitions, which is the
    order of the rows inside one file but not across files; name an order
    column (or bring ``id_col``) wherever references must follow the input.
    """
    if id_col in df.columns:
        return df
    if order is not None:
        return global_ordinal(df, order, id_col)
    return cut_lineage(df.withColumn(id_col, F.monotonically_increasing_id()))


def cluster_table(
    records: DataFrame,
    embedder: Callable[[DataFrame, str, list[str]], DataFrame] | None = None,
    k: int = DEFAULT_K,
    seed: int = DEFAULT_SEED,
    restarts: int = DEFAULT_RESTARTS,
    id_col: str = "row_id",
    on_error: str = "raise",
    max_iter: int = DEFAULT_MAX_ITER,
    start: DataFrame | list[list[float]] | None = None,
    tolerance: float = TOLERANCE,
) -> Clustered:
    """Feature text -> vectors -> k-means -> descriptions -> profile.

    ``embedder(df, text_col, id_cols)`` returns ``(id_cols..., embedding)``;
    the default is exact TF-IDF, which stays sparse rows (id, term, weight)
    throughout: no term is hashed and no vector is made dense.  ``on_error="label"`` puts
    every row in cluster 0 with the fixed failure text instead of raising.
    ``start`` are first centres to take instead of restarts, in the form of
    ``Clustered.centers``.
    """
    validate_columns(records, REQUIRED_FIELDS)
    require_non_empty(records)
    recs = with_row_id(records, id_col)
    try:
        feats = recs.select(id_col, feature_text(FEATURE_FIELDS).alias("feature_text"))
        if embedder is None:
            weights = vectors.tfidf_table(feats, "feature_text", id_col)
            res = sparse_kmeans(weights, feats, id_col, k=k, seed=seed, restarts=restarts, max_iter=max_iter, start=start, tolerance=tolerance, together=True)
            reps = sparse_representatives(weights, res.labels, id_col, "cluster", 3)
        else:
            vecs = cut_lineage(embedder(feats, "feature_text", [id_col]), "vectors")
            res = kmeans(vecs, "embedding", id_col, k=k, seed=seed, restarts=restarts, max_iter=max_iter, start=start, tolerance=tolerance)
            reps = vectors.representatives(vecs.join(res.labels, id_col), "cluster", "embedding", id_col, 3)
        # Written here, so that a failure of any stage is met here.  A description names every method of its cluster, so it grows
        # with the cluster: it is stored once, not once for every record, and looked up where records are read.  The lookup
        # is run over all records here as well.
        reps = cut_lineage(reps.join(recs.select(id_col, "title"), id_col), "representatives")
        base = cut_lineage(recs.join(res.labels, id_col), "clustered")
        desc = cut_lineage(profile.describe_clusters(base, "cluster", "method", reps), "descriptions")
        out = profile.attach_description(base, desc, "cluster")
        if out.agg(F.count_if(F.col("cluster_description").isNull())).first()[0]:
            raise ValueError("records without a description")
        prof = cut_lineage(profile.cluster_profile(base, "cluster", desc, reps, "method", "datasets", "year"), "profile")
        return Clustered(out, prof, res.k, res.centers)
    except Exception as exc:
        if on_error != "label":
            raise
        text = f"{FAILED_DESCRIPTION}: {exc}"
        out = recs.withColumns({"cluster": F.lit(0), "cluster_description": F.lit(FAILED_DESCRIPTION)})
        none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
        prof = out.agg(F.count(F.lit(1)).alias("size")).select(
            F.lit(0).alias("cluster"), F.lit(text).alias("description"), "size", F.array().cast("array<string>").alias("representative_papers"),
            *[none.alias(c) for c in ("common_methods", "common_datasets", "publication_years")])
        return Clustered(out, prof, 1)


def build_table(
    docs: DataFrame,
    fn: Callable[[str], str],
    key: str = "filename",
    text: str = "text",
    calls: Mapping[str, Any] | None = None,
    clustering: Mapping[str, Any] | None = None,
    only_success: bool = False,
) -> Clustered:
    """Documents -> extracted records -> clustered table (X1).

    ``calls`` are options of :func:`lectern.plans.extract.extract_records` (retries, multiplier, cap, pause, partitions,
    store, wave_calls), ``clustering`` those of :func:`cluster_table`.  Records with an error are clustered with the others
    unless ``only_success``.
    """
    from lectern.plans.extract import extract_records

    records = extract_records(docs, fn, key, text, **(calls or {}))
    if only_success:
        records = records.where("extraction_status = 'success'")
    return cluster_table(cut_lineage(records, "records"), **(clustering or {}))


def review(
    clustered: DataFrame,
    fn: Callable[[str], str],
    introduction: str,
    conclusion: str,
    batch_rows: int = profile.DEFAULT_BATCH_ROWS,
    fan_in: int = DEFAULT_FAN_IN,
    record_cols: Sequence[str] = ("title", "authors", "year", "method", "datasets", "contributions", "summary"),
    id_col: str = "row_id",
    pause: float = CALL_PAUSE,
    retries: int = REVIEW_RETRIES,
    multiplier: float = TABLE_BACKOFF,
    cap: float | None = None,
    partitions: int | None = None,
    batch_bytes: int | None = DEFAULT_BATCH_BYTES,
) -> DataFrame:
    """Clustered records -> ordered report lines ``(k1, k2, line)`` (X3).

    ``retries``, ``multiplier`` and ``cap`` are the model calls' attempts and back-off, ``partitions`` the calls at once.

    Every record reaches the narrative: each cluster's records go to the
    model in input-order batches of ``batch_rows`` records and ``batch_bytes`` bytes, and the partial texts are
    combined ``fan_in`` at a time, so no call and no task holds a whole hot
    cluster.
    """
    validate_columns(clustered, REQUIRED_FOR_REVIEW)
    require_non_empty(clustered)
    recs = with_row_id(clustered, id_col)
    grouped = profile.group_records(recs, "cluster", id_col, list(record_cols), batch_rows, batch_bytes)
    bodies = narrate_clusters(grouped, "cluster", fn, fan_in=fan_in, pause=pause, retries=retries, multiplier=multiplier, cap=cap, partitions=partitions)
    sections = review_sections(recs, "cluster", id_col, bodies, introduction, conclusion)
    refs = references_or_message(cut_lineage(number_references(recs, id_col, "citation"), "references"))
    return report_lines(sections, refs)
