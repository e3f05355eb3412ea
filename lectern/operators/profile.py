"""Per-cluster profile: size, top values, histograms, descriptions, records.

Every statistic is one ``groupBy`` over all clusters (never a loop of
per-cluster filters), with partial aggregation before the shuffle.  Top-n
lists use ``row_number() <= n`` so Catalyst can limit each group map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.core import SENTINEL, is_present
from lectern.operators.joins import join_small
from lectern.operators.text import ordered_join

# Description layout.
DESCRIPTION_TEMPLATE = ("Cluster with ", " papers focusing on ", ". Key papers: ")


def cluster_slice(df: DataFrame, cluster: str, k: int) -> DataFrame:
    """Rows of one cluster (a pushed-down filter)."""
    return df.where(F.col(cluster) == F.lit(k))


def cluster_size(df: DataFrame, cluster: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))


def value_counts(df: DataFrame, cluster: str, col: str) -> DataFrame:
    """(cluster, value, cnt) with NULL values not counted."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(cluster, F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def top_values(df: DataFrame, cluster: str, col: str, n: int = 3) -> DataFrame:
    """The ``n`` most frequent values per cluster: count desc, then value asc."""
    w = Window.partitionBy(cluster).orderBy(F.col("cnt").desc(), F.col("value").asc())
    return value_counts(df, cluster, col).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def as_count_map(df: DataFrame, cluster: str, order: Sequence[Column], out: str) -> DataFrame:
    """(cluster, value, cnt) rows -> one MAP<value, cnt> per cluster, entries in ``order``."""
    entries = F.array_sort(F.collect_list(F.struct(*order, F.col("value").cast("string").alias("k"), F.col("cnt").alias("v"))))
    return df.groupBy(cluster).agg(
        F.map_from_entries(F.transform(entries, lambda e: F.struct(e["k"], e["v"]))).alias(out)
    )


def value_histogram(df: DataFrame, cluster: str, col: str) -> DataFrame:
    """Counts per value, one row per (cluster, value); sort by value to read it."""
    return value_counts(df, cluster, col)


def describe_clusters(
    df: DataFrame, cluster: str, method: str, reps: DataFrame, title: str = "title"
) -> DataFrame:
    """``Cluster with <n> papers focusing on <methods>. Key papers: <titles>``.

    Methods are the distinct present values, sorted (a deterministic order);
    titles are the representatives in rank order.  Distinct values are found
    by a (cluster, method) aggregate first, so duplicates never reach one task,
    and a cluster with very many distinct values is sorted and joined across
    many tasks, not in one.
    """
    sizes = cluster_size(df, cluster)
    # Distinct values first (partial aggregation map-side), then joined in
    # value order in two levels: range partitions of (cluster, value), merged by
    # adaptive execution where there are few values, hold
    # contiguous value ranges, each joined in its own task, and a cluster's
    # pieces (at most one per partition) are joined in partition order.
    distinct = df.where(is_present(method)).select(cluster, F.col(method).alias("_v")).distinct()
    ranged = distinct.repartitionByRange(cluster, "_v")
    runs = ranged.groupBy(cluster, F.spark_partition_id().alias("_run")).agg(
        ordered_join("_v", "_v", ", ").alias("_part"))
    methods = runs.groupBy(cluster).agg(ordered_join("_run", "_part", ", ").alias("methods"))
    titles = reps.groupBy(cluster).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", F.coalesce(F.col(title).cast("string"), F.lit(SENTINEL)).alias("t")))), lambda s: s["t"]),
            ", ",
        ).alias("titles")
    )
    a, b, c = DESCRIPTION_TEMPLATE
    return (
        sizes.join(methods, cluster, "left").join(titles, cluster, "left")
        .select(
            cluster, "size",
            F.concat(
                F.lit(a), F.col("size").cast("string"), F.lit(b), F.coalesce("methods", F.lit("")),
                F.lit(c), F.coalesce("titles", F.lit("")),
            ).alias("description"),
        )
    )


def attach_description(
    df: DataFrame, desc: DataFrame, cluster: str, out: str = "cluster_description"
) -> DataFrame:
    """Put each cluster's description on its rows (broadcast lookup, size-checked)."""
    small = desc.select(cluster, F.col("description").alias(out))
    return join_small(df, small, cluster, "left")


# Default number of records per batch of a cluster's record list.
DEFAULT_BATCH_ROWS = 50


def group_records(
    df: DataFrame, cluster: str, order: str, cols: Sequence[str], batch_rows: int = DEFAULT_BATCH_ROWS,
    batch_bytes: int | None = None,
) -> DataFrame:
    """Every record of every cluster, in ``order``, as consecutive batches.

    One row per (cluster, batch): ``(cluster, batch, size, records)`` where
    ``batch`` counts from 0, ``records`` holds at most ``batch_rows`` records
    sorted by ``order`` and ``size`` is the cluster's total.  Nothing is
    dropped: a hot cluster becomes many bounded batches instead of one huge
    list, and its positions come from :func:`group_ordinal`, which spreads
    the cluster over many tasks instead of sorting it in one.

    With ``batch_bytes`` a batch's records as a JSON list take at most so many
    bytes (:func:`byte_batches`); only a single longer record exceeds them.
    """
    from lectern.operators.references import group_ordinal

    if batch_rows < 1:
        raise ValueError("batch_rows must be at least 1")
    keep = df.select(cluster, order, *cols)
    if batch_bytes is not None:
        numbered = byte_batches(keep, cluster, order, batch_rows, batch_bytes)
    else:
        numbered = group_ordinal(keep, [cluster], order, "_pos").withColumn(
            "batch", F.floor((F.col("_pos") - 1) / F.lit(batch_rows)).cast("int"))
    lists = numbered.groupBy(cluster, "batch").agg(
        F.array_sort(F.collect_list(F.struct(order, *cols))).alias("records")
    )
    # ``numbered`` is checkpointed, so sizes come from it without a new scan.
    sizes = numbered.groupBy(F.col(cluster).alias("_c")).agg(F.count(F.lit(1)).alias("size"))
    # null-safe: NULL is a cluster of its own, as in GROUP BY
    return join_small(lists, sizes, F.col(cluster).eqNullSafe(F.col("_c"))).select(
        cluster, "batch", "size", "records")


def byte_batches(df: DataFrame, cluster: str, order: str, batch_rows: int, batch_bytes: int) -> DataFrame:
    """``df`` with ``batch``: consecutive batches of each cluster, by ``order``, bounded in rows and in bytes.

    A record's bytes are those of its JSON object and a separator.  Records of more than half of the bound are batches of their
    own.  The others are cut by the sum of bytes, and by the number of records, before them: where a sum passes a multiple
    of half the bound, a new batch begins, so less than a half is in it before its last record and less than a whole behind it.
    Sums and positions inside a cluster come from :func:`group_running`, batch numbers from :func:`group_ordinal` on one
    row per batch: a hot cluster is spread over tasks throughout.
    """
    from lectern.operators.references import group_ordinal, group_running
    from lectern.session import cut_lineage

    half = (batch_bytes - 1) // 2  # a list of n objects has n - 1 separators and two brackets
    if half < 1:
        raise ValueError("batch_bytes must be at least 3")
    rows = df.withColumn("_bytes", F.octet_length(F.to_json(F.struct(*[c for c in df.columns if c != cluster]))).cast("long") + 1)
    rows = rows.withColumn("_long", (F.col("_bytes") > half).cast("long")).withColumn("_one", F.lit(1).cast("long"))
    rows = rows.withColumn("_short", F.when(F.col("_long") == 0, F.col("_bytes")).otherwise(F.lit(0)))
    placed = group_running(rows, [cluster], order, {"_sum": "_short", "_longs": "_long", "_rows": "_one"})
    alone = F.col("_long") == 1
    cell = F.when(alone, F.lit(0)).otherwise(F.floor(F.col("_sum") / half)).cast("long")
    run = F.when(alone, F.lit(0)).otherwise(F.floor(F.col("_rows") / batch_rows)).cast("long")
    placed = placed.withColumns({"_cell": cell, "_run": run})
    key = ["_longs", "_long", "_cell", "_run"]
    batches = cut_lineage(placed.groupBy(cluster, *key).agg(F.min("_rows").alias("_first")), "batches")
    batches = group_ordinal(batches, [cluster], "_first", "_pos").select(
        F.col(cluster).alias("_c"), *[F.col(c).alias(f"_k{c}") for c in key], (F.col("_pos") - 1).cast("int").alias("batch"))
    cond = F.col(cluster).eqNullSafe(F.col("_c"))
    for c in key:
        cond = cond & (F.col(c) == F.col(f"_k{c}"))
    return cut_lineage(join_small(placed, batches, cond).select(*df.columns, "batch"), "batched")


def first_appearance(df: DataFrame, cluster: str, order: str) -> DataFrame:
    """(cluster, first) with the smallest ``order`` value of each cluster."""
    return df.groupBy(cluster).agg(F.min(order).alias("first"))


def cluster_profile(
    df: DataFrame,
    cluster: str,
    desc: DataFrame,
    reps: DataFrame,
    method: str,
    dataset: str,
    year: str,
    title: str = "title",
    n: int = 3,
) -> DataFrame:
    """One nested record per cluster: description, size, representative titles,
    top methods and datasets, and the year histogram (maps in value order)."""
    rep_titles = reps.groupBy(cluster).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(title).cast("string").alias("t")))), lambda s: s["t"])
        .alias("representative_papers")
    )
    methods = as_count_map(top_values(df, cluster, method, n), cluster,
                           [F.col("rank").alias("o")], "common_methods")
    datasets = as_count_map(top_values(df, cluster, dataset, n), cluster,
                            [F.col("rank").alias("o")], "common_datasets")
    years = as_count_map(value_histogram(df, cluster, year), cluster,
                         [F.col("value").cast("string").alias("o")], "publication_years")
    return (
        desc.select(cluster, "description", "size")
        .join(rep_titles, cluster, "left").join(methods, cluster, "left")
        .join(datasets, cluster, "left").join(years, cluster, "left")
    )
