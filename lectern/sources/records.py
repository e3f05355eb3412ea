"""Record schema, CSV/JSON/Markdown sources and sinks, document files.

Inside the library columns are snake_case; the display names below exist
only at the CSV boundary.  Parquet is the working format.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.core import SENTINEL, sentinel_or

# Pages that a decoding task holds at a time.
PAGE_SLICE = 256

# Record columns and their display names, in file order.
DISPLAY_NAMES = {
    "filename": "filename",
    "extraction_status": "extraction_status",
    "title": "Paper Title",
    "authors": "Authors",
    "year": "Year of Publication",
    "method": "Meta-Learning Method Used",
    "features_chosen": "Meta-Features Chosen",
    "selection_method": "Algorithm Selection Method",
    "algorithms": "Algorithms Considered for Selection",
    "metrics": "Evaluation Metrics",
    "datasets": "Dataset(s) Used",
    "performance": "Performance of Meta-Learning Approach",
    "contributions": "Key Findings/Contributions",
    "feature_generation": "Meta-Feature Generation Process",
    "limitations": "Limitations",
    "summary": "Simple Summary",
    "citation": "IEEE Citation",
    "error_message": "error_message",
}
CLUSTER_DISPLAY = {"cluster": "Cluster", "cluster_description": "Cluster Description"}

# Fields every clustering / review input must have.
REQUIRED_FIELDS = [
    "title", "authors", "year", "method", "features_chosen", "selection_method", "algorithms", "metrics",
    "datasets", "performance", "contributions", "feature_generation", "limitations", "summary", "citation",
]
REQUIRED_FOR_REVIEW = REQUIRED_FIELDS + ["cluster", "cluster_description"]

# Fixed value: the fields that make up the clustering text, in order.
FEATURE_FIELDS = [
    "title", "method", "features_chosen", "selection_method", "algorithms", "datasets", "contributions", "summary",
]

DETAIL_FIELDS = [
    "method", "features_chosen", "selection_method", "algorithms", "metrics", "datasets", "performance",
    "contributions", "feature_generation", "limitations",
]

RECORD_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in DISPLAY_NAMES]
)


def record_schema(with_cluster: bool = False) -> T.StructType:
    fields = list(RECORD_SCHEMA.fields)
    if with_cluster:
        fields += [T.StructField("cluster", T.IntegerType(), True),
                   T.StructField("cluster_description", T.StringType(), True)]
    return T.StructType(fields)


def to_display(df: DataFrame) -> DataFrame:
    names = {**DISPLAY_NAMES, **CLUSTER_DISPLAY}
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def from_display(df: DataFrame) -> DataFrame:
    back = {v: k for k, v in {**DISPLAY_NAMES, **CLUSTER_DISPLAY}.items()}
    return df.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns])


# ---------------------------------------------------------------- documents

def scan_documents(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """Files of one folder matching ``glob`` (not recursive): (filename, path, length, content).

    The binary file source splits work by file; the file name is the key.
    Contents are only read where the ``content`` column is used.
    """
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "false")
        .load(folder)
    )
    return df.select(
        F.element_at(F.split(F.col("path"), "/"), -1).alias("filename"), "path", "length", "content"
    )


def decode_pages(
    files: DataFrame, decoder: Callable[[bytes], Iterable[str]], key: str = "filename"
) -> DataFrame:
    """Injected page decoder -> (key, page_no, text); a failing file yields one empty page.

    A decoder may return its pages as a list or, for large files, as an iterator: then a first pass finds whether it
    fails, a second one gives the pages, and no more than ``PAGE_SLICE`` pages are held at a time.
    """
    schema = T.StructType([
        T.StructField(key, T.StringType()), T.StructField("page_no", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ])

    def pages_of(content: bytes | None) -> Iterable[str]:
        try:
            pages = decoder(bytes(content))
            if isinstance(pages, Iterator):
                count = sum(1 for _ in pages)
                return decoder(bytes(content)) if count else [""]
            return list(pages) or [""]
        except Exception:
            return [""]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                pages, at = iter(pages_of(content.as_py())), 0
                while texts := [t or "" for t in itertools.islice(pages, PAGE_SLICE)]:
                    nos = pa.array(range(at, at + len(texts)), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name.as_py()] * len(texts), pa.string()), nos, pa.array(texts, pa.string())], names=schema.names)
                    at += len(texts)

    return files.select(key, "content").mapInArrow(run, schema)


# ---------------------------------------------------------------- records

def read_records(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True, split: bool = False
) -> DataFrame:
    """CSV with header, quoted cells; fails fast on malformed input.

    Columns have the names in the header (:func:`from_display` gives internal
    ones) and are strings; no inference pass is made.  With ``schema`` given,
    columns are matched by name, display or internal, whatever their order in
    the file: all must be there (else a ``ValueError`` lists those that are
    missing), and they are cast to its types and returned in its order.
    ``multi_line=False`` lets Spark split large files whose cells have no line
    breaks; ``split=True`` reads large files by ranges although they have some
    (:mod:`lectern.sources.csv_split`).  A missing path is a ``FileNotFoundError``, a file without a header
    a ``ValueError``.
    """
    from pyspark.errors import AnalysisException

    reader = (
        spark.read.option("header", "true").option("multiLine", str(multi_line).lower())
        .option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
    )
    try:
        raw = reader.csv(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"no records at {path}") from exc
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            raise ValueError(f"no header in {path}") from exc
        raise
    if not raw.columns:
        raise ValueError(f"no header in {path}")
    if split:
        from lectern.sources.csv_split import read_split_csv

        raw = read_split_csv(spark, path, raw.columns)
    if schema is None:
        return raw
    raw = from_display(raw)
    back = {v: k for k, v in {**DISPLAY_NAMES, **CLUSTER_DISPLAY}.items()}
    validate_columns(raw, [back.get(f.name, f.name) for f in schema.fields])
    return raw.select(*[F.col(f"`{back.get(f.name, f.name)}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def validate_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise listing the missing columns (metadata only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def require_non_empty(df: DataFrame) -> None:
    """Raise when there are no rows (a limit-1 job)."""
    if df.isEmpty():
        raise ValueError("no rows in input")


def write_records(df: DataFrame, path: str, sentinel_cols: Sequence[str] | None = None) -> None:
    """CSV directory with header; missing values written as the sentinel, white space around values kept."""
    out = df
    if sentinel_cols:
        out = out.withColumns({c: sentinel_or(c) for c in sentinel_cols})
    (to_display(out).write.mode("overwrite").option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("quote", '"').option("escape", '"').csv(path))


def write_clustered(records: DataFrame, descriptions: DataFrame, path: str, sentinel_cols: Sequence[str] | None = None) -> None:
    """A clustered table as two CSV directories below ``path``: ``records``, and ``clusters`` (cluster, cluster_description).

    A description names every method of its cluster, so with each record of the cluster the file would grow with the square
    of the cluster.  It is written once for a cluster, and :func:`read_clustered` puts it back on every record.
    """
    write_records(records.drop("cluster_description"), f"{path}/records", sentinel_cols)
    write_records(descriptions.select("cluster", "cluster_description"), f"{path}/clusters")


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_clustered` wrote: every record, by display names, with its cluster's description as the last column."""
    from lectern.operators.joins import join_small

    records, key = read_records(spark, f"{path}/records"), CLUSTER_DISPLAY["cluster"]
    return join_small(records, read_records(spark, f"{path}/clusters"), key, "left").select(*records.columns, CLUSTER_DISPLAY["cluster_description"])


def write_analysis(profile: DataFrame, path: str, cluster: str = "cluster") -> None:
    """One JSON object per cluster line: ``{"cluster": "Cluster k", ...}``."""
    keyed = profile.withColumn(cluster, F.concat(F.lit("Cluster "), F.col(cluster).cast("string")))
    keyed.write.mode("overwrite").json(path)


def write_report(lines: DataFrame, path: str, partitions: int | None = None) -> None:
    """Ordered text lines: range-partitioned on (k1, k2), sorted within part files.

    Part files are numbered in key order, so concatenating them in name order
    gives the report; no single task holds the whole text.
    """
    ranged = lines.repartitionByRange(partitions, "k1", "k2") if partitions else lines.repartitionByRange("k1", "k2")
    (ranged.sortWithinPartitions("k1", "k2")
     .select("line").write.mode("overwrite").text(path))


__all__ = [
    "DISPLAY_NAMES", "FEATURE_FIELDS", "RECORD_SCHEMA", "REQUIRED_FIELDS", "SENTINEL", "decode_pages",
    "from_display", "read_records", "require_non_empty", "scan_documents", "to_display", "validate_columns",
    "read_clustered", "write_analysis", "write_clustered", "write_records", "write_report",
]
