"""The training-data pipeline: quality rules, near-duplicates, benchmark decontamination, source mixing, shards.

Every stage takes (spark, docs, sf_dir) and judges all rows it is given; all but the last return the columns of its
input, extra ones included.  Rows are told apart by document number and text, and by source where that decides, so rows that
repeat a number are judged by their own text.  Document numbers are whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.decontaminate import contaminated
from lectern.llm.mixing import mix_sources
from lectern.llm.native import text_key
from lectern.llm.near_dup import near_duplicates
from lectern.llm.quality_rules import quality_rules
from lectern.llm.sharding import shard_rows
from lectern.session import cut_lineage, read_table

SHARDS = 8
SEED = 20


def _same(docs: DataFrame, by: dict[str, Column]) -> Column:
    """Rows of ``docs`` that are those of another table, whose columns ``by`` maps to; nulls equal nulls."""
    own = {"doc_id": F.col("doc_id").cast("long"), "text_key": text_key("text"), "source": F.col("source").cast("string")}
    out = F.lit(True)
    for name, other in by.items():
        out = out & own[name].eqNullSafe(other)
    return out


def _without(docs: DataFrame, gone: DataFrame, *also: str) -> DataFrame:
    """``docs`` without the rows (doc_id, text_key and the columns ``also``) in ``gone``."""
    names = ("doc_id", "text_key", *also)
    gone = gone.select(*[F.col(c).alias(f"_{c}") for c in names]).distinct()
    return docs.join(gone, _same(docs, {c: F.col(f"_{c}") for c in names}), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Rows are judged by number, text and source: of equal rows from two sources, a bad host's goes and a good host's stays.
    Null and empty texts fail the rules and go.  A null source is no host; an empty table stays empty.
    """
    return _without(docs, quality_rules(docs).where("not kept").withColumnRenamed("host", "source"), "source")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest number.

    Of rows equal in number and text one stays, the first by its other columns as JSON.  Texts without words are
    linked with nothing; rows without a number are linked with nothing and all stay.  An empty table stays empty.
    """
    columns = docs.columns
    kept = _without(docs, near_duplicates(docs).where("not kept"))
    twice = kept.groupBy("doc_id", text_key("text").alias("text_key")).agg(F.count(F.lit(1)).alias("k")).where("k > 1 and doc_id is not null")
    twice = cut_lineage(twice.select("doc_id", "text_key"), "repeated")
    if twice.isEmpty():
        return kept
    again = kept.withColumn("_k", F.struct("doc_id", text_key("text").alias("text_key"))).join(
        twice.select(F.struct("doc_id", "text_key").alias("_k")), "_k")
    rest = F.to_json(F.struct(F.lit(0).alias("_"), *[c for c in columns if c not in ("doc_id", "text")]))
    again = again.groupBy("_k").agg(F.min_by(F.struct(*columns), rest).alias("_row")).select("_row.*")
    return _without(kept, twice).unionByName(again)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null, empty and short texts hold none; rows equal in number and text share their verdict; without a number a row is
    judged by its text.  An empty table stays empty, and an empty benchmark removes nothing.
    """
    return _without(docs, contaminated(docs, read_table(spark, sf_dir, "benchmark")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each row as often as its source's epochs take it.

    Rows equal in number, text and source go into an epoch together or not at all; a null source is a source of its own.  Null
    and empty texts cost nothing and go with their source; an empty table stays empty.
    """
    chosen = mix_sources(docs, seed=SEED).select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "text_key", "source")])
    joined = docs.join(chosen, _same(docs, {c: F.col(f"_{c}") for c in ("doc_id", "text_key", "source")}))
    return joined.select(*[docs[c] for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix; null and repeated rows are rows like others, an empty table has none."""
    return shard_rows(docs, SHARDS, seed=SEED).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("source mixing", mix),
    ("sharding", shard),
]

# Bisection, sketches and permutation have no SQL: tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's result is written as Parquet and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs, f"stage-{i}")
    return docs
