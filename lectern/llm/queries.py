"""The registered queries of the operators, with their parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import sql
from lectern.llm.decontaminate import contaminated
from lectern.llm.mixing import mix_sources
from lectern.llm.native import words
from lectern.llm.near_dup import near_duplicates
from lectern.llm.periodic_runs import digest as runs_digest
from lectern.llm.periodic_runs import periodic_runs
from lectern.llm.pseudonyms import pseudonymise
from lectern.llm.quality_rules import quality_rules
from lectern.llm.secrets import secret_spans
from lectern.llm.sharding import shard_rows
from lectern.llm.spelling import spelling_variants
from lectern.llm.substring_dedup import digest, remove_repeats
from lectern.llm.suffix_dedup import digest as bytes_digest
from lectern.llm.suffix_dedup import remove_repeated_bytes
from lectern.llm.token_counts import token_counts
from lectern.llm.url_filter import filter_urls, host_path
from lectern.session import read_table

SHARDS = 8
SEED = 20
TOKEN_LIMIT = 1024
# A demonstration key: production passes its own.
SECRET = "demonstration-key"
# Verdict, host, path.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file, read by the driver; tasks get its text."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_temperature_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(read_table(spark, sf, "documents"), seed=SEED)


def op2_feistel_shards(spark: SparkSession, sf: str) -> DataFrame:
    out = shard_rows(read_table(spark, sf, "documents"), SHARDS, seed=SEED)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), F.col("row").alias("row_number"))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = token_counts(read_table(spark, sf, "documents"), tokenizer_json())
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")).drop("text_key")


def op5_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_spans(read_table(spark, sf, "documents"))


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return digest(remove_repeats(read_table(spark, sf, "documents")))


def op7_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    return pseudonymise(read_table(spark, sf, "documents"), SECRET)


def op8_url_templates(spark: SparkSession, sf: str) -> DataFrame:
    """A page is labelled by its document, whose number is the first number in the path: bad if of low quality."""
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    number = F.regexp_extract(host_path(F.col("url"))[1], "/([0-9]{1,18})(?![0-9])", 1)
    own = pages.select("page_id", F.when(number != "", number).cast("long").alias("doc_id"))
    labels = read_table(spark, sf, "labels").select("doc_id", (F.col("quality") == 0).alias("bad"))
    return filter_urls(pages, own.join(labels, "doc_id").select("page_id", "bad"), URL_RULES)


def op9_near_dup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf, "documents")).drop("text_key")


def op10_host_quality(spark: SparkSession, sf: str) -> DataFrame:
    out = quality_rules(read_table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed", "host")


def op11_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return bytes_digest(remove_repeated_bytes(read_table(spark, sf, "documents")))


def repeated_words(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of every tenth document, by its number's checksum, the words from one on repeat with a period, three
    times or more; the others, those without words and those without a number stay as they are."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words("text")))
    rows = rows.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.pmod(F.col("g"), F.col("n")).cast("int")))
    rows = rows.withColumn("p", (F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1).cast("int"))
    moved = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return runs_digest(periodic_runs(repeated_words(read_table(spark, sf, "documents"))))


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_temperature_mix": op1_temperature_mix,
    "op2_feistel_shards": op2_feistel_shards,
    "op3_token_counts": op3_token_counts,
    "op4_decontaminate": op4_decontaminate,
    "op5_secret_scan": op5_secret_scan,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_url_templates": op8_url_templates,
    "op9_near_dup": op9_near_dup,
    "op10_host_quality": op10_host_quality,
    "op11_suffix_array_dedup": op11_suffix_array_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {
    "op2_feistel_shards": sql.shards(SHARDS, SEED),
    "op4_decontaminate": sql.leaks(),
    "op6_substring_dedup": sql.substring(),
    "op8_url_templates": sql.urls(URL_RULES),
    "op9_near_dup": sql.near_dup(),
    "op10_host_quality": sql.quality(),
    "op11_suffix_array_dedup": sql.repeated_bytes(),
}
