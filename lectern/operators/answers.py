"""Model answers that outlive the run that paid for them.

An answer is kept under the hash of the model's name and the prompt, in a Parquet table partitioned by a bucket of the
hash.  A request first looks its prompts up; only distinct prompts without an answer are sent to the model, in waves of
bounded size, and every wave is added to the store before the next one starts.  A run that dies loses at most the wave it
was in: the next run finds the others' answers and makes only the missing calls.  Failed calls are reported, not kept,
so they are tried again next time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.inference import CALL_PAUSE, TABLE_BACKOFF, TABLE_BACKOFF_CAP, TABLE_RETRIES, infer
from lectern.session import cut_lineage, scratch_path

STORE_BUCKETS = 64
# Calls of one wave: what a run can lose.
WAVE_CALLS = 10_000
_SCHEMA = "prompt_key string, response string, attempts int, bucket int"


class AnswerStore:
    """Answers of one model under ``path``, a folder that all executors share.

    ``model`` names the model and whatever else decides its answers (version, temperature, system prompt); answers of other
    names in the same folder are never used.  Several runs may add at the same time: an answer that was bought twice
    is kept twice and read once.
    """

    def __init__(self, spark: SparkSession, path: str, model: str, buckets: int = STORE_BUCKETS) -> None:
        self.spark, self.path, self.model, self.buckets = spark, path, model, buckets
        try:
            spark.read.schema(_SCHEMA).parquet(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            self.add(spark.createDataFrame([], "prompt_key string, response string, attempts int"))

    def key(self, prompt: Column | str) -> Column:
        """Names a prompt to this model."""
        prompt = F.col(prompt) if isinstance(prompt, str) else prompt
        return F.sha2(F.concat(F.lit(f"{len(self.model)}:{self.model}:"), prompt), 256)

    def bucket(self, key: Column | str) -> Column:
        return F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), F.lit(self.buckets)).cast("int")

    def add(self, answers: DataFrame) -> None:
        """Append (prompt_key, response, attempts) in one commit."""
        rows = answers.select("prompt_key", "response", "attempts").withColumn("bucket", self.bucket("prompt_key"))
        rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(self.path)

    def read(self) -> DataFrame:
        """(prompt_key, response, attempts, bucket), one row per prompt."""
        rows = self.spark.read.schema(_SCHEMA).parquet(self.path)
        one = rows.groupBy("bucket", "prompt_key").agg(F.min(F.struct("attempts", "response")).alias("a"))
        return one.select("prompt_key", "a.response", "a.attempts", "bucket")


def infer_stored(
    df: DataFrame,
    prompt_col: str,
    fn: Callable[[str], str],
    id_cols: Sequence[str],
    store: AnswerStore,
    retries: int = TABLE_RETRIES,
    multiplier: float = TABLE_BACKOFF,
    cap: float | None = TABLE_BACKOFF_CAP,
    pause: float = CALL_PAUSE,
    partitions: int | None = None,
    wave_calls: int = WAVE_CALLS,
) -> DataFrame:
    """As :func:`lectern.operators.inference.infer`, by way of ``store``: (id_cols..., response, error, attempts).

    Equal prompts are one call, whose attempts each of their rows shows.  A null prompt is the error ``no prompt``.  The calls are
    made here, ``wave_calls`` at a time and ``partitions`` of them at once; the returned table reads stored answers.
    """
    if wave_calls < 1:
        raise ValueError("wave_calls must be at least 1")
    spark = df.sparkSession
    asked = df.select(*id_cols, F.col(prompt_col).alias("_prompt"))
    keyed = asked.withColumn("prompt_key", store.key("_prompt"))
    prompts = keyed.where(F.col("_prompt").isNotNull()).groupBy("prompt_key").agg(F.first("_prompt").alias("prompt"))
    missing = prompts.withColumn("bucket", store.bucket("prompt_key")).join(store.read().select("bucket", "prompt_key"), ["bucket", "prompt_key"], "left_anti")
    missing = cut_lineage(missing.select("prompt_key", "prompt"), "missing")
    waves = -(-missing.count() // wave_calls)
    if waves > 1:  # a folder each, so that a wave reads its own prompts only
        path = scratch_path(spark, "waves")
        wave = F.pmod(F.xxhash64("prompt_key"), F.lit(waves)).cast("int")
        missing.withColumn("wave", wave).hint("rebalance", "wave").write.partitionBy("wave").parquet(path)
        missing = spark.read.parquet(path)
    errors = spark.createDataFrame([], "prompt_key string, error string, tried int")
    for w in range(waves):
        part = missing.where(F.col("wave") == w) if waves > 1 else missing
        out = cut_lineage(infer(part, "prompt", fn, ["prompt_key"], retries=retries, multiplier=multiplier, cap=cap, pause=pause, partitions=partitions), "wave")
        store.add(out.where(F.col("error").isNull()))
        errors = errors.unionByName(out.where(F.col("error").isNotNull()).select("prompt_key", "error", F.col("attempts").alias("tried")))
    found = keyed.drop("_prompt").join(store.read().drop("bucket"), "prompt_key", "left").join(errors, "prompt_key", "left")
    none = F.col("prompt_key").isNull()
    return found.select(
        *id_cols, "response", F.when(none, F.lit("no prompt")).otherwise(F.col("error")).alias("error"),
        F.when(none, F.lit(0)).otherwise(F.coalesce("attempts", "tried")).cast("int").alias("attempts"))
