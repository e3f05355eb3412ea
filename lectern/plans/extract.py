"""Documents -> one record per document (basic fields, merged chunk fields,
summary, citation, status), as a composition of DataFrame operators.

Only small per-document rows are shuffled: the text is read once and kept with
the stored head answers until the chunk requests are made, and every join below is keyed by the document id
between per-document result rows (no skew: one row per id on each side).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.core import SENTINEL
from lectern.functions.text import fill_template, format_citation, head_slice
from lectern.operators.answers import WAVE_CALLS, AnswerStore, infer_stored
from lectern.operators.inference import CALL_PAUSE, TABLE_BACKOFF, TABLE_BACKOFF_CAP, TABLE_RETRIES, infer
from lectern.operators.parsing import (
    merge_fields, normalize_keys, parse_response, project_fields,
)
from lectern.operators.text import chunk_slices, drop_empty, record_json
from lectern.session import cut_lineage, spread
from lectern.sources.records import DETAIL_FIELDS, DISPLAY_NAMES

# Our own wording of the three requests; the JSON keys are the record's
# display names so answers map straight onto columns.
BASIC_PROMPT = (
    "From the start of this paper, return only a JSON object with the keys "
    '"Paper Title", "Authors" (comma-separated) and "Year of Publication". '
    "Use null when a value is not in the text. Text: {}"
)
DETAIL_PROMPT = (
    "From this part of a paper, return only a JSON object with the keys "
    + ", ".join(f'"{DISPLAY_NAMES[c]}"' for c in DETAIL_FIELDS)
    + ". Use strings, lists of strings for lists, and null when absent. Part: {}"
)
SUMMARY_PROMPT = "In three sentences, summarise the contributions and method of this paper record: {}"

BASIC_KEYS = {"title": "Paper Title", "authors": "Authors", "year": "Year of Publication"}

# Answer field names -> record column.  Display names, plus the
# shorter names a model may answer with for five of the fields.
FIELD_ALIASES = {
    **{DISPLAY_NAMES[c]: c for c in DETAIL_FIELDS},
    "Algorithms Considered": "algorithms",
    "Datasets Used": "datasets",
    "Performance": "performance",
    "Key Contributions": "contributions",
    "Meta-Feature Generation": "feature_generation",
}


def extract_records(
    docs: DataFrame,
    fn: Callable[[str], str],
    key: str = "filename",
    text: str = "text",
    retries: int = TABLE_RETRIES,
    multiplier: float = TABLE_BACKOFF,
    cap: float = TABLE_BACKOFF_CAP,
    pause: float = CALL_PAUSE,
    partitions: int | None = None,
    store: AnswerStore | None = None,
    wave_calls: int = WAVE_CALLS,
) -> DataFrame:
    """Records with every field NULL when missing (use ``fill_sentinel`` at sinks).

    With a ``store`` the answers are kept there, ``wave_calls`` at a time: a run that died is taken up where it stopped, and
    nothing is asked twice.

    ``partitions`` (default: the cluster's task slots) is the number of
    concurrent model calls.  The documents are spread over at least that many
    tasks only when the scan gives fewer (a no-op on a large, well-split
    input), so the head and chunk calls run where the text was read; the
    summary calls follow a join, and are explicitly re-partitioned by key.
    """
    n = partitions or docs.sparkSession.sparkContext.defaultParallelism
    kw = dict(retries=retries, multiplier=multiplier, cap=cap, pause=pause)

    def ask(prompts: DataFrame, ids: list[str], at_once: int | None = None) -> DataFrame:
        if store is None:
            return infer(prompts, "prompt", fn, ids, partitions=at_once, **kw)
        return infer_stored(prompts, "prompt", fn, ids, store, partitions=n, wave_calls=wave_calls, **kw)

    docs = spread(drop_empty(docs.select(key, text), text), key, min_partitions=n)

    # Answers are stored once: they are expensive, not deterministic, and read
    # by several branches.  The text travels with the head request, so that the
    # chunk requests need no second scan and no join.  A document whose head
    # request fails gets no further request.
    heads = docs.withColumn("prompt", fill_template(BASIC_PROMPT, head_slice(text)))
    heads = cut_lineage(parse_response(ask(heads, [key, text])).select(key, text, "obj", "error"), "heads")
    basic = heads.select(key, *project_fields("obj", BASIC_KEYS), F.col("error").alias("basic_error"))

    chunks = F.transform(chunk_slices(text), lambda c: fill_template(DETAIL_PROMPT, c))
    prompts = heads.where(F.col("error").isNull()).select(key, F.posexplode(chunks).alias("chunk_idx", "prompt"))
    parsed = cut_lineage(parse_response(ask(prompts, [key, "chunk_idx"]))
                         .where(F.col("obj").isNotNull()).select(key, "chunk_idx", "obj"), "chunks")
    fields = normalize_keys(parsed.select(key, "chunk_idx", F.explode("obj").alias("field", "value")), FIELD_ALIASES)
    merged = merge_fields(fields, key, "chunk_idx", DETAIL_FIELDS)

    record = basic.join(merged, key, "left")
    cols = ["title", "authors", "year", *DETAIL_FIELDS]
    summary_prompts = record.where(F.col("basic_error").isNull()).withColumn("prompt", fill_template(SUMMARY_PROMPT, record_json(cols)))
    summarised = cut_lineage(ask(summary_prompts, [key, *cols], n), "summaries").select(
        key, *cols, F.col("response").alias("summary"), F.col("error").alias("error_message"))
    failed = record.where(F.col("basic_error").isNotNull()).select(
        key, *cols, F.lit(None).cast("string").alias("summary"), F.col("basic_error").alias("error_message"))
    out = summarised.unionByName(failed)
    # the citation comes after the summary: no record that failed has one
    citation = format_citation("title", "authors", "year")
    out = out.withColumn("citation", F.when(F.col("error_message").isNull() & (citation != F.lit(SENTINEL)), citation)).select(
        key, *cols, "summary", "citation", "error_message")
    return out.withColumn(
        "extraction_status", F.when(F.col("error_message").isNull(), "success").otherwise("error")
    )


__all__ = ["extract_records", "FIELD_ALIASES", "BASIC_PROMPT", "DETAIL_PROMPT", "SUMMARY_PROMPT", "fill_template"]
