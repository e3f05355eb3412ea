"""Document text operators: assemble, drop empty, chunk, prompt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.core import WHITESPACE, strip_chars
from lectern.functions.text import CHUNK_CHARS, HEAD_CHARS, fill_template, head_slice


# Consecutive positions joined into one partial text in the first level of an
# ordered concatenation.
ORDER_RUN = 1024


def sql_name(name: str) -> str:
    """A column name quoted for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ordered_join(order: str, value: str, sep: str, when: str | None = None) -> Column:
    """Aggregate: ``value`` texts joined by ``sep`` in ``order`` order; NULL if none.

    ``order``, ``value`` and ``when`` (keep only rows where it holds) are
    SQL expressions; the aggregate is written as one SQL expression, so the
    driver builds it in one call.
    """
    item = f"struct({order} AS o, {value} AS t)"
    if when:
        item = f"CASE WHEN {when} THEN {item} END"
    items = f"array_sort(collect_list({item}))"
    return F.expr(f"CASE WHEN size({items}) > 0 THEN array_join(transform({items}, s -> s.t), {sql_text(sep)}) END")


def position_run(order: str, run: int = ORDER_RUN) -> Column:
    """The run of ``run`` consecutive integer positions that ``order`` falls in."""
    return F.floor(F.col(order) / F.lit(run))


def assemble_pages(
    df: DataFrame, key: str, order: str, text: str, out: str = "text", run: int = ORDER_RUN
) -> DataFrame:
    """Concatenate a document's page texts in page order and strip white space.

    One row per document; NULL pages count as empty.  Two levels, so a
    document with a huge number of pages is never gathered page by page in
    one group: pages are first joined per run of ``run`` consecutive page
    numbers (partially aggregated map-side, so the pages of one document are
    spread over many tasks), then the runs of each document are joined in
    order, at most pages / ``run`` pieces per document.
    """
    pages = df.select(key, F.col(order).alias("_o"), F.coalesce(F.col(text), F.lit("")).alias("_t"),
                      position_run(order, run).alias("_run"))
    runs = pages.groupBy(key, "_run").agg(ordered_join("_o", "_t", "").alias("_part"))
    joined = runs.groupBy(key).agg(ordered_join("_run", "_part", "").alias("_all"))
    return joined.select(key, strip_chars(F.col("_all"), WHITESPACE).alias(out))


def drop_empty(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents without text give no row (pushed down to the scan)."""
    return df.where(F.col(text).isNotNull() & (F.col(text) != F.lit("")))


def chunk_text(
    df: DataFrame,
    text: str = "text",
    size: int = CHUNK_CHARS,
    idx: str = "chunk_idx",
    out: str = "chunk",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Consecutive, non-overlapping ``size``-character slices with their index.

    Empty text is dropped first (``sequence(0, -1)`` is not empty in Spark).
    Slicing is a generator inside one stage: no shuffle, and a long document
    only multiplies rows by its own chunk count.
    """
    return drop_empty(df, text).select(*keep, F.posexplode(chunk_slices(text, size)).alias(idx, out))


def chunk_slices(text: Column | str, size: int = CHUNK_CHARS) -> Column:
    """The array of consecutive ``size``-character slices of non-empty ``text``."""
    t = F.col(text) if isinstance(text, str) else text
    n_chunks = F.ceil(F.length(t) / F.lit(size)).cast("int")
    return F.transform(F.sequence(F.lit(0), n_chunks - 1), lambda i: F.substring(t, i * size + 1, size))


def head(df: DataFrame, text: str = "text", n: int = HEAD_CHARS, out: str = "head") -> DataFrame:
    return df.withColumn(out, head_slice(text, n))


def build_prompt(
    df: DataFrame, template: str, cols: Sequence[Column | str], out: str = "prompt"
) -> DataFrame:
    """Fill ``template`` (``{}`` placeholders) with ``cols``."""
    return df.withColumn(out, fill_template(template, *cols))


def record_json(cols: Sequence[str]) -> Column:
    """The record as one JSON object (for prompts that take whole records)."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))
