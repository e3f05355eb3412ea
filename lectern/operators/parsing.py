"""Semi-structured model answers: envelope, strict parse, aliasing, merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.core import _c, is_present
from lectern.functions.text import clean_json_envelope
from lectern.operators.text import ORDER_RUN, ordered_join, position_run, sql_name, sql_text

_OBJ_ARRAY = "array<map<string,string>>"
_JSON_OPTS = {"allowSingleQuotes": "false", "allowUnquotedFieldNames": "false",
              "allowNonNumericNumbers": "false", "allowComments": "false"}


def parse_object(col: Column | str) -> Column:
    """Strict parse of one JSON object into MAP<STRING,STRING>; NULL if malformed.

    ``from_json`` alone accepts trailing text after the object, so the text is
    wrapped in ``[...]``: the parse is valid only when the array parses and
    holds exactly one object.  Nested values keep their JSON text.
    """
    arr = F.from_json(F.concat(F.lit("["), _c(col), F.lit("]")), _OBJ_ARRAY, _JSON_OPTS)
    return F.when(F.size(arr) == 1, F.element_at(arr, 1))


def parse_response(df: DataFrame, response: str = "response", out: str = "obj") -> DataFrame:
    """Envelope cleaning followed by the strict parse."""
    return df.withColumn(out, parse_object(clean_json_envelope(response)))


def project_fields(obj: Column | str, keys: Mapping[str, str]) -> list[Column]:
    """``{column: json key}`` -> columns holding each key's value (NULL if absent)."""
    return [F.try_element_at(_c(obj), F.lit(k)).alias(c) for c, k in keys.items()]


def render_value(v: Column | str) -> Column:
    """A JSON list value becomes ``a, b``; other values stay as they are."""
    c = _c(v)
    as_list = F.from_json(c, "array<string>", _JSON_OPTS)
    return F.when(F.ltrim(c).startswith("[") & as_list.isNotNull(), F.array_join(as_list, ", ")).otherwise(c)


def explode_fields(
    df: DataFrame, keys: Sequence[str], obj: str = "obj", field: str = "field", value: str = "value"
) -> DataFrame:
    """One row per (object, key present in the object)."""
    rest = [c for c in df.columns if c != obj]
    return (
        df.select(*rest, F.explode(_c(obj)).alias(field, value))
        .where(F.col(field).isin(list(keys)))
    )


def normalize_keys(df: DataFrame, aliases: Mapping[str, str], field: str = "field") -> DataFrame:
    """Map answer field names onto record column names (unknown names kept).

    The alias table is a literal map in the plan: no join, no shuffle.
    """
    lookup = F.create_map(*[x for kv in aliases.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return df.withColumn(field, F.coalesce(F.try_element_at(lookup, F.col(field)), F.col(field)))


def merge_fields(
    df: DataFrame,
    key: str,
    order: str,
    fields: Sequence[str],
    field: str = "field",
    value: str = "value",
    sep: str = "; ",
    run: int = ORDER_RUN,
) -> DataFrame:
    """Merge each field's present values over a document's chunks, in chunk order.

    Semantics of the sequential fold ``acc = strip('; '.join(nonempty(acc, v)), '; ')``:
    every value loses trailing ``;``/space, empty pieces vanish, the joined text
    loses leading ``;``/space.  One row per document, one column per field
    (an explicit pivot list, so no extra job to find the values).
    Two levels keyed by document: pieces are joined per run of ``run``
    consecutive chunk positions (partial aggregation map-side), then the runs
    in order, so no group ever gathers a huge document chunk by chunk.
    """
    strip_set = "".join(sorted(set(sep)))
    present = _pieces(df, key, order, field, value, strip_set).withColumn("_run", position_run(order, run))
    runs = present.groupBy(key, "_run").agg(*[
        ordered_join(sql_name(order), "_piece", sep, when=f"{sql_name(field)} = {sql_text(f)}").alias(f)
        for f in fields
    ])
    return runs.groupBy(key).agg(*[
        F.ltrim(ordered_join("_run", sql_name(f), sep, when=f"{sql_name(f)} IS NOT NULL"), F.lit(strip_set)).alias(f)
        for f in fields
    ])


def _pieces(df: DataFrame, key: str, order: str, field: str, value: str, strip_set: str) -> DataFrame:
    return df.where(is_present(value)).select(
        key, order, field, F.rtrim(render_value(value), F.lit(strip_set)).alias("_piece")
    ).where(F.col("_piece") != "")


def merge_fields_grouped(
    df: DataFrame, key: str, order: str, field: str = "field", value: str = "value", sep: str = "; ",
    run: int = ORDER_RUN,
) -> DataFrame:
    """Long form of :func:`merge_fields`: one row per (document, field)."""
    strip_set = "".join(sorted(set(sep)))
    present = _pieces(df, key, order, field, value, strip_set).withColumn("_run", position_run(order, run))
    runs = present.groupBy(key, field, "_run").agg(ordered_join(sql_name(order), "_piece", sep).alias("_part"))
    merged = ordered_join("_run", "_part", sep)
    return runs.groupBy(key, field).agg(F.ltrim(merged, F.lit(strip_set)).alias("merged"))


def capture_status(
    df: DataFrame, error_cols: Sequence[str], status: str = "extraction_status", message: str = "error_message"
) -> DataFrame:
    """``success`` unless one of ``error_cols`` holds an error text (first one wins)."""
    first_err = F.coalesce(*[F.col(c) for c in error_cols]) if error_cols else F.lit(None).cast("string")
    return df.withColumns({
        status: F.when(first_err.isNull(), F.lit("success")).otherwise(F.lit("error")),
        message: first_err,
    })
