"""Column -> Column text helpers (all JVM-side built-in expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.core import SENTINEL, WHITESPACE, _c, is_present, strip_chars

# Slice sizes (characters) used for prompts and chunks.
HEAD_CHARS = 5000
CHUNK_CHARS = 15000

# Fixed value: citation layout (authors, quoted title, venue, year).
CITATION_VENUE = "in Proc. Meta-Learning Conf."
MAX_CITED_AUTHORS = 3


def head_slice(col: Column | str, n: int = HEAD_CHARS) -> Column:
    """First ``n`` characters (code points, like a Python slice)."""
    return F.substring(_c(col), 1, n)


def clean_json_envelope(col: Column | str) -> Column:
    """Drop everything before the first ``{`` and after the last ``}`` that follows it.

    Two searches for one character, linear in the length of the text.
    """
    c = _c(col)
    tail = F.substring(c, F.locate("{", c), F.length(c))
    rest = F.when(F.locate("{", c) > 0, tail).otherwise(F.when(c.isNotNull(), F.lit("")))
    back = F.locate("}", F.reverse(rest))
    return F.when(back > 0, F.substring(rest, F.lit(1), F.length(rest) - back + 1)).otherwise(F.when(rest.isNotNull(), F.lit("")))


def feature_text(cols: Sequence[Column | str], sep: str = " ") -> Column:
    """Join the present values of ``cols`` with ``sep``, skipping missing ones."""
    arr = F.array(*[_c(c).cast("string") for c in cols])
    return F.array_join(F.filter(arr, lambda x: is_present(x)), sep)


def author_list(authors: Column | str) -> Column:
    """Comma-separated author string -> array of stripped names."""
    parts = F.split(_c(authors), ",", -1)
    return F.transform(parts, lambda a: strip_chars(a, WHITESPACE))


def format_citation(
    title: Column | str,
    authors: Column | str,
    year: Column | str,
    venue: str = CITATION_VENUE,
    max_authors: int = MAX_CITED_AUTHORS,
) -> Column:
    """``A, B, C et al., "Title", <venue>, <year>.``; sentinel if any part is missing."""
    names = author_list(authors)
    shown = F.array_join(F.slice(names, 1, max_authors), ", ")
    etal = F.when(F.size(names) > max_authors, F.lit(" et al.")).otherwise(F.lit(""))
    text = F.concat(
        shown, etal, F.lit(', "'), strip_chars(title, WHITESPACE), F.lit(f'", {venue}, '),
        _c(year).cast("string"), F.lit("."),
    )
    ok = is_present(title) & is_present(authors) & is_present(_c(year).cast("string"))
    return F.when(ok, text).otherwise(F.lit(SENTINEL))


# Fixed value: a sentence ends at ., ! or ? followed by white space.
SENTENCE_BREAK = r"(?<=[.!?])\s+"


def lead_sentences(col: Column | str, n: int = 3) -> Column:
    """First ``n`` sentences of the text, joined by one space."""
    return F.array_join(F.slice(F.split(_c(col), SENTENCE_BREAK, n + 1), 1, n), " ")


def cluster_key(cluster: Column | str) -> Column:
    """``cluster_<id>`` section key."""
    return F.concat(F.lit("cluster_"), _c(cluster).cast("string"))


def cluster_title(cluster: Column | str) -> Column:
    """``Cluster <id>`` display title."""
    return F.concat(F.lit("Cluster "), _c(cluster).cast("string"))


def fill_template(template: str, *cols: Column | str) -> Column:
    """``template`` with ``{}`` placeholders filled, in order, by ``cols``.

    Literal parts and values are concatenated; no ``%`` escaping issues.
    """
    parts = template.split("{}")
    if len(parts) != len(cols) + 1:
        raise ValueError("template needs one {} per column")
    pieces: list[Column] = []
    for i, lit_part in enumerate(parts):
        if lit_part:
            pieces.append(F.lit(lit_part))
        if i < len(cols):
            pieces.append(F.coalesce(_c(cols[i]).cast("string"), F.lit("")))
    return F.concat(*pieces)
