"""Plain Python versions of what the operators compute, and awkward rows."""

from __future__ import annotations

import re
from collections import Counter

SF = "/root/testdata/sf0.01"
LONG = "word " * 30_000 + "x" * 200_000


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text: str | None) -> set[tuple[str, ...]]:
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def prose(n: int, seed: int, size: int = 400) -> str:
    """n words, drawn evenly from a vocabulary of ``size``."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(f"w{(x >> 33) % size}")
    return " ".join(out)


def awkward() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with nulls, blanks, ties, repeated rows, copies and a long text."""
    base = prose(120, 1).split()
    near = [*base]
    near[60] = "changed"
    rows = [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base).upper()), (4, None), (5, ""), (6, " \n\t\x0b "), (7, "one two"),
        (8, "one two"), (9, LONG), (10, prose(300, 2)), (10, prose(300, 2)), (10, prose(200, 3)), (None, " ".join(base)), (None, None),
        (11, " ".join(["a"] * 300)), (12, " ".join(["a"] * 120)), (13, prose(60, 4) + "\n" + prose(60, 4) + "\n\nx\nx"),
        (14, prose(100, 5) + " " + " ".join(base[10:90])), (15, "#a *b $c %d & | < >" * 10), (16, "é ü 😀 ß" * 20), (17, "a\x1cb\x85c d " * 30),
        (18, prose(90, 6)), (19, prose(90, 7)), (20, prose(90, 8)),
    ]
    return [(i, t, None if k % 7 == 3 else "en", None if k % 5 == 4 else f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = ("n", "cid", "bucket", "part", "row", "block", "weight", "host", "kept", "text_key", "path", "th", "regs", "grams", "epoch", "_m", "_w", "source_", "template")


def frames(spark):
    """(awkward rows, the same with clashing columns, an empty table)."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(awkward(), SCHEMA).repartition(3)
    return docs, docs.withColumns({c: F.lit("clash") for c in CLASHING}), docs.limit(0)


def same_rows(a, b) -> bool:
    return Counter(map(str, a)) == Counter(map(str, b))
