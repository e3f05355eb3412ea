"""Token counts by a map-side two-tier lookup.

The unit is a pre-token group: the text is cut before every space that stands before a character other than white
space.  A byte-level pre-tokeniser starts a new pre-token at each such space, so the counts of the groups add up to
the count of the text.  Tier one is a compact table of the lengths of frequent groups, chosen from counts that every
task makes of its own rows, and broadcast; tier two is a cache in each worker for what the table lacks.  No
pre-token is ever shuffled: only a bounded list of candidates per task is.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups in the broadcast table; longer groups than LONGEST characters are never kept, so it has at most
# TABLE * (4 * LONGEST + 2) bytes.
TABLE = 32_768
LONGEST = 48
# Groups that a task counts at once, and those that it offers for the table.
COUNTED, OFFERED = 400_000, 4_096
# Groups that a worker caches.
CACHED = 1_000_000


def additive(spec: str) -> bool:
    """Whether the counts of pre-token groups add up: a byte-level pre-tokeniser without normaliser or prefix."""
    s = json.loads(spec)
    pre = s.get("pre_tokenizer") or {}
    model = s.get("model") or {}
    return (s.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and model.get("type") == "BPE" and not model.get("dropout"))


def groups_of(text: str) -> list[str]:
    """The pre-token groups of a text; each but the first begins with its space."""
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:  # part of a run of white space
            out[-1] += " " + p
    return out


class Counts:
    """Token counts of texts in one worker; ``table`` maps groups without their leading space to token counts."""

    def __init__(self, spec: str, table: dict[str, int]) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t["content"] for t in json.loads(spec).get("added_tokens", []) if t["content"]]
        self.additive = additive(spec)
        self.table, self.known = table, dict(table)  # both tiers answer one lookup
        self.bare: dict[str, int] = {}  # groups without a leading space: begins of texts and lines
        self.line_break = self.encoded("\n")

    def encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def keep(self, cache: dict[str, int], key: str, n: int) -> int:
        if len(key) <= LONGEST:
            if len(cache) >= CACHED + len(self.table):
                cache.clear()
                cache.update(self.table if cache is self.known else {})
            cache[key] = n
        return n

    def group(self, g: str) -> int:
        """Of one group, with its leading space if it has one."""
        lines = g.split("\n")
        # a line break between characters other than white space is a pre-token of its own
        if len(lines) > 1 and not any(not x or x[-1].isspace() for x in lines[:-1]) and not any(not x or x[0].isspace() for x in lines[1:]):
            return self.group(lines[0]) + sum(map(self.group, lines[1:])) + (len(lines) - 1) * self.line_break
        cache, key = (self.known, g[1:]) if g[:1] == " " and g[1:] and not g[1].isspace() else (self.bare, g)
        n = cache.get(key)
        return self.keep(cache, key, self.encoded(g)) if n is None else n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.additive or any(x in text for x in self.special):
            return self.encoded(text)
        head, *parts = text.split(" ")
        found = list(map(self.known.get, parts))
        if None in found:
            missing = [p for p, n in zip(parts, found, strict=True) if n is None]
            if any(not p or p[0].isspace() for p in missing):  # runs of white space
                return sum(map(self.group, groups_of(text)))
            return sum(n for n in found if n is not None) + sum([self.group(" " + p) for p in missing]) + (self.group(head) if head else 0)
        return sum(found) + (self.group(head) if head else 0)


# The last counter of this worker process, kept with its cache from task to task.
_worker: dict[tuple[str, str], Counts] = {}


def _offers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> group without its leading space, count: the most frequent groups of this task's rows."""
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0):
            if text.is_valid:
                counts.update(text.as_py().split(" ")[1:])
                if len(counts) > COUNTED:  # keep the more frequent half
                    counts = Counter(dict(counts.most_common(COUNTED // 2)))
    top = [(g, n) for g, n in counts.most_common(2 * OFFERED) if 0 < len(g) <= LONGEST and not g[0].isspace() and "\n" not in g][:OFFERED]
    yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["group", "n"])


def _counted(batches: Iterator[pa.RecordBatch], spec, shared) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, n_bytes, n_tokens."""
    groups, lengths = shared.value
    key = (spec.value, groups)
    counts = _worker.get(key)
    if counts is None:
        _worker.clear()
        _worker[key] = counts = Counts(spec.value, dict(zip(groups.split("\x00"), lengths, strict=True)) if lengths else {})
    for batch in batches:
        texts = batch.column(1)
        n = [counts.count(t.as_py()) for t in texts]
        size = [len(t.as_buffer()) if t.is_valid else 0 for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, spec: str, key: str = "doc_id", text: str = "text", table_size: int = TABLE) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row, as the ``tokenizers`` library counts whole texts.

    ``spec`` is a tokenizer's JSON text.  No begin, end or other special tokens are added, special strings inside a
    text are handled as the library does by default, nothing is truncated or padded.  A null text has no bytes and
    no tokens.  Rows may repeat; a null key stays null; other columns are ignored; an empty table gives none.  A
    tokenizer whose counts do not add up over pre-token groups encodes whole texts.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    groups: list[str] = []
    if additive(spec):
        offers = docs.select("text").mapInArrow(_offers, "group string, n long")
        top = offers.where(~F.contains("group", F.lit("\x00"))).groupBy("group").agg(F.sum("n").alias("n")).orderBy(
            F.desc("n"), "group").limit(table_size)
        groups = [r["group"] for r in top.collect()]
    encoder = Tokenizer.from_str(spec)
    lengths = bytes(len(e) for e in encoder.encode_batch([" " + g for g in groups], add_special_tokens=False))
    shared = spark.sparkContext.broadcast(("\x00".join(groups), lengths))
    whole = spark.sparkContext.broadcast(spec)
    return docs.mapInArrow(lambda batches: _counted(batches, whole, shared), "doc_id long, n_bytes long, n_tokens long")
