"""Substring dedup by de Bruijn compaction.

The graph's edges are all windows of ``WINDOW`` words (token k-mers), its nodes the windows one word shorter.  A
window's anchor is the leftmost smallest of the ``ANCHOR``-word fingerprints inside it, so equal windows have equal
anchors.  Consecutive windows with one anchor occurrence are a path.  Where all paths of an anchor are equal, the
path does not branch: one fingerprint stands for all its edges, and one aggregate gives the first document of
every edge.  Only at anchors whose paths differ (passages begin, end or branch there) are the single edges
compared.  Paths and edges meet by two 64-bit fingerprints, of the anchor and of all words.  Both begin from the bytes of
the words with keys of their own, so two spans of different words agree in both with a chance of about 2**-128; the
second one is what verifies a span against its source.  The source coordinates (document and path number) lead back to
the words that go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import RunHash, Words, mix, text_blocks
from lectern.session import cut_lineage

WINDOW = 50
ANCHOR = 12

_U = np.uint64


def _leftmost_smallest(x: np.ndarray, width: int) -> np.ndarray:
    """For each i the position of the leftmost smallest of x[i:i+width]."""
    at, have = np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at = np.where(x[a] <= x[b], a, b)
        have += step
    return at


class Paths:
    """The paths of a block: first window (word index), windows, anchor and content fingerprints, document."""

    def __init__(self, w: Words, window: int, anchor: int) -> None:
        n = len(w.hash)
        none = np.zeros(0, dtype=np.int64)
        self.window, self.start, self.count, self.doc = window, none, none, none
        self.anchor = self.content = np.zeros(0, dtype=_U)
        if n >= window:
            self.words = RunHash(w.hash, 21)
            i = np.arange(n - anchor + 1)
            at = _leftmost_smallest(self.words.runs(i, i + anchor), window - anchor + 1)
            size = np.diff(w.first)
            doc = np.repeat(np.arange(len(size)), np.maximum(size - window + 1, 0))
            if len(doc):
                begin = np.concatenate([[0], np.cumsum(np.maximum(size - window + 1, 0))])
                i = np.arange(len(doc)) - begin[doc] + w.first[doc]
                at = at[i]
                head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                self.start, self.doc = i[head], doc[head]
                self.count = np.diff(np.concatenate([head, [len(doc)]]))
                pos = at[head]
                self.anchor = self.words.runs(pos, pos + anchor)
                self.content = mix(RunHash(w.check, 22).runs(self.start, self.start + self.count + window - 1)
                                   ^ ((pos - self.start).astype(_U) * _U(0x9E3779B97F4A7C15)))
        self.first = np.searchsorted(self.doc, np.arange(len(w.first)))  # the first path of each document


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, th, text -> doc_id, th, path (its number in the document), anchor, content."""
    for batch in batches:
        for lo, hi, w in text_blocks(batch.column(2), check=True):
            p = Paths(w, WINDOW, ANCHOR)
            own = pa.array(p.doc)
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(own), part.column(1).take(own),
                pa.array((np.arange(len(p.doc)) - p.first[p.doc]).astype(np.int32)),
                pa.array(p.anchor.view(np.int64)), pa.array(p.content.view(np.int64)),
            ], names=["doc_id", "th", "path", "anchor", "content"])


def _per_row(column: pa.Array, i: int) -> np.ndarray:
    return np.asarray(column[i].as_py() or [], dtype=np.int64)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, th, text, branching paths -> doc_id, th, window, anchor, content of every edge of these paths."""
    for batch in batches:
        for lo, hi, w in text_blocks(batch.column(2), check=True):
            p = Paths(w, WINDOW, ANCHOR)
            pick = np.concatenate([np.unique(_per_row(batch.column(3), r)) + p.first[r - lo] for r in range(lo, hi)])
            if not len(pick):
                continue
            count = p.count[pick]
            path = np.repeat(pick, count)
            step = np.arange(len(path)) - np.repeat(np.cumsum(count) - count, count)
            start = p.start[path] + step
            own = pa.array(p.doc[path])
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(own), part.column(1).take(own), pa.array((start - w.first[p.doc[path]]).astype(np.int32)),
                pa.array(p.anchor[path].view(np.int64)),
                pa.array(RunHash(w.check, 23).runs(start, start + WINDOW).view(np.int64)),
            ], names=["doc_id", "th", "win", "anchor", "content"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, paths that go, windows that go -> doc_id, n_words, n_removed, kept text."""
    for batch in batches:
        for lo, hi, w in text_blocks(batch.column(1), check=True):
            p = None
            size = np.diff(w.first)
            gone, kept = np.zeros(hi - lo, dtype=np.int64), []
            for r in range(lo, hi):
                d, a, z = r - lo, w.first[r - lo], w.first[r - lo + 1]
                paths, wins = _per_row(batch.column(2), r), _per_row(batch.column(3), r)
                at = range(a, z)
                if len(paths) or len(wins):
                    p = p or Paths(w, WINDOW, ANCHOR)
                    paths = paths + p.first[d]
                    change = np.zeros(size[d] + 1, dtype=np.int64)
                    np.add.at(change, np.concatenate([p.start[paths] - a, wins]), 1)
                    np.add.at(change, np.concatenate([p.start[paths] + p.count[paths] + WINDOW - 1 - a, wins + WINDOW]), -1)
                    free = np.flatnonzero(np.cumsum(change)[:-1] == 0)
                    gone[d] = size[d] - len(free)
                    at = free + a
                kept.append(b" ".join([w.data[s:e].tobytes() for s, e in zip(w.start[at], w.end[at], strict=True)])
                            if len(at) else b"")
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), pa.array(gone),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ], names=["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text (kept words joined by one space).

    A word goes where a window of 50 words covers it whose words also start in a row with a smaller doc_id.  Windows
    are judged on the input.  Null and empty texts have no words and an empty kept text.  Rows with a null doc_id
    neither lose words nor cost others any.  Rows that repeat a doc_id do not cost each other words.  Other columns
    are ignored; an empty table gives none.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    doc = ["doc_id", "th"]
    known = docs.where("doc_id is not null")
    paths = cut_lineage(
        known.mapInArrow(_paths, "doc_id long, th long, path int, anchor long, content long"), "paths")
    repeated = paths.groupBy("anchor").agg(
        F.min("doc_id").alias("source"), F.max("doc_id").alias("last"),
        F.min("content").alias("c0"), F.max("content").alias("c1")).where("source < last")
    # written, so that the join deals both sides anew and a hot anchor's rows can be split between tasks
    repeated = cut_lineage(repeated.select("anchor", "source", (F.col("c0") == F.col("c1")).alias("whole")), "repeated")
    found = paths.select(*doc, "path", "anchor").join(repeated, "anchor").where("not whole or source < doc_id")
    listed = cut_lineage(found.groupBy(*doc).agg(
        F.collect_set(F.when(F.col("whole"), F.col("path"))).alias("paths"),
        F.collect_set(F.when(~F.col("whole"), F.col("path"))).alias("branching")), "found")

    edges = known.join(listed.where(F.size("branching") > 0).select(*doc, "branching"), doc).select(*doc, "text", "branching").mapInArrow(
        _edges, "doc_id long, th long, win int, anchor long, content long")
    edges = cut_lineage(edges, "edges")
    shared = edges.groupBy("anchor", "content").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last")).where("source < last")
    shared = cut_lineage(shared.select("anchor", "content", "source"), "shared")
    wins = edges.join(shared, ["anchor", "content"]).where("source < doc_id").groupBy(*doc).agg(F.collect_set("win").alias("wins"))

    goes = listed.select(*doc, "paths").join(wins, doc, "full").where(
        (F.coalesce(F.size("paths"), F.lit(0)) > 0) | (F.coalesce(F.size("wins"), F.lit(0)) > 0))
    return docs.join(goes, doc, "left").select("doc_id", "text", "paths", "wins").mapInArrow(
        _kept, "doc_id long, n_words long, n_removed long, kept_text string")


def digest(out: DataFrame) -> DataFrame:
    """The kept text as a SHA-256."""
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))

