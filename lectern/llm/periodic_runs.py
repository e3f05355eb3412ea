"""Periodic run detection by maximal pairs.

A run is a stretch of words that repeats with a period of q words, at least ``REPEATS`` times and ``LEAST`` words long, and that
no neighbouring word extends.  Two equal stretches of l words whose words before and after differ are a maximal pair.  The
stretches of a maximal pair at distance d <= l / (REPEATS - 1) overlap, and together they are a stretch of l + d words
with period d that cannot be extended: the maximal pairs whose distances satisfy the length constraints are exactly the runs,
once for each multiple of the smallest period that is still short enough, and the least distance is the smallest period.

Maximal pairs come from the tree of LCP intervals of the document's suffix array, visited bottom up.  Positions of one
child meet those of the others at their common prefix's length l, so the words behind them differ; only pairs of
different classes, by the word before them, are taken.  Positions of one prefix within l / 2 words of each other lie in one
arithmetic progression, and all of them but its first have the same word before them.  So the class lists of an interval
are kept as one list in order of position: of those within reach of a position, at most one is of another class than
the rest, and work is bounded by the pairs that are found.  Smaller lists are merged into larger ones.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import RunHash, Words, text_blocks

LEAST = 24
REPEATS = 3
# The shorter stretch of a pair has at least max(24 - d, 2 d) >= 16 words: texts without a repeated window of 16 have no run.
SHORTEST, SHORTEST_LEVEL = 16, 4


def _repeating(w: Words) -> np.ndarray:
    """The documents in which some window of ``SHORTEST`` words occurs twice."""
    size = np.diff(w.first)
    count = np.maximum(size - SHORTEST + 1, 0)
    doc = np.repeat(np.arange(len(size)), count)
    i = np.arange(len(doc)) - (np.cumsum(count) - count)[doc] + w.first[doc]
    h = RunHash(w.hash, 51).level(SHORTEST_LEVEL)[i]
    order = np.lexsort((h, doc))
    same = (h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    return np.unique(doc[order[1:]][same])


def suffix_array(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, length of the prefix each has in common with the one before) of a sequence of numbers.

    By prefix doubling; the ranks of every round give the common lengths.  The last number must occur nowhere else.
    """
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    ranks, step = [rank], 1
    order = np.argsort(rank, kind="stable")
    while rank.max() < n - 1:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        ranks.append(rank)
        step *= 2
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, dtype=np.int64)
    for level in range(len(ranks) - 2, -1, -1):
        x, y = a + common, b + common
        inside = (x < n) & (y < n)
        same = inside.copy()
        same[inside] = ranks[level][x[inside]] == ranks[level][y[inside]]
        common[same] += 1 << level
    return order, np.concatenate([[0], common])


def _meet(node: list[int], child: list[int], common: int, left: list[int], found: dict[tuple[int, int], int]) -> list[int]:
    """Pairs between two children of an interval, into ``found``: (start, length) -> least distance; their merged list."""
    big, small = (node, child) if len(node) >= len(child) else (child, node)
    reach = common // (REPEATS - 1)
    for x in small:
        a, z = bisect_left(big, x - reach), bisect_right(big, x + reach)
        if a == z:
            continue
        own = left[x]
        others = big[a:z] if z - a > 1 and left[big[z - 1]] != own else big[a : a + 1]
        for y in others:
            distance = abs(x - y)
            if left[y] != own and common + distance >= LEAST:
                at = (min(x, y), common + distance)
                found[at] = min(distance, found.get(at, distance))
    if len(small) > 8 and 8 * len(small) > len(big):
        big += small
        big.sort()
    else:
        for x in small:
            if x > big[-1]:
                big.append(x)
            else:
                insort(big, x)
    return big


def maximal_repetitions(seq: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence whose last number occurs nowhere else."""
    order, common = suffix_array(seq)
    left = np.concatenate([[-1], seq[:-1]]).tolist()
    found: dict[tuple[int, int], int] = {}
    near = common >= SHORTEST
    # only suffixes that share a long enough prefix with a neighbour are in any interval
    part = np.flatnonzero(near | np.append(near[1:], False))
    if not len(part):
        return []
    suffixes, shared = order[part].tolist(), np.append(np.where(near, common, 0)[part][1:], 0).tolist()
    stack: list[tuple[int, list[int]]] = []  # open intervals: length of their common prefix, their positions so far
    for suffix, ahead in zip(suffixes, shared, strict=True):
        child = [suffix]
        while stack and stack[-1][0] > ahead:
            at, node = stack.pop()
            child = _meet(node, child, at, left, found)
        if ahead:
            if stack and stack[-1][0] == ahead:
                stack[-1] = (ahead, _meet(stack[-1][1], child, ahead, left, found))
            else:
                stack.append((ahead, child))
    return sorted((start, length, period) for (start, length), period in found.items())


def runs_of(w: Words) -> list[list[tuple[int, int, int]]]:
    """The runs of each document of a block, by start, then period; starts count from the document's first word."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(w.first) - 1)]
    docs = _repeating(w)
    if not len(docs):
        return out
    # one sequence of all documents, each followed by a number of its own, so no common prefix crosses a document's end
    numbers = np.unique(w.hash, return_inverse=True)[1] + len(docs)
    parts, starts, at = [], [], 0
    for k, d in enumerate(docs):
        parts += [numbers[w.first[d] : w.first[d + 1]], np.array([k])]
        starts.append(at)
        at += int(w.first[d + 1] - w.first[d]) + 1
    for start, length, period in maximal_repetitions(np.concatenate(parts)):
        k = bisect_right(starts, start) - 1
        out[docs[k]].append((start - starts[k], length, period))
    for d in docs:
        out[d].sort(key=lambda r: (r[0], r[2]))
    return out


def joined_words(w: Words, keep: np.ndarray) -> pa.Array:
    """Each document's kept words joined by one space."""
    owner = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))[keep]
    start, size = w.start[keep], (w.end - w.start)[keep] + 1
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    source = np.arange(total) + np.repeat(start - (ends - size), size)
    data = w.data[np.minimum(source, max(len(w.data) - 1, 0))] if total else np.zeros(0, dtype=np.uint8)
    data[ends - 1] = 0x20
    last = np.ones(len(owner), dtype=bool)
    last[:-1] = owner[1:] != owner[:-1]
    solid = np.ones(total, dtype=bool)
    solid[ends[last] - 1] = False  # no space behind a document's last word
    width = np.bincount(owner, weights=size - last, minlength=len(w.first) - 1).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(width)])
    kept = np.ascontiguousarray(data[solid])
    return pa.Array.from_buffers(pa.large_string(), len(width), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(kept)]).cast(pa.string())


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, n_words, runs, collapsed_text."""
    struct = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    for batch in batches:
        for lo, hi, w in text_blocks(batch.column(1)):
            runs = runs_of(w)
            keep = np.ones(len(w.hash), dtype=bool)
            for d, own in enumerate(runs):
                for start, length, period in own:
                    keep[w.first[d] + start + period : w.first[d] + start + length] = False
            flat = np.array([r for own in runs for r in own], dtype=np.int64).reshape(-1, 3)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, runs)]).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(struct)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo), pa.array(np.diff(w.first).astype(np.int64)), lists, joined_words(w, keep),
            ], names=["doc_id", "n_words", "runs", "collapsed_text"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (array of start, length, period in words), collapsed_text.

    ``runs`` are the stretches of at least 24 words and three smallest periods that no neighbouring word extends, by start,
    then period.  ``collapsed_text`` has the words that no run holds behind its first period, joined by one space.  A null,
    empty or blank text has no words, no runs and an empty collapsed text.  Words are told apart by 64-bit fingerprints.  Null and
    repeated keys are rows like others, the key keeps its type, other columns are ignored, an empty table gives none.
    """
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _find, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string")


def digest(out: DataFrame) -> DataFrame:
    """The number of runs, the one of the greatest length / period (ties: smallest start, then period), and SHA-256 digests."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    best = F.aggregate("runs", none, lambda a, b: F.when(a.isNull() | more(a, b), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    out = out.withColumn("_best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.encode(listed, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed_text", "UTF-8"), 256).alias("collapsed_sha256"), "n_words")
