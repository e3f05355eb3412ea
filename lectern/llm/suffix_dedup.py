"""Suffix-array dedup by a depth-limited radix sort.

Every suffix of every text, cut off at ``WINDOW`` bytes, is a row of the sort; suffixes that start fewer than ``WINDOW``
bytes before their text's end have no such string.  Only which rows are equal matters, not the order of unequal ones,
so the sort's digits may be any function of the cut-off suffix.  The most significant digit is its smallest gram of
``GRAM`` bytes.  The next ones are that gram's offset in the suffix, ``BITS`` bits a pass, high bits first, together with
the bytes that this much of the offset leaves in common (the core: it grows around the gram until it is the whole suffix).
Neighbouring suffixes with the same digits so far travel as one row, a run of offsets, so the first pass moves one row for
about 85 bytes.

A pass deals rows by their digits so far.  A row alone in its group is unlike all others and goes.  Rows of a group whose
bytes are equal from the first to the last suffix of their runs are settled: all their suffixes repeat.  Where the bytes of
a group differ, one row for each different stretch of bytes goes on to the next digit, which cuts its run into shorter ones;
after the last digit a run is one suffix, and equal groups are exactly the repeated strings.  From the second pass
on only the stretches of text that undecided runs cover are carried along.

Cores and stretches are compared by 64-bit fingerprints with keys of their own: two strings are taken for equal wrongly
with a chance of about 2**-128 for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import ByteHash, mix
from lectern.session import cut_lineage

WINDOW = 200
GRAM, GRAM_LEVEL = 32, 5
OFFSETS = WINDOW - GRAM + 1
# Offsets are below 2**9; after the first pass, BITS more of their bits are known in each.
BITS, SHIFTS = 3, (6, 3, 0)
# Bytes handled at once; positions in a block fit into POSITION.
BLOCK = 1 << 19
POSITION = np.uint64((1 << 20) - 1)

_U = np.uint64
_ROWS = "ha long, hb long, base int, core long, span int, content long, pos array<int>, done boolean"


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of strings or binaries; nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)), offsets


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first row, end row) of about ``BLOCK`` bytes, a longer row alone."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = min(n, max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1))
        yield row, end
        row = end


def _anchors(order: np.ndarray) -> np.ndarray:
    """For each window the position of its leftmost smallest gram; ``order`` has the fingerprint of every gram."""
    x = (order & ~POSITION) | np.arange(len(order), dtype=_U)
    width = 1
    while 2 * width <= OFFSETS:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = OFFSETS - width
    return (np.minimum(x[: len(x) - rest], x[rest:]) & POSITION).astype(np.int64)


def _contents(by: ByteHash, start: np.ndarray, end: np.ndarray, span: np.ndarray) -> np.ndarray:
    return mix(by.runs(start, end) ^ ((span + 1).astype(_U) * _U(0x9E3779B97F4A7C15)))


def _grouped(row: np.ndarray, core: np.ndarray, span: np.ndarray, content: np.ndarray, pos: np.ndarray, done: np.ndarray):
    """Rows of one text that are alike in all but their position become one row with a list of positions."""
    order = np.lexsort((done, content, span, core, row))
    row, core, span, content, pos, done = (x[order] for x in (row, core, span, content, pos, done))
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (core[1:] != core[:-1]) | (span[1:] != span[:-1]) | (content[1:] != content[:-1]) | (done[1:] != done[:-1])
    head = np.flatnonzero(new)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([head, [len(row)]]).astype(np.int32)), pa.array(pos.astype(np.int32)))
    return row[head], [pa.array(core[head].view(np.int64)), pa.array(span[head].astype(np.int32)),
                       pa.array(content[head].view(np.int64)), lists, pa.array(done[head])]


def _suffixes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, core, span, content, position of the smallest gram) of all runs of the texts data[offsets[d]:offsets[d+1]]."""
    windows = np.maximum(np.diff(offsets) - WINDOW + 1, 0)
    total = int(windows.sum())
    none = np.zeros(0, dtype=np.int64)
    if not total:
        return none, none.astype(_U), none, none.astype(_U), none
    order = ByteHash(data, 41).level(GRAM_LEVEL)
    doc = np.repeat(np.arange(len(windows)), windows)
    i = np.arange(total) - (np.cumsum(windows) - windows)[doc] + offsets[doc]
    at = _anchors(order)[i]
    head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    first, last, pos, doc = i[head], i[np.append(head[1:], total) - 1], at[head], doc[head]
    span = (pos - last) * 512 + pos - first
    return doc, order[pos], span, _contents(ByteHash(data, 42), first, last + WINDOW, span), pos


def _first_digit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ha, hb, text -> rows of the first pass."""
    names = ["ha", "hb", "base", "core", "span", "content", "pos", "done"]

    def rows(batch: pa.RecordBatch, row: np.ndarray, core, span, content, pos) -> pa.RecordBatch:
        row, columns = _grouped(row, core, span, content, pos, np.zeros(len(row), dtype=bool))
        own = batch.select([0, 1]).take(pa.array(row))
        return pa.RecordBatch.from_arrays([*own.columns, pa.array(np.zeros(len(row), dtype=np.int32)), *columns], names=names)

    for batch in batches:
        data, offsets = _bytes_of(batch.column(2))
        for lo, hi in _blocks(offsets):
            a, z = int(offsets[lo]), int(offsets[hi])
            if z - a <= BLOCK:
                row, core, span, content, pos = _suffixes(data[a:z], offsets[lo : hi + 1] - a)
                yield rows(batch, row + lo, core, span, content, pos - (offsets[lo:hi] - a)[row])
                continue
            for s in range(a, z, BLOCK):  # a run belongs to the part where its anchor is
                begin = max(a, s - OFFSETS + 1)
                end = min(z, s + BLOCK + WINDOW - 1)
                row, core, span, content, pos = _suffixes(data[begin:end], np.array([0, end - begin]))
                keep = (pos >= s - begin) & (pos < s - begin + BLOCK)
                yield rows(batch, row[keep] + lo, core[keep], span[keep], content[keep], pos[keep] + begin - a)


def _next_digit(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[pa.RecordBatch]:
    """ha, hb, base, bytes, runs (pos, span, done) -> rows of the pass that knows the offsets from bit ``shift`` up."""
    for batch in batches:
        data, offsets = _bytes_of(batch.column(3))
        lists = batch.column(4)
        first = np.asarray(lists.offsets)
        runs = lists.values
        pos, span, done = (np.asarray(runs.field(k).to_numpy(zero_copy_only=False)) for k in range(3))
        base = batch.column(2).to_numpy()
        for lo, hi in _blocks(offsets):
            a, z = int(offsets[lo]), int(offsets[hi])
            part = slice(int(first[lo]), int(first[hi]))
            row = np.repeat(np.arange(lo, hi), np.diff(first[lo : hi + 1]))
            low, high = span[part].astype(np.int64) >> 9, span[part].astype(np.int64) & 511
            count = (high >> shift) - (low >> shift) + 1
            pick = np.repeat(np.arange(len(row)), count)
            digit = (low >> shift)[pick] + np.arange(len(pick)) - (np.cumsum(count) - count)[pick]
            low, high = np.maximum(low[pick], digit << shift), np.minimum(high[pick], (digit + 1 << shift) - 1)
            row, there = row[pick], pos[part].astype(np.int64)[pick]
            at = there - base[row] + offsets[row] - a
            new = low * 512 + high
            content = _contents(ByteHash(data[a:z], 42), at - high, at + WINDOW - low, new)
            least, most = digit << shift, np.minimum((digit + 1 << shift) - 1, OFFSETS - 1)
            core = _contents(ByteHash(data[a:z], 41), at - least, at + WINDOW - most, digit)
            row, columns = _grouped(row, core, new, content, there, done[part].astype(bool)[pick])
            own = batch.select([0, 1, 2]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*own.columns, *columns], names=["ha", "hb", "base", "core", "span", "content", "pos", "done"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ha, hb, text, runs (pos, span, done) -> ha, hb, base, bytes, runs: the stretches of text that the runs cover."""
    schema = pa.list_(pa.struct([("pos", pa.int32()), ("span", pa.int32()), ("done", pa.bool_())]))
    for batch in batches:
        data, offsets = _bytes_of(batch.column(2))
        lists = batch.column(3)
        first = np.asarray(lists.offsets)
        pos, span = (lists.values.field(k).to_numpy().astype(np.int64) for k in range(2))
        row, base, pieces, items, ends = [], [], [], [], [0]
        for r in range(batch.num_rows):
            mine = first[r] + np.argsort(pos[first[r] : first[r + 1]], kind="stable")
            start, end = pos[mine] - (span[mine] & 511), pos[mine] + WINDOW - (span[mine] >> 9)
            k = 0
            while k < len(mine):
                j, a, z = k + 1, int(start[k]), int(end[k])
                while j < len(mine) and start[j] <= z and max(z, end[j]) - min(a, start[j]) <= BLOCK:
                    a, z, j = min(a, int(start[j])), max(z, int(end[j])), j + 1
                row.append(r)
                base.append(a)
                pieces.append(data[offsets[r] + a : offsets[r] + z].tobytes())
                items.append(mine[k:j])
                ends.append(ends[-1] + j - k)
                k = j
        own = batch.select([0, 1]).take(pa.array(row, pa.int64()))
        runs = lists.values.take(pa.array(np.concatenate(items) if items else np.zeros(0, dtype=np.int64)))
        yield pa.RecordBatch.from_arrays(
            [*own.columns, pa.array(base, pa.int32()), pa.array(pieces, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs.cast(schema.value_type))],
            names=["ha", "hb", "base", "bytes", "runs"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, marks (span, pos) -> doc_id, n_bytes, n_removed, spans, kept."""
    struct = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        data, offsets = _bytes_of(batch.column(1))
        marks = batch.column(2)
        for lo, hi in _blocks(offsets):
            gone, kept, begins, ends, first = [], [], [], [], [0]
            for r in range(lo, hi):
                text = data[offsets[r] : offsets[r + 1]]
                mine = marks[r].values
                starts = stops = np.zeros(0, dtype=np.int64)
                if mine is not None and len(mine):
                    at = mine.field(1)
                    pos = np.asarray(at.flatten()).astype(np.int64)
                    span = np.repeat(np.asarray(mine.field(0)).astype(np.int64), np.diff(np.asarray(at.offsets)))
                    change = np.bincount(pos - (span & 511), minlength=len(text) + 1) - np.bincount(pos + WINDOW - (span >> 9), minlength=len(text) + 1)
                    free = np.cumsum(change)[:-1] == 0
                    edge = np.diff(np.concatenate([[True], free, [True]]).astype(np.int8))
                    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
                    text = text[free]
                kept.append(text.tobytes())
                gone.append(int((stops - starts).sum()))
                begins.append(starts)
                ends.append(stops)
                first.append(first[-1] + len(starts))
            spans = pa.StructArray.from_arrays([pa.array(np.concatenate(x).astype(np.int32)) for x in (begins, ends)], fields=list(struct))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets[lo : hi + 1])), pa.array(gone, pa.int64()),
                pa.ListArray.from_arrays(pa.array(first, pa.int32()), spans), pa.array(kept, pa.binary()),
            ], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def _settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass over written rows: (marks: ha, hb, span, pos of runs that repeat; the runs that go on to the next digit).

    A hot group is never gathered: groups are aggregates with map-side partial sums, joined back to written rows, so
    that a hot group's rows may be dealt to many tasks.
    """
    groups = rows.groupBy("core").agg(
        F.sum(F.size("pos")).alias("n"), F.min("content").alias("c0"), F.max("content").alias("c1"), F.bool_and("done").alias("settled"))
    groups = cut_lineage(groups.where("n > 1 and not settled").select("core", (F.col("c0") == F.col("c1")).alias("whole")), "groups")
    met = cut_lineage(rows.join(groups, "core"), "met")
    whole = met.where("whole and not done").select("ha", "hb", "span", "pos")
    rest = met.where("not whole")
    one = F.struct("ha", "hb", "base", "span", F.get("pos", F.lit(0)).alias("pos"))
    alike = cut_lineage(rest.groupBy("core", "content").agg(
        F.sum(F.size("pos")).alias("n"), F.bool_or("done").alias("done"), F.min(one).alias("one")), "alike")
    twice = rest.where("not done").join(alike.where("n > 1").select("core", "content"), ["core", "content"])
    undecided = cut_lineage(alike.where("n = 1 and not done").select("core").distinct(), "undecided")
    onward = alike.join(undecided, "core").select("one.*", (F.col("done") | (F.col("n") > 1)).alias("done"))
    return whole.unionByName(twice.select("ha", "hb", "span", "pos")), onward


def _by_text(onward: DataFrame, keys: list[str]) -> DataFrame:
    return onward.groupBy(*keys).agg(F.collect_list(F.struct("pos", "span", "done")).alias("runs"))


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, spans (array of start, end in bytes), kept (binary).

    A byte goes where a string of 200 bytes covers it that starts at any other place too, in the same text or another;
    overlapping places count, and strings are judged on the input.  ``spans`` are the maximal runs of bytes that go, ``kept``
    are the others in order; it need not be valid UTF-8.  A null or empty text has no bytes.  Rows that repeat a key, or have
    none, are texts of their own, so both of two equal rows of 200 bytes or more go.  The key keeps its type; other columns
    are ignored; an empty table gives none.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("ha"), F.xxhash64(F.lit(11), "text", "doc_id").alias("hb"))
    long = docs.where(F.octet_length("text") >= WINDOW).select("ha", "hb", "text")
    # the first digit: grams that one suffix run alone has are dropped before anything else is moved
    first = long.mapInArrow(_first_digit, _ROWS)
    repeated = cut_lineage(first.groupBy("core").agg(F.sum(F.size("pos")).alias("n")).where("n > 1").select("core"), "repeated")
    rows = cut_lineage(first.join(repeated, "core"), "rows")
    marks = []
    texts = None
    for shift in (*SHIFTS, None):
        settled, onward = _settle(rows)
        marks.append(cut_lineage(settled, "marks"))
        if shift is None:
            break
        onward = cut_lineage(onward, "onward")
        if onward.isEmpty():
            break
        if texts is None:
            texts = cut_lineage(long.join(_by_text(onward, ["ha", "hb"]), ["ha", "hb"]).select("ha", "hb", "text", "runs").mapInArrow(
                _stretches, "ha long, hb long, base int, bytes binary, runs array<struct<pos:int,span:int,done:boolean>>"), "stretches")
            now = texts
        else:
            now = texts.drop("runs").join(_by_text(onward, ["ha", "hb", "base"]), ["ha", "hb", "base"]).select("ha", "hb", "base", "bytes", "runs")
        rows = cut_lineage(now.mapInArrow(lambda b, s=shift: _next_digit(b, s), _ROWS), "rows")
    found = marks[0]
    for more in marks[1:]:
        found = found.unionByName(more)
    found = found.groupBy("ha", "hb").agg(F.collect_list(F.struct("span", "pos")).alias("marks"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.join(found, ["ha", "hb"], "left").select("doc_id", "text", "marks").mapInArrow(
        _kept, f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary")


def digest(out: DataFrame) -> DataFrame:
    """The number of spans, and the kept bytes as a SHA-256."""
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
