"""Benchmark decontamination: size-partitioned MinHash containment search.

Benchmark items of fewer than 8 shingles are looked up: one that a document holds three quarters of shares one of its
rarest shingles with it, one or two of which are the keys of a table.  The others are partitioned by the size of their
shingle set into classes of up to 16, 32, 64, ... shingles.
For a class of up to L shingles every document is seen as overlapping windows of 2 L shingles, one every L, so a
passage that an item could have left behind lies whole in some window and its Jaccard similarity with the item is
bounded below (at three quarters of the item: 0.17; at the whole item: 0.25).  ``HASHES`` MinHash values, each a band
of its own, then find the pairs.  The smallest hash values of windows of 32 L shingles come from those of 16 L, so all
classes cost one pass.  Every candidate pair is verified by the exact share of the item's shingles that the document has.

The benchmark may be of any size: it is searched in blocks whose tables are bounded in bytes, each broadcast to one pass
over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.native import text_key
from lectern.llm.words import mix, shingles, stream, text_blocks
from lectern.session import cut_lineage

K = 5
CONTAINMENT = 0.75
HASHES = 128
SMALLEST = 16
# Items of fewer shingles are looked up by their shingles.
FEW = 8
# Bytes of the table of benchmark items that one pass over the documents searches, in each task's memory.  An item takes
# at most ITEM_BYTES for its keys and their bits and, of its shingles, four bytes for each byte of text.
BLOCK_BYTES = 64_000_000
ITEM_BYTES, TEXT_BYTES = HASHES * 12 + HASHES * 4 + 256, 4

_U = np.uint64


_XOR, _MUL = stream(HASHES, 31), stream(HASHES, 32) | _U(1)


class Keys:
    """(hash number, value) -> items, for all hash functions in one sorted array, with one bit table before it."""

    def __init__(self, number: np.ndarray, value: np.ndarray, members: np.ndarray) -> None:
        key = self._key(number.astype(_U), value)
        order = np.argsort(key, kind="stable")
        self.key, self.members = key[order], members[order].astype(np.int32)
        # a sixteenth of its bits are set at most
        self.shift = _U(64 - min(31, max(12, (16 * len(key)).bit_length())))
        bits = np.zeros(1 << (64 - int(self.shift)), dtype=bool)
        bits[(key >> self.shift).view(np.int64)] = True
        self.table = np.packbits(bits, bitorder="little")

    @staticmethod
    def _key(number: np.ndarray | np.uint64, value: np.ndarray) -> np.ndarray:
        """Both in one number; values of two hash functions are taken for one another with a chance of 2**-64 only."""
        return mix(value + number * _U(0x9E3779B97F4A7C15))

    def seen(self, number: int, value: np.ndarray) -> np.ndarray:
        """Positions of values that some item has for this hash function too."""
        key = self._key(_U(number), value)
        slot = key >> self.shift
        at = np.flatnonzero(self.table[(slot >> _U(3)).view(np.int64)] >> (slot & _U(7)).astype(np.uint8) & 1)
        if not len(at):
            return at
        near = np.minimum(np.searchsorted(self.key, key[at]), len(self.key) - 1)
        return at[self.key[near] == key[at]]

    def items(self, number: int, value: np.uint64) -> np.ndarray:
        key = self._key(_U(number), np.array([value], dtype=_U))[0]
        a, z = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        return self.members[a:z]

    def bytes(self) -> int:
        return self.key.nbytes + self.members.nbytes + self.table.nbytes


class Items:
    """A block of benchmark items, ready to be searched for."""

    def __init__(self, ids: list, texts: list) -> None:
        self.ids, self.grams = [], []
        for lo, hi, w in text_blocks(pa.array(texts, pa.string()), lower=True):
            h, first = shingles(w, K)
            for i in range(hi - lo):
                if w.first[i + 1] - w.first[i] >= K:  # shorter items have no shingle of five words
                    self.ids.append(ids[lo + i])
                    self.grams.append(np.unique(h[first[i] : first[i + 1]]))
        self.classes: dict[int, list[int]] = {}
        few = [i for i, g in enumerate(self.grams) if len(g) < FEW]
        self.few = self._lookup(few) if few else None
        for i, g in enumerate(self.grams):
            if len(g) < FEW:
                continue
            size = SMALLEST
            while size < len(g):
                size *= 2
            self.classes.setdefault(size, []).append(i)
        number = np.arange(HASHES)
        self.keys = {
            size: Keys(np.tile(number, len(members)), np.concatenate([self._least(self.grams[i]) for i in members]), np.repeat(np.asarray(members), HASHES))
            for size, members in self.classes.items()}

    @staticmethod
    def _least(grams: np.ndarray) -> np.ndarray:
        """The smallest value under each hash function."""
        parts = [grams[i : i + 4096, None] for i in range(0, len(grams), 4096)]
        return np.minimum.reduce([((g ^ _XOR) * _MUL).min(axis=0) for g in parts])

    def bytes(self) -> int:
        """What a task holds of it."""
        tables = [*self.keys.values(), *([self.few] if self.few else [])]
        return sum(k.bytes() for k in tables) + sum(g.nbytes for g in self.grams)

    def _lookup(self, few: list[int]) -> Keys:
        """Keys of the items by so many of their rarest shingles that one is left where a quarter is missing."""
        grams, n = np.unique(np.concatenate([self.grams[i] for i in few]), return_counts=True)
        keys, members = [], []
        for i in few:
            g = self.grams[i]
            rare = g[np.argsort(n[np.searchsorted(grams, g)], kind="stable")][: len(g) - math.ceil(CONTAINMENT * len(g)) + 1]
            keys.append(rare)
            members += [i] * len(rare)
        return Keys(np.zeros(len(members), dtype=np.int64), np.concatenate(keys), np.asarray(members))

    def candidates(self, h: np.ndarray, first: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs that agree in a MinHash value of some window, or in a rare shingle of a small item;
        document d has shingles first[d]..."""
        n = np.diff(first)
        has = np.flatnonzero(n)
        found: set[tuple[int, int]] = set()
        if len(has) and self.few:
            at = self.few.seen(0, h)
            for d, value in zip(np.searchsorted(first, at, side="right") - 1, h[at], strict=True):
                found.update((int(d), int(i)) for i in self.few.items(0, value))
        if not len(has) or not self.classes:
            return found
        # cells of SMALLEST shingles, the last of a document shorter
        cells = -(-n // SMALLEST)
        cell_first = np.concatenate([[0], np.cumsum(cells)])
        cell_doc = np.repeat(np.arange(len(n)), cells)
        cell_start = first[cell_doc] + (np.arange(cell_first[-1]) - cell_first[cell_doc]) * SMALLEST
        sizes = sorted(self.classes)
        levels = int(np.log2(sizes[-1] // SMALLEST)) + 1
        layout = [(cell_first, cell_doc)]
        for _ in range(1, levels):
            cells = -(-cells // 2)
            f = np.concatenate([[0], np.cumsum(cells)])
            layout.append((f, np.repeat(np.arange(len(n)), cells)))
        t = np.empty_like(h)
        for j in range(HASHES):
            np.bitwise_xor(h, _XOR[j], out=t)
            np.multiply(t, _MUL[j], out=t)
            least = np.minimum.reduceat(t, cell_start)
            for level in range(levels):
                f, doc = layout[level]
                if level:  # two cells make one of the next level
                    below_f = layout[level - 1][0]
                    left = below_f[doc] + 2 * (np.arange(len(doc)) - f[doc])
                    both = left + 1 < below_f[doc + 1]
                    up = least[left].copy()
                    up[both] = np.minimum(up[both], least[left[both] + 1])
                    least = up
                size = SMALLEST << level
                if size not in self.keys:
                    continue
                # a window is a cell and the next one of its document; it agrees with an item where a cell does
                # and no smaller value stands in the window's other cell
                keys = self.keys[size]
                for c in keys.seen(j, least):
                    d, value = doc[c], least[c]
                    others = [least[x] for x in (c - 1, c + 1) if f[d] <= x < f[d + 1]]
                    if not others or max(others) >= value:
                        found.update((int(d), int(i)) for i in keys.items(j, value))
        return found


def _search(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """doc_id, text_key, text -> doc_id, text_key, item_id, n_item, n_shared of the verified pairs."""
    items: Items = shared.value
    for batch in batches:
        rows, out = [], []
        for lo, hi, w in text_blocks(batch.column(2), lower=True):
            h, first = shingles(w, K)
            short = np.diff(w.first) < K
            if short.any():  # their one shorter sequence is no shingle of five words
                keep = ~np.repeat(short, np.diff(first))
                h, first = h[keep], np.concatenate([[0], np.cumsum(keep)])[first]
            by_doc: dict[int, list[int]] = {}
            for d, i in items.candidates(h, first):
                by_doc.setdefault(d, []).append(i)
            for d, found in sorted(by_doc.items()):
                own = np.unique(h[first[d] : first[d + 1]])
                for i in sorted(found):
                    g = items.grams[i]
                    shared_n = int(np.isin(g, own, assume_unique=True).sum())
                    if shared_n >= CONTAINMENT * len(g):
                        rows.append(lo + d)
                        out.append((items.ids[i], len(g), shared_n))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(pa.array(rows, pa.int64())) for c in (0, 1)], *[pa.array([x[k] for x in out], pa.int64()) for k in range(3)]],
            names=["doc_id", "text_key", "item_id", "n_item", "n_shared"])


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, text_key, item_id, n_item, n_shared, containment): documents that hold three quarters or more of the distinct
    five-word shingles of a benchmark item, A-Z lower-cased.

    Null or empty texts and items of fewer than five words have no shingles and match nothing.  Rows that repeat a
    doc_id and text give the pair once; a null doc_id is kept as a null.  Items are searched in blocks whose
    tables take at most ``block_bytes`` bytes (an item that alone takes more is a block of its own), one block after another.  Either table may be empty; other columns
    are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    items = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null").distinct()
    # blocks of hashed items, sized by what they take in a task: 16 times as many buckets as blocks
    cost = F.octet_length("text").cast("long") * TEXT_BYTES + ITEM_BYTES
    total = items.agg(F.sum(cost).alias("b")).first()["b"] or 0
    buckets = max(1, -(-16 * total // block_bytes))
    if buckets > 16:
        items = cut_lineage(items.withColumn("bucket", F.pmod(F.xxhash64("item_id", "text"), F.lit(buckets))).repartitionByRange("bucket"), "items")
    else:
        items = items.withColumn("bucket", F.lit(0))
    sizes = items.groupBy("bucket").agg(F.sum(cost).alias("b"))
    run = F.floor(F.sum("b").over(Window.orderBy("bucket")) / F.lit(block_bytes))
    blocks = [r["blocks"] for r in sizes.withColumn("run", run).groupBy("run").agg(F.collect_list("bucket").alias("blocks")).sort("run").collect()]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "text_key", "item_id", "n_item", "n_shared")])
    out = spark.createDataFrame([], schema)
    for block in blocks:  # one after another: a block's pairs are written before the next block is built
        rows = items.where(F.col("bucket").isin(block)).select("item_id", "text").collect()
        shared = spark.sparkContext.broadcast(Items([r["item_id"] for r in rows], [r["text"] for r in rows]))
        found = cut_lineage(docs.mapInArrow(lambda batches, shared=shared: _search(batches, shared), schema), "leaks")
        shared.destroy()
        out = out.union(found)
    return out.distinct().withColumn("containment", F.col("n_shared") / F.col("n_item"))
