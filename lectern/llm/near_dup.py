"""MinHash near-dedup with SetSketch registers.

A document's set is its distinct shingles of five words, A-Z lower-cased.  Its sketch has one register per hash
function: the smallest of the shingles' exponentially distributed hash values, kept as the truncated exponent to
base ``BASE`` (registers of a union are the larger of each pair, so sketches merge).  Equal registers are about as
frequent as the Jaccard similarity.  Bands of registers give candidates, the joint likelihood of both registers and
set sizes drops what cannot reach the threshold, and the full sets confirm every link.

Nothing quadratic: documents of equal sets are one class, and in a bucket every class is compared with the bucket's
smallest only.  Components of the links so found need no further pair inside themselves.  Classes that share a
bucket with another component are then joined across components by prefixes: with shingles in order of rising
frequency, two sets that reach the threshold share a shingle so early in both that enough could still follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.graph import components
from lectern.llm.native import text_key
from lectern.llm.words import mix, shingles, stream, text_blocks
from lectern.session import cut_lineage

K = 5
THRESHOLD = 0.75
# 40 bands of 4 registers: a pair at 0.75 shares no band with a chance below 3e-7.
BANDS, ROWS = 40, 4
BASE, RATE, TOP = 1.001, 20.0, 65_534
# Words of 64 bits that hold the parities of a set's shared shingles.
PARITY = 4
# A candidate goes when its registers are e**-25 times as likely at the best similarity below the threshold as at any above.
SURE = 25.0

_U = np.uint64


def registers(h: np.ndarray, first: np.ndarray, m: int) -> np.ndarray:
    """m registers (uint16) of each set h[first[i]:first[i+1]]; an empty set has zeros."""
    n = np.diff(first)
    full = np.flatnonzero(n)
    least = np.full((len(n), m), _U(0xFFFFFFFFFFFFFFFF))
    xor, mul = stream(m, 11), stream(m, 12) | _U(1)
    step = 0
    while step < len(full):  # sets of about 32k shingles at a time stay in the processor's cache
        stop = max(step + 1, int(np.searchsorted(first[full], first[full[step]] + 32_768)))
        rows = full[step:stop]
        lo = first[rows[0]]
        x, at = h[lo : first[rows[-1] + 1]], first[rows] - lo
        t = np.empty_like(x)
        for j in range(m):
            np.bitwise_xor(x, xor[j], out=t)
            np.multiply(t, mul[j], out=t)
            least[rows, j] = np.minimum.reduceat(t, at)
        step = stop
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / RATE
    out = np.clip(np.floor(1.0 - np.log(np.maximum(value, 1e-300)) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)
    out[n == 0] = 0
    return out


def _set_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(first row, end row, sorted distinct shingles of each row in turn, where each row's begin, [fp_a, fp_b])."""
    for lo, hi, w in text_blocks(column, lower=True):
        h, first = shingles(w, K)
        for i in np.flatnonzero(np.diff(first) > 1):
            h[first[i] : first[i + 1]].sort()
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        new[first[:-1][np.diff(first) > 0]] = True
        h, first = h[new], np.concatenate([[0], np.cumsum(new)])[first]
        sums = [np.concatenate([np.zeros(1, dtype=_U), np.cumsum(mix(h ^ s))]) for s in stream(2, 13)]
        yield lo, hi, h, first, [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_key, text -> doc_id, text_key, n, fp_a, fp_b, registers."""
    for batch in batches:
        for lo, hi, h, first, fps in _set_blocks(batch.column(2)):
            regs = registers(h, first, BANDS * ROWS)
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c).slice(lo, hi - lo) for c in (0, 1)], pa.array(np.diff(first), pa.int64()), *map(pa.array, fps),
                pa.array([r.tobytes() for r in regs], pa.binary()),
            ], names=["doc_id", "text_key", "n", "fp_a", "fp_b", "regs"])


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood Jaccard similarity of pairs of register rows, and the log likelihood that is lost
    when the similarity is held at the threshold or above."""
    u = na / (na + nb)
    v = 1 - u
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    tail = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def score(j: np.ndarray) -> np.ndarray:
        p, q = tail(np.maximum(u - v * j, 1e-12)), tail(np.maximum(v - u * j, 1e-12))
        return more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))

    def best(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        for _ in range(50):  # the log likelihood has one peak
            c, d = lo + (hi - lo) / 3, hi - (hi - lo) / 3
            up = score(c) < score(d)
            lo, hi = np.where(up, c, lo), np.where(up, hi, d)
        return (lo + hi) / 2

    most = np.minimum(u / v, v / u)
    j = best(np.zeros_like(u), most)
    held = best(np.minimum(THRESHOLD, most), most)
    return j, np.where(j >= THRESHOLD, 0.0, score(j) - score(held))


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, na, nb, ra, rb -> a, b of the pairs that the registers do not rule out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, BANDS * ROWS) for c in (4, 5))
        na, nb = (batch.column(c).to_numpy().astype(float) for c in (2, 3))
        _, lost = similarity(ra, rb, na, nb)
        # sizes alone bound the similarity
        keep = (lost <= SURE) & (100 * np.minimum(na, nb) >= 100 * THRESHOLD * np.maximum(na, nb))
        yield batch.select([0, 1]).filter(pa.array(keep))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, fp_a, fp_b, text -> id, the whole set, where the text has these fingerprints."""
    for batch in batches:
        for lo, hi, h, first, (fa, fb) in _set_blocks(batch.column(3)):
            part = batch.slice(lo, hi - lo)
            own = (part.column(1).to_numpy() == fa) & (part.column(2).to_numpy() == fb)
            sets = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column(0), sets], names=["id", "grams"]).filter(pa.array(own))


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, n, fp_a, fp_b, regs) of every row; n counts distinct shingles, fp_a and fp_b tell sets apart."""
    return docs.select(F.col(key).cast("long"), text_key(text), F.col(text)).mapInArrow(
        _sketches, "doc_id long, text_key long, n long, fp_a long, fp_b long, regs binary")


def _apart(rows: DataFrame, bucket: str) -> DataFrame:
    """Rows (bucket, cid, part, ...) of buckets with several parts, with ``major``, the part most frequent there."""
    sizes = rows.groupBy(bucket, "part").agg(F.count(F.lit(1)).alias("k"))
    major = sizes.groupBy(bucket).agg(F.max(F.struct("k", "part")).alias("top"), F.count(F.lit(1)).alias("parts")).where(
        "parts > 1").select(bucket, F.col("top.part").alias("major"))
    # both sides written, so that the join deals them anew and a hot bucket's rows can be split between tasks
    return cut_lineage(rows.join(cut_lineage(major, "major"), bucket), "apart")


def _prefix_pairs(sets: DataFrame) -> DataFrame:
    """(a, b): pairs of different parts that their shingles' order and parities let reach the threshold; sets: id, part, grams.

    Each set has bits that tell whether an odd number of its shared shingles falls there: where the bits of two sets differ,
    at least one shingle is in one of them only, and those of one set alone are never shared.  At the threshold a seventh of
    both sizes may differ, so that of a large group's many pairs those a little below it are dropped inside the join.
    """
    sized = sets.select(F.col("id").alias("cid"), "part", F.size("grams").cast("long").alias("n"), "grams")
    tokens = sized.select("cid", "part", "n", F.explode("grams").alias("g"))
    often = cut_lineage(tokens.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "often")
    seat = F.xxhash64("g")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(seat, 8), F.lit(64)).cast("int"))
    parity = [f"p{w}" for w in range(PARITY)]
    ranked = tokens.join(often, "g").groupBy("cid", "part", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "g"))).alias("r"),
        *[F.bit_xor(F.when(F.pmod(seat, F.lit(PARITY)) == w, bit).otherwise(F.lit(0).cast("long"))).alias(c) for w, c in enumerate(parity)])
    # shingles of one set only come first and meet nothing; of the others, those of the first quarter can be shared
    alone = F.col("n") - F.size("r")
    most = F.greatest(F.col("n") - F.ceil(F.lit(THRESHOLD) * F.col("n")) + 1 - alone, F.lit(0)).cast("int")
    prefix = ranked.select("cid", "part", "n", alone.alias("alone"), *parity, F.posexplode(F.slice("r", F.lit(1), most)).alias("i", "t")).select(
        F.col("t.g").alias("g"), "cid", "part", (F.col("n") - F.col("alone") - F.col("i")).alias("left"), "n", "alone", *parity)
    prefix = _apart(cut_lineage(prefix, "prefix"), "g")
    minor = prefix.where("part <> major").select("g", *[F.col(c).alias(f"x_{c}") for c in ("cid", "part", "left", "n", "alone", *parity)])
    differ = "x_alone + alone + " + " + ".join(f"bit_count(x_{c} ^ {c})" for c in parity)
    pairs = minor.join(prefix, "g").where(
        "x_part <> part and (part = major or x_cid < cid) and 7 * least(x_left, left) >= 3 * (x_n + n) and 4 * least(x_n, n) >= 3 * greatest(x_n, n)"
        f" and 7 * ({differ}) <= x_n + n")
    return pairs.select(F.least("x_cid", "cid").alias("a"), F.greatest("x_cid", "cid").alias("b")).distinct()


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of class ids, each given once, whose full sets reach the threshold."""
    for side in ("a", "b"):
        one = classes.select(F.col("cid").alias(side), F.col("n").alias(f"n{side}"), F.col("regs").alias(f"r{side}"))
        pairs = pairs.join(one, side)
    likely = cut_lineage(pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_likely, "a long, b long"), "likely")
    both = likely.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
    shared = F.size(F.array_intersect("ga", "gb")).cast("long")
    both = both.select("a", "b", shared.alias("i"), (F.size("ga").cast("long") + F.size("gb")).alias("s"))
    return both.where(F.lit(100) * F.col("i") >= F.lit(round(100 * THRESHOLD)) * (F.col("s") - F.col("i"))).select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_key, n_shingles, component_id, kept.

    Rows are linked where 100 * |intersection| >= 75 * |union| of their sets; ``component_id`` is the smallest
    doc_id reachable, ``kept`` tells whether it is the row's own.  Texts without words (null, empty) are linked with
    nothing.  A row whose doc_id is null is linked with nothing: its component is null and it is kept.  Rows that
    repeat a doc_id each get a result, by their own text.  Other columns are ignored.  An empty table gives none.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = cut_lineage(sketch(docs), "sketches")
    same = ["n", "fp_a", "fp_b"]
    # a class has an id of its own: documents that repeat a number may have one in several classes
    classes = rows.where("n > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("least"), F.first("regs").alias("regs"))
    classes = cut_lineage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    width = 2 * ROWS  # bytes of a band
    band = F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.substring("regs", 1 + i * width, width)) for i in range(BANDS)])).alias("bucket")
    bands = classes.select("cid", band)
    shared = bands.groupBy("bucket").agg(F.min("cid").alias("head"), F.max("cid").alias("tail")).where("head < tail")
    members = cut_lineage(bands.join(shared.select("bucket", "head"), "bucket"), "members")

    # the whole sets of all classes that share a bucket; rows that repeat a document give its set once
    known = classes.join(members.select("cid").distinct(), "cid").select(F.col("least").alias("doc_id"), "cid", "fp_a", "fp_b")
    sets = cut_lineage(docs.join(known, "doc_id").select("cid", "fp_a", "fp_b", "text").mapInArrow(
        _grams, "id long, grams array<long>").dropDuplicates(["id"]), "sets")

    stars = cut_lineage(members.where("cid <> head").select(F.col("head").alias("a"), F.col("cid").alias("b")).distinct(), "stars")
    links = cut_lineage(_confirmed(stars, classes, sets), "links")
    groups = components(links)

    part = cut_lineage(members.join(groups.withColumnRenamed("node", "cid"), "cid", "left").select(
        "bucket", "cid", F.coalesce("component", "cid").alias("part")), "parts")
    mixed = _apart(part, "bucket").select(F.col("cid").alias("id"), "part").distinct()
    rest = cut_lineage(_prefix_pairs(sets.join(mixed, "id")).join(stars, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = links.union(cut_lineage(_confirmed(rest, classes, sets), "links"))
        groups = components(links)

    groups = groups.withColumnRenamed("node", "cid")
    smallest = cut_lineage(classes.join(groups, "cid").groupBy("component").agg(F.min("least").alias("smallest")), "smallest")
    groups = cut_lineage(groups.join(smallest, "component").select("cid", "smallest"), "groups")
    label = classes.join(groups, "cid", "left").select(*same, F.coalesce("smallest", "least").alias("component_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    joined = rows.select("doc_id", "text_key", *same).join(label, same, "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), own.alias("component_id"))
    return joined.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
