"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0 to n-1 in an order that their content alone decides: by a bucket of the hash of key and content, then
by key and content; so a key that many rows share is dealt to many buckets.  The numbering needs no sort of the whole table: each bucket is numbered by itself and starts where
the buckets before it end.  A keyed Feistel network permutes the numbers: over a grid of a by b cells, with
a * b >= n > a * b - a, each round adds a hash of one coordinate to the other; numbers that land past n walk on
until they are inside.  Position p of the permutation is slot p div k of shard p mod k, so shard and slot of any
row number can be computed without the table, and the row number of any shard and slot too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 8192  # of row numbering; the table of their offsets has as many rows
ROUNDS = 6
# Fixed values of the round function: a prime modulus and a multiplier.
PRIME, FACTOR = 2147483647, 48271
MAX_WALK = 64


def _hash(x: Column, salt: Column) -> Column:
    """A hash of x below PRIME, in whole numbers below 2**62 only."""
    t = F.pmod(F.pmod(x, F.lit(PRIME)) * FACTOR + salt, F.lit(PRIME))
    t = F.pmod(F.pmod(t * t + salt, F.lit(PRIME)) * FACTOR, F.lit(PRIME))
    return F.pmod(t * t + t, F.lit(PRIME))


def grid(n: Column) -> tuple[Column, Column]:
    """Sides of the smallest grid about as wide as high that holds n cells."""
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1).cast("long"))
    return a, F.greatest(F.ceil(n / a).cast("long"), F.lit(1).cast("long"))


def _network(p: Column, n: Column, seed: int, inverse: bool = False) -> Column:
    """One pass of the network over [0, a * b): p stands for the cell (p mod a, p div a)."""
    salts = [[F.lit((seed * 7919 + i * 104729 + k * 15485863 + 12345) % PRIME).cast("long") for k in (0, 1)] for i in range(ROUNDS // 2)]
    rounds = F.array(*[F.struct(s[0].alias("even"), s[1].alias("odd")) for s in (reversed(salts) if inverse else salts)])
    a, b = grid(n)
    cell = F.struct((p % a).alias("x"), F.floor(p / a).cast("long").alias("y"), a.alias("a"), b.alias("b"))

    def forth(c: Column, s: Column) -> Column:
        x = F.pmod(c["x"] + _hash(c["y"], s["even"]), c["a"])
        return F.struct(x.alias("x"), F.pmod(c["y"] + _hash(x, s["odd"]), c["b"]).alias("y"), c["a"].alias("a"), c["b"].alias("b"))

    def back(c: Column, s: Column) -> Column:
        y = F.pmod(c["y"] - _hash(c["x"], s["odd"]), c["b"])
        return F.struct(F.pmod(c["x"] - _hash(y, s["even"]), c["a"]).alias("x"), y.alias("y"), c["a"].alias("a"), c["b"].alias("b"))

    return F.aggregate(rounds, cell, back if inverse else forth, lambda c: c["y"] * c["a"] + c["x"])


def permuted(row: Column, n: Column, seed: int = 0, inverse: bool = False) -> Column:
    """The position of row number ``row`` of n (or, inverted, the row number of a position).

    Fewer than one cell in sqrt(n) lies outside; a walk past ``MAX_WALK`` such cells, of a chance below
    sqrt(n) ** -64 and none below 4096 rows, is an error rather than a wrong result.
    """
    def walk(p: Column) -> Column:
        steps = F.when(p < n, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.lit(MAX_WALK)))
        return F.aggregate(steps, p, lambda q, _: F.when(q < n, q).otherwise(_network(q, n, seed, inverse)))

    inside = F.element_at(F.transform(F.array(_network(row, n, seed, inverse)), walk), 1)
    checked = F.transform(F.array(inside), lambda p: F.when(p < n, p).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long")))
    return F.element_at(checked, 1)


def row_numbers(rows: DataFrame, key: str, content: Sequence[str], buckets: int = BUCKETS, hashed: Sequence[str] | None = None) -> DataFrame:
    """``rows`` (key and content columns only) with ``row`` from 0, gapless, and ``n`` rows in all.

    ``hashed`` are the content columns that decide the bucket together with the key (default: all).
    Equal rows are counted before they are numbered, so a row repeated very often is one row of the sort.
    """
    columns = [key, *content]
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_m"))
    named = F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("")), *[F.col(c).cast("string") for c in (content if hashed is None else hashed)])
    spread = F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long")
    counted = counted.withColumn("_b", F.pmod(spread, F.lit(buckets)).cast("int"))
    before = Window.partitionBy("_b").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_at", F.coalesce(F.sum("_m").over(before), F.lit(0)))
    # at most ``buckets`` rows: a bounded table
    sizes = rows.groupBy(F.pmod(spread, F.lit(buckets)).cast("int").alias("_b")).agg(F.count(F.lit(1)).alias("_k"))
    order = Window.orderBy("_b")
    offsets = sizes.select("_b", (F.sum("_k").over(order) - F.col("_k")).alias("_from"),
                           F.sum("_k").over(Window.partitionBy()).alias("n"))
    many = placed.join(F.broadcast(offsets), "_b")
    # copies in steps of 4096, so that no array grows with their number
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_m") - 1) / 4096).cast("long")))
    many = many.withColumn("_s", step)
    copy = F.explode(F.sequence(F.col("_s") * 4096, F.least(F.col("_s") * 4096 + 4095, F.col("_m") - 1)))
    many = many.withColumn("_c", copy)
    return many.select(*columns, (F.col("_from") + F.col("_at") + F.col("_c")).cast("long").alias("row"), F.col("n").cast("long").alias("n"))


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, row, n, position, shard, slot.

    ``size`` is the text's UTF-8 bytes (null: none) plus one.  Shard sizes in rows are at most one apart and slots
    are gapless from 0.  The result depends on the rows' keys and texts, the seed and the shard count only, not on
    files, partitions or order.  Null keys and texts, empty and repeated rows are rows like others (a null text has the
    checksum of the empty one); rows alike in key and text are interchangeable.  An empty table gives no rows.
    """
    digest = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.encode(F.col(text), "UTF-8"), F.encode(F.lit(""), "UTF-8"))).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"))
    rows = row_numbers(digest, "doc_id", ["size", "text_crc32", "text_hash"], hashed=["size", "text_crc32"])
    placed = rows.withColumn("position", permuted(F.col("row"), F.col("n"), seed))
    return placed.select(
        "doc_id", "size", "text_crc32", "row", "n", "position",
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("position") / shards).cast("long").alias("slot"))
