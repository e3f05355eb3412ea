"""Mixing sources to target weights by temperature.

Source i with token share s_i gets the weight s_i ** x / sum of s_j ** x.  x = 1 keeps the sources as they are, x = 0
makes them equal; entropy and the repetition of small sources both grow as x falls.  The exponent is bisected: the
smallest one at which the entropy is down to the target and no source repeats more than allowed.  Weights become
token budgets, and budgets block permutations: a source's documents are dealt into about as many blocks as a block
has documents; each epoch of the source is a new permutation of blocks and of the documents inside; whole epochs
come first, then the blocks of the last epoch that fit, then the documents of the next block that fit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.native import text_key, words
from lectern.session import cut_lineage

ENTROPY = 0.95  # of the logarithm of the number of sources
REPEATS = 4.0
STEPS = 4  # bisection steps that one aggregate over the sources decides
PASSES = 8


def exponent(sources: DataFrame, entropy: float, repeats: float, budget: float) -> tuple[float, float]:
    """(x, sum of s ** x) for ``sources`` (n: tokens); bisected on aggregates over the sources, in passes that each
    evaluate all exponents that the next steps can come to.  (1, 1) where even the natural shares are mixed enough,
    or repeat too much to be helped."""
    one = sources.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).first()
    total, k = one["n"], one["k"]
    if not total or k < 2:
        return 1.0, 1.0
    least = one["least"] / total
    share = F.col("n") / F.lit(float(total))

    def evaluate(xs: list[float]) -> dict[float, tuple[bool, float]]:
        cells = [c for x in xs for c in (F.sum(F.pow(share, F.lit(x))), F.sum(F.pow(share, F.lit(x)) * F.log(share)))]
        row = sources.agg(*cells).first()
        out = {}
        for i, x in enumerate(xs):
            z, e = row[2 * i], row[2 * i + 1]
            low = math.log(z) - x * e / z < entropy * math.log(k)
            few = budget / total * least ** (x - 1) / z <= repeats
            out[x] = (low and few, z)
        return out

    ends = evaluate([0.0, 1.0])
    if not ends[1.0][0]:
        return 1.0, 1.0
    if ends[0.0][0]:
        return 0.0, ends[0.0][1]
    lo, hi, z = 0.0, 1.0, ends[1.0][1]
    for _ in range(PASSES):
        parts = 1 << STEPS
        xs = [lo + (hi - lo) * i / parts for i in range(1, parts)]
        seen = evaluate(xs)
        for _ in range(STEPS):
            mid = min(xs, key=lambda x: abs(x - (lo + hi) / 2))
            if seen[mid][0]:
                hi, z = mid, seen[mid][1]
            else:
                lo = mid
    return hi, z


def _order(seed: int, *cols: Column | str) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in cols])


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", entropy: float = ENTROPY,
                repeats: float = REPEATS, budget: int | None = None, seed: int = 0, tokens: Column | None = None) -> DataFrame:
    """One row per document and epoch in the mix: doc_id, text_key, source, n_tokens, n_rows, weight, epoch, block,
    block_order, row_order.

    Reading a source by epoch, block_order, row_order (with block and doc_id for ties) gives its block permutations.
    ``tokens`` (default: the number of words) is what shares and budgets count; ``budget`` (default: all tokens)
    is shared by the weights, to the nearest token by source; no source exceeds its share.  Rows equal in key, text and source are
    one unit of ``n_rows`` rows that goes into the mix whole.  A null source is a source of its own.  A source
    without tokens has no weight and is left out; documents without tokens in other sources cost nothing.  Null
    keys and texts are rows like others, other columns are ignored, an empty table gives none.
    """
    count = F.size(words(text)).cast("long") if tokens is None else tokens.cast("long")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_key(text).alias("text_key"), F.col(source).cast("string").alias("source"), count.alias("n_tokens"))
    rows = cut_lineage(rows.groupBy("doc_id", "text_key", "source", "n_tokens").agg(F.count(F.lit(1)).alias("n_rows")), "mix")
    cost = F.col("n_tokens") * F.col("n_rows")
    sources = cut_lineage(rows.groupBy("source").agg(F.sum(cost).alias("n"), F.count(F.lit(1)).alias("docs")).where("n > 0"), "sources")
    total = sources.agg(F.sum("n")).first()[0] or 0
    budget = total if budget is None else budget
    x, z = exponent(sources, entropy, repeats, budget)
    weight = F.pow(F.col("n") / F.lit(float(max(1, total))), F.lit(x)) / F.lit(z)
    plan = sources.withColumn("weight", weight).withColumn("due", F.round(F.col("weight") * F.lit(float(budget))).cast("long")).select(
        F.col("source").alias("from"), F.round("weight", 9).alias("weight"), F.floor(F.col("due") / F.col("n")).cast("long").alias("epochs"),
        F.pmod("due", "n").alias("rest"), F.ceil(F.sqrt("docs")).cast("long").alias("blocks"))

    dealt = rows.join(plan, F.col("source").eqNullSafe(F.col("from"))).drop("from").withColumn("cost", cost).withColumn(
        "block", F.pmod(_order(seed, F.lit("deal"), "doc_id", "text_key"), "blocks"))
    dealt = dealt.withColumn("block_order", _order(seed, F.lit("block"), "source", "block", "epochs")).withColumn(
        "row_order", _order(seed, F.lit("row"), "doc_id", "text_key", "epochs"))
    dealt = cut_lineage(dealt, "dealt")

    # the last, partial epoch: whole blocks while they fit, then documents of the block that does not
    block = ["source", "block"]
    before = Window.partitionBy("source").orderBy("block_order", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = dealt.groupBy(*block, "block_order", "rest").agg(F.sum("cost").alias("size"))
    blocks = blocks.withColumn("upto", F.sum("size").over(before)).withColumn("left", F.col("rest") - (F.col("upto") - F.col("size")))
    fits = blocks.where("left > 0").select(
        F.col("source").alias("s"), F.col("block").alias("b"), "left", (F.col("upto") <= F.col("rest")).alias("whole"))
    last = dealt.join(fits, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")
    inside = Window.partitionBy("source", "block").orderBy("row_order", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    some = last.where("not whole").withColumn("used", F.sum("cost").over(inside)).where("used <= left").drop("used")
    columns = ["doc_id", "text_key", "source", "n_tokens", "n_rows", "weight", "epoch", "block", "block_order", "row_order"]
    partial = last.where("whole").union(some).withColumn("epoch", F.col("epochs")).select(*columns)

    full = dealt.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
    full = full.withColumn("block_order", _order(seed, F.lit("block"), "source", "block", "epoch")).withColumn(
        "row_order", _order(seed, F.lit("row"), "doc_id", "text_key", "epoch")).select(*columns)
    return full.union(partial)
