from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lectern.llm.sharding import permuted, shard_rows

from .helpers import SCHEMA, awkward, frames, same_rows


@pytest.mark.parametrize("n", [1, 2, 3, 17, 4097, 30_011])
def test_permutation_is_one_to_one_and_inverts(spark, n):
    rows = spark.range(n).select("id", permuted(F.col("id"), F.lit(n), 3).alias("p"))
    rows = rows.withColumn("back", permuted(F.col("p"), F.lit(n), 3, inverse=True))
    one = rows.agg(F.count_distinct("p").alias("k"), F.min("p").alias("a"), F.max("p").alias("z"),
                   F.sum((F.col("back") != F.col("id")).cast("int")).alias("bad")).first()
    assert tuple(one) == (n, 0, n - 1, 0)


def test_shuffles(spark):
    order = [r.p for r in spark.range(2000).select("id", permuted(F.col("id"), F.lit(2000), 5).alias("p")).sort("id").collect()]
    assert sum(abs(a - i) < 20 for i, a in enumerate(order)) < 200
    assert abs(sum(a < b for a, b in zip(order, order[1:], strict=False)) - 1000) < 120


def test_shards_of_awkward_rows(spark):
    docs, clashing, empty = frames(spark)
    out = shard_rows(docs, 8, seed=1).collect()
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in awkward()]
    assert same_rows(want, [(r.doc_id, r.size, r.text_crc32) for r in out])
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert same_rows(out, shard_rows(clashing.repartition(5), 8, seed=1).collect())
    assert shard_rows(empty, 8).collect() == []


def test_a_row_repeated_very_often(spark):
    docs = spark.range(10_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x").alias("text")).union(
        spark.createDataFrame([(1, "y")], "doc_id long, text string"))
    out = shard_rows(docs, 3).collect()
    assert len({(r.shard, r.slot) for r in out}) == 10_001


def test_computable_shard(spark):
    out = shard_rows(spark.createDataFrame(awkward(), SCHEMA), 8, seed=4)
    again = out.select(F.pmod(permuted(F.col("row"), F.col("n"), 4), F.lit(8)).cast("int").alias("s"), "shard").collect()
    assert all(r.s == r.shard for r in again)


def test_one_key_of_many_texts_is_dealt_to_many_buckets(spark):
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    out = shard_rows(rows, 8)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan
    digest = rows.select("doc_id", (F.octet_length("text").cast("long") + 1).alias("size"), F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"))
    named = F.concat_ws("/", F.lit(""), F.col("size").cast("string"), F.col("text_crc32").cast("string"))
    bucket = F.pmod(F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long"), F.lit(8192))
    assert digest.groupBy(bucket).count().agg(F.max("count")).first()[0] < 20
    got = out.collect()
    assert sorted(r.row for r in got) == list(range(20_000)) and all(sorted(r.slot for r in got if r.shard == s) == list(range(2500)) for s in range(8))
