from __future__ import annotations

import os
import random
from collections import Counter

from lectern.operators.profile import top_values, value_histogram
from lectern.streaming.profiles import ProfileStore, incremental_profile

SCHEMA = "c string, m string, y int"


def data(n=600, seed=2):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "a", "b", None]), rng.choice(["x", "y", "z", "w", None]), rng.choice([None, 1999, 2001, 2001])) for _ in range(n)]


def totals(rows):
    out = Counter()
    for c, m, y in rows:
        out[c, "", ""] += 1
        for f, v in (("m", m), ("y", y)):
            if v is not None:
                out[c, f, str(v)] += 1
    return out


def counted(store):
    return Counter({(r["cluster"], r["field"], r["value"]): r["cnt"] for r in store.counts().collect()})


def test_batches_add_up_to_the_static_profile(spark, tmp_dir):
    rows = data()
    store = ProfileStore(spark, os.path.join(tmp_dir, "p"), ["m", "y"], merge_after=3)
    assert store.counts().collect() == [] and store.generation() == -1
    for k in range(8):
        part = spark.createDataFrame(rows[75 * k : 75 * k + 75], SCHEMA)
        store.add(part, k, "c")
        store.add(part, k, "c")  # tried again
        assert counted(store) == totals(rows[: 75 * k + 75])
    assert store.generation() >= 5
    full = spark.createDataFrame(rows, SCHEMA).where("c is not null")
    want = {(r["c"], r["rank"], r["value"], r["cnt"]) for r in top_values(full, "c", "m", 3).collect()}
    assert {(r["cluster"], r["rank"], r["value"], r["cnt"]) for r in store.top_values().where("field = 'm' AND cluster IS NOT NULL").collect()} == want
    want = {(r["c"], str(r["value"]), r["cnt"]) for r in value_histogram(full, "c", "y").collect()}
    assert {(r["cluster"], r["value"], r["cnt"]) for r in store.histogram("y").where("cluster IS NOT NULL").collect()} == want
    assert {r["cluster"]: r["size"] for r in store.sizes().collect()} == Counter(c for c, *_ in rows)


def test_a_merge_that_died_changes_nothing(spark, tmp_dir):
    rows = data(90)
    store = ProfileStore(spark, os.path.join(tmp_dir, "p"), ["m", "y"], merge_after=100)
    for k in range(3):
        store.add(spark.createDataFrame(rows[30 * k : 30 * k + 30], SCHEMA), k, "c")
    # written, but not listed
    store.counts().limit(2).write.parquet(os.path.join(store.path, "upto-1"))
    assert counted(store) == totals(rows)
    store.merge()
    store.merge()
    assert store.generation() == 1 and counted(store) == totals(rows)


def test_files_as_they_arrive(spark, tmp_dir):
    rows = data(200, 4)
    source, log = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "log")
    store = ProfileStore(spark, os.path.join(tmp_dir, "p"), ["m", "y"], merge_after=2)
    for k in range(4):
        spark.createDataFrame(rows[50 * k : 50 * k + 50], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        if k % 2:
            incremental_profile(spark, source, spark.createDataFrame([], SCHEMA).schema, store, log, "c", max_files_per_trigger=1)
            assert counted(store) == totals(rows[: 50 * k + 50])
