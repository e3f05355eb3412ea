from __future__ import annotations

import numpy as np
import pyarrow as pa

from lectern.llm.decontaminate import Items, contaminated
from lectern.llm.words import shingles as hashed
from lectern.llm.words import text_blocks

from .helpers import SF, awkward, frames, prose, shingles, words


def brute(docs: list[tuple], items: list[tuple]) -> set[tuple]:
    out = set()
    grams = {i: shingles(t) for i, t in items if len(words(t)) >= 5}
    for d, t in docs:
        own = shingles(t) if len(words(t)) >= 5 else set()
        for i, g in grams.items():
            n = len(own & g)
            if n >= 0.75 * len(g):
                out.add((d, i, len(g), n))
    return out


def result(*args, **more) -> list[tuple]:
    return [(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in contaminated(*args, **more).collect()]


def test_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = result(docs, items)
    assert len(want) > 10 and set(got) == want and len(got) == len(want)
    assert set(result(docs, items, block_bytes=2000)) == want


def test_short_items_in_long_documents(spark):
    small, large = prose(20, 1, 9000), prose(700, 2, 9000)
    half = small.split()
    rows = [
        (1, prose(20_000, 3, 9000) + " " + small + " " + prose(9_000, 4, 9000)), (2, large), (3, " ".join(large.split()[:600])),
        (4, " ".join(large.split()[:400])), (5, small.upper()), (6, " ".join(half[:10] + ["cut"] + half[10:])), (7, None), (8, ""),
        (9, prose(3000, 5, 9000) + " " + " ".join(large.split()[:350]) + " " + prose(2000, 6, 9000) + " " + " ".join(large.split()[350:])),
        (None, small), (10, "one two three four"),
    ]
    items = [(1, small), (2, large), (3, None), (4, ""), (5, "one two three four"), (6, small), (1, small)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = result(docs, bench)
    assert set(got) == brute(rows, items) and len(got) == len(set(got))
    assert {(1, 1), (1, 6), (2, 2), (3, 2), (5, 1), (9, 2), (None, 1)} <= {x[:2] for x in got}


def test_awkward_rows(spark):
    docs, clashing, empty = frames(spark)
    items = spark.createDataFrame([(1, prose(120, 1)), (2, prose(60, 9))], "item_id long, text string")
    want = brute([(i, t) for i, t, *_ in awkward()], [(r.item_id, r.text) for r in items.collect()])
    assert set(result(docs, items)) == want and set(result(clashing, items)) == want
    assert result(empty, items) == [] and result(docs, items.limit(0)) == []


def test_items_of_few_shingles(spark):
    long = prose(4_000, 11, 9000).split()
    rows = [(0, " ".join(long)), (1, " ".join(long[:2000])), (2, prose(4_000, 12, 9000)), (3, " ".join(long[50:61])), (4, "")]
    items = [(100 * n + k, " ".join(long[37 * k + n : 37 * k + 2 * n])) for n in range(5, 13) for k in range(40)]
    # a word cut from either end leaves 3/4 of some of them; a shared beginning makes their first shingle a common one
    items += [(5000 + n, " ".join(["cut", *long[500 : 500 + n]])) for n in range(4, 12)] + [(6000 + n, " ".join([*long[:7], *long[900 : 900 + n]])) for n in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = result(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert set(got) == brute(rows, items) and len(got) == len(set(got))
    assert {(0, i) for i, _ in items if i < 2000} <= {x[:2] for x in got}


def test_no_item_of_one_shingle_is_missed_in_long_documents():
    # windows of 32 shingles and 128 bands miss one in about 225
    texts = [prose(600, 1000 + k, 10**6) for k in range(40)]
    parts = [(d, " ".join(t.split()[i : i + 5])) for d, t in enumerate(texts) for i in range(7, 590, 12)]
    items = Items(list(range(len(parts))), [x for _, x in parts])
    ((_, _, w),) = text_blocks(pa.array(texts, pa.string()), lower=True)
    found = items.candidates(*hashed(w, 5))
    assert {(d, i) for i, (d, _) in enumerate(parts)} <= found
    assert items.candidates(np.zeros(0, dtype=np.uint64), np.zeros(3, dtype=np.int64)) == set()


def test_a_block_takes_no_more_than_its_bound():
    import pickle

    from lectern.llm.decontaminate import ITEM_BYTES, TEXT_BYTES

    texts = [prose(30, i, 5000) for i in range(3000)] + [prose(6, i, 5000) for i in range(200)] + [prose(3000, i, 5000) for i in range(20)]
    items = Items(list(range(len(texts))), texts)
    bound = sum(ITEM_BYTES + TEXT_BYTES * len(t) for t in texts)
    assert items.bytes() <= bound and len(pickle.dumps(items)) <= 1.1 * bound
    assert bound < 25_000_000  # 600 kB of text
