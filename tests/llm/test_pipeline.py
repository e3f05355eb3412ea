from __future__ import annotations

import zlib
from collections import Counter

import corpus_pipeline
from lectern.session import cut_lineage

from .helpers import SF, awkward, frames, prose, same_rows
from .test_decontaminate import brute as leaks
from .test_near_dup import brute as groups
from .test_quality_rules import brute as quality


def staged(spark, docs, sf_dir):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], sf_dir), name.replace(" ", "-")))
    return out


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start, good, single, clean, mixed, shards = staged(spark, docs, SF)
    rows = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert all(df.columns == docs.columns for df in (good, single, clean, mixed))
    # no source of this table fails as a whole
    assert same_rows(rows(good), [(i, t) for i, t in rows(start) if not quality(t)[-1]])
    found = rows(good)
    kept = [row for row, g in zip(found, groups(found), strict=True) if g[3]]
    assert same_rows(rows(single), kept)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {x[0] for x in leaks(kept, items)}
    assert bad and same_rows(rows(clean), [x for x in kept if x[0] not in bad])
    assert {i for i, _ in rows(mixed)} <= {i for i, _ in rows(clean)}
    out = shards.collect()
    want = Counter((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows(mixed))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    slots = {k: sorted(r.slot for r in out if r.shard == k) for k in range(8)}
    assert all(s == list(range(len(s))) for s in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert same_rows(corpus_pipeline.run(spark, SF).collect(), out)


def test_awkward_rows(spark):
    docs, _, empty = frames(spark)
    start, good, single, clean, mixed, shards = staged(spark, docs, SF)
    rows = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert same_rows(rows(good), [(i, t) for i, t, *_ in awkward() if not quality(t)[-1]])
    found = rows(good)
    kept = [row for row, g in zip(found, groups(found), strict=True) if g[3]]
    assert same_rows(rows(single), list(dict.fromkeys(kept)))
    assert shards.count() == mixed.count()
    assert all(df.count() == 0 for df in staged(spark, empty, SF))
    assert prose(3, 1)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_equal_rows_of_two_sources(spark):
    """Each source's rows are told apart in quality rules and mix, and the mix has what its operator chose."""
    good = [(i, prose(80, i), "en", "a", 1) for i in range(1, 9)]
    junk = [(100 + i, "x y z " * 30, "en", "bad", 1) for i in range(40)]
    both = [(1, good[0][1], "en", "bad", 1), (2, good[1][1], "en", None, 1), (2, good[1][1], "de", None, 1)]
    docs = spark.createDataFrame(good + junk + both, SCHEMA)
    kept = [(r.doc_id, r.source) for r in corpus_pipeline.quality(spark, docs, SF).collect()]
    assert Counter(kept) == Counter([(i, "a") for i in range(1, 9)] + [(2, None)] * 2)
    rows = spark.createDataFrame(good + both, SCHEMA)
    chosen = corpus_pipeline.mix_sources(rows, seed=corpus_pipeline.SEED).collect()
    got = corpus_pipeline.mix(spark, rows, SF).collect()
    want = Counter()
    for r in chosen:
        want[r.doc_id, r.source] += r.n_rows
    assert want and Counter((r.doc_id, r.source) for r in got) == want


def test_one_of_equal_rows_stays_by_its_other_columns(spark):
    text = prose(90, 3)
    rows = [(1, text, "en", "b", 5), (1, text, "de", "b", 5), (1, text, "en", "a", 7), (None, text, "en", "a", 1), (None, text, "en", "a", 1)]
    for n in (1, 5):
        out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, SCHEMA).repartition(n), SF).collect()
        assert same_rows([tuple(r) for r in out], [rows[1], *rows[3:]])
