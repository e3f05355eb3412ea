"""What queries leave on disk: shuffle files go with the cut they were made for, pairs do not carry their vectors through a shuffle."""

import os

from pyspark.sql import functions as F

import lectern.operators.neighbors as neighbors
from lectern.session import cut_lineage, discard, scratch_dir


def shuffled(spark):
    """Bytes of the files that this session's shuffles have on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def tables(spark):
    at = scratch_dir(spark).removeprefix("file:")
    return {f.rsplit("-", 1)[0] for f in os.listdir(at)} if os.path.isdir(at) else set()


def test_a_cut_leaves_no_shuffle_files_and_can_be_discarded(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before, before = spark.conf.get(key, None), shuffled(spark)
    rows = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("m")).repartition(4, "id")
    table = cut_lineage(rows, "discarded")
    for _ in range(50):
        if shuffled(spark) <= before:
            break
        __import__("time").sleep(0.1)
    assert shuffled(spark) <= before and spark.conf.get(key, None) == set_before
    assert table.count() == 200_000 and "discarded" in tables(spark)
    discard(table)
    assert "discarded" not in tables(spark)


def test_pairs_of_copies_do_not_send_their_vectors_a_pair(spark):
    rows = [(i, f"t{j}", 1.0 + j % 7 + (i % 3) * 0.01 * (j == 0)) for i in range(240) for j in range(60)]
    weights = spark.createDataFrame(rows, "id long, term string, weight double")
    start = tables(spark)
    found = neighbors.sparse_pairs(weights, "id", 0.9)
    assert not ({"rare", "terms", "unit"} - start) & tables(spark)
    before = shuffled(spark)
    got = {(r["i"], r["j"]) for r in found.collect()}
    assert got == {(i, j) for j in range(240) for i in range(j)}
    # a row for each pair and term would be 28,680 * 60 of them, 8 bytes and more each
    assert shuffled(spark) - before < 28_680 * 60


def test_units_hold_parts_of_a_leaders_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "UNIT_ROWS", 7)
    rows = [(i, f"t{(i // 40) * 100 + j}", 1.0 + (i * j) % 3 * 0.05) for i in range(90) for j in range(12)] + [(5, "t0", 0.5), (None, "t1", 1.0)]
    got = {(r["i"], r["j"]): r["sim"] for r in neighbors.sparse_pairs(spark.createDataFrame(rows, "id long, term string, weight double"), "id", 0.95).collect()}
    vecs, square = {}, {}
    for i, t, w in rows:
        v = vecs.setdefault(i, {})
        v[t], square[i] = v.get(t, 0.0) + w, square.get(i, 0.0) + w * w
    want = {(i, j): sum(w * vecs[j].get(t, 0.0) for t, w in vecs[i].items()) / (square[i] * square[j]) ** 0.5 for i in range(90) for j in range(i + 1, 90)}
    want = {p: s for p, s in want.items() if s >= 0.95}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_sparse_kmeans_keeps_the_tables_of_one_iteration(spark):
    from lectern.operators.sparse import sparse_kmeans
    from lectern.operators.vectors import tfidf_table

    texts = spark.createDataFrame([(i, f"a{i % 3} b{i % 3} c{i % 5} d{i}") for i in range(60)], "id long, t string")
    before = os.listdir(scratch_dir(spark).removeprefix("file:"))
    weights = tfidf_table(texts, "t", "id")
    for start, restarts in ((None, 3), (weights.join(spark.createDataFrame([(0, 0), (1, 1)], "id long, cluster int"), "id").select("cluster", "term", "weight"), 1)):
        found = sparse_kmeans(weights, texts, "id", k=3, restarts=restarts, max_iter=5, start=start, together=True)
        assert found.labels.count() == 60 and found.centers.count() > 0
    left = [f.rsplit("-", 1)[0] for f in os.listdir(scratch_dir(spark).removeprefix("file:")) if f not in before]
    assert sorted(left) == ["final", "final", "found", "found", "weights"]
