import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import similarity, vectors
from lectern.operators.clustering import clamp_k, kmeans, kmeans_cost
from tests.conftest import SF_MID, SF_SMALL


def _emb(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def _np(df):
    rows = df.select("vec_id", "embedding").orderBy("vec_id").collect()
    ids = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows], dtype=float)
    return ids, m / np.linalg.norm(m, axis=1, keepdims=True)


def test_masked_mean_pool_zero_mask(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [3.0, 5.0], 0), (2, [1.0, 1.0], 1), (2, [3.0, 3.0], 1), (2, [9.0, 9.0], 0)],
                               "k int, v array<double>, m int")
    got = {r.k: r.pooled for r in vectors.masked_mean_pool(df, "k", "v", "m").collect()}
    assert got[1] == [0.0, 0.0]
    assert got[2] == [2.0, 2.0]


@pytest.mark.parametrize("threshold,pivots,block", [(0.3, 16, 2048), (0.2, 4, 37), (0.0, 7, 50), (-1.0, 3, 64)])
def test_cosine_pairs_matches_brute_force(spark, threshold, pivots, block):
    e = _emb(spark)
    ids, m = _np(e)
    sims = m @ m.T
    want = {(int(ids[a]), int(ids[b])) for a in range(len(ids)) for b in range(a + 1, len(ids)) if sims[a, b] >= threshold}
    got_rows = similarity.cosine_pairs(e, "vec_id", "embedding", threshold, pivots=pivots, block_rows=block).collect()
    got = [(r.i, r.j) for r in got_rows]
    assert len(got) == len(set(got))  # each pair once
    # pairs right at the threshold may flip with float rounding; compare away from it
    near = {(int(ids[a]), int(ids[b])) for a in range(len(ids)) for b in range(a + 1, len(ids)) if abs(sims[a, b] - threshold) < 1e-9}
    assert set(got) - near == want - near


def _brute_topk(ids, m, k):
    sims = np.round(m @ m.T, similarity.SIM_DECIMALS)
    np.fill_diagonal(sims, -np.inf)
    out = {}
    for a, i in enumerate(ids):
        order = [o for o in np.lexsort((ids, -sims[a])) if o != a][:k]
        out[int(i)] = [int(ids[o]) for o in order]
    return out


@pytest.mark.parametrize("k,pivots,block", [(3, 16, 41), (1, 3, 2048), (5, 7, 13), (3, 64, 2048)])
def test_top_neighbors_matches_brute_force(spark, k, pivots, block):
    e = _emb(spark)
    ids, m = _np(e)
    want = _brute_topk(ids, m, k)
    got = {}
    for r in similarity.top_neighbors(e, "vec_id", "embedding", k=k, pivots=pivots, block_rows=block).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbor))
    assert {i: [n for _, n in sorted(v)] for i, v in got.items()} == want


def test_top_neighbors_with_copies(spark):
    # a third of the rows are exact copies (one home holds them all); ties go to smaller ids
    rng = np.random.default_rng(3)
    base = [float(x) for x in rng.normal(size=8)]
    rows = [(i, base if i % 3 == 0 else [float(x) for x in rng.normal(size=8)]) for i in range(150)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    ids = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    want = _brute_topk(ids, m, 4)
    got = {}
    for r in similarity.top_neighbors(e, "vec_id", "embedding", k=4, pivots=5, block_rows=16).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbor))
    got = {i: [n for _, n in sorted(v)] for i, v in got.items()}
    copies = [i for i in range(150) if i % 3 == 0]
    for i in copies:
        assert got[i] == [c for c in copies if c != i][:4]
    assert got == want


def test_representatives_and_assign(spark):
    e = _emb(spark, SF_MID)
    reps = vectors.representatives(e, "label", "embedding", "vec_id", 3)
    assert reps.groupBy("label").count().where("count > 3").count() == 0
    ids, centers = vectors.collect_centers(vectors.centroids(e, "label", "embedding"), "label")
    lab = vectors.assign_nearest(e, "embedding", centers, ids).collect()
    vec = {r.vec_id: np.array(r.embedding) for r in e.collect()}
    c = np.array(centers)
    for r in lab[:100]:
        d = ((c - vec[r.vec_id]) ** 2).sum(axis=1)
        assert ids[int(np.argmin(d))] == r.cluster


def test_clamp_k():
    assert clamp_k(10, 5) == 5
    assert clamp_k(4, 5) == 3
    assert clamp_k(2, 5) == 2
    assert clamp_k(1, 5) == 1
    with pytest.raises(ValueError):
        clamp_k(0, 5)


def test_kmeans_invariants(spark):
    e = _emb(spark, SF_MID)
    res = kmeans(e, "embedding", "vec_id", k=5, restarts=3)
    assert res.cost == min(res.costs)
    assert res.converged and len(res.iterations) == 3 and max(res.iterations) < 300
    assert not kmeans(e, "embedding", "vec_id", k=5, restarts=1, max_iter=2).converged
    labels = res.labels.collect()
    assert len(labels) == e.count()
    assert {r.cluster for r in labels} <= set(range(res.k))
    # every vector is in its nearest centre
    c = np.array(res.centers)
    vec = {r.vec_id: np.array(r.embedding, dtype=float) for r in e.collect()}
    for r in labels:
        d = ((c - vec[r.vec_id]) ** 2).sum(axis=1)
        assert np.isclose(d[r.cluster], d.min())
    # labels ordered by smallest member id
    firsts = {}
    for r in labels:
        firsts[r.cluster] = min(firsts.get(r.cluster, 1 << 62), r.vec_id)
    assert [firsts[k] for k in sorted(firsts)] == sorted(firsts.values())
    assert kmeans_cost(e, "embedding", res.centers) == pytest.approx(res.cost, rel=1e-6)
    # same layout, same result
    res2 = kmeans(e, "embedding", "vec_id", k=5, restarts=3)
    assert res2.costs == pytest.approx(res.costs)


@pytest.mark.parametrize("n", [1, 2, 4, 6])
def test_kmeans_small_inputs(spark, n):
    rows = [(i, [float(i % 3), 1.0]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    res = kmeans(df, "v", "id", k=5, restarts=2)
    labels = res.labels.collect()
    assert len(labels) == n
    assert res.k == len(res.centers) <= max(1, n)


def test_kmeans_identical_vectors(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(6)], "id long, v array<double>")
    res = kmeans(df, "v", "id", k=3, restarts=1)
    assert {r.cluster for r in res.labels.collect()} <= set(range(res.k))


def test_project_2d_variance_order(spark):
    e = _emb(spark, SF_MID)
    xy = vectors.project_2d(e, "embedding", ["vec_id"]).agg(F.variance("x").alias("vx"), F.variance("y").alias("vy")).first()
    assert xy.vx >= xy.vy


def test_embed_tfidf_unit_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    v = vectors.embed_tfidf(docs, "text", ["doc_id"], num_features=256)
    norms = [float(np.linalg.norm(r.embedding)) for r in v.collect()]
    assert all(abs(x - 1.0) < 1e-9 or x == 0.0 for x in norms)


def test_cosine_pairs_hot_pivot_matches_brute_force(spark):
    # a third of the rows are near-copies of one vector: one pivot partition is hot and is cut
    # into many sub-blocks; every qualifying pair must still be found exactly once
    rng = np.random.default_rng(7)
    base = rng.normal(size=16)
    hot = [base + 0.01 * rng.normal(size=16) for _ in range(120)]
    rest = [rng.normal(size=16) for _ in range(240)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(hot + rest)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    ids = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = m @ m.T
    t = 0.6
    want = {(int(ids[a]), int(ids[b])) for a in range(len(ids)) for b in range(a + 1, len(ids)) if sims[a, b] >= t}
    got = [(r.i, r.j) for r in similarity.cosine_pairs(e, "vec_id", "embedding", t, pivots=6, block_rows=16).collect()]
    assert len(got) == len(set(got))
    near = {(int(ids[a]), int(ids[b])) for a in range(len(ids)) for b in range(a + 1, len(ids)) if abs(sims[a, b] - t) < 1e-9}
    assert set(got) - near == want - near
    assert len(want) >= 120 * 119 // 2  # the hot group's pairs are all there


def test_embed_injected_model_batches_and_alignment(spark):
    def factory():
        def model(texts):
            assert len(texts) <= 4  # fed in batches of at most `batch` texts
            return [[float(len(t)), float(t.count("a"))] for t in texts]
        return model

    df = spark.createDataFrame([(i, "a" * (i % 5) + "b" * i) for i in range(50)], "id long, text string").repartition(3)
    got = {r.id: r.embedding for r in vectors.embed(df, "text", factory, ["id"], batch=4).collect()}
    assert got == {i: [float(i % 5 + i), float(i % 5)] for i in range(50)}


def test_top_neighbors_pruned_path_on_clustered_data(spark, monkeypatch):
    # tight, well separated groups: the pivots prune, so the pruned path must run (no fallback)
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(6, 8)) * 5
    rows = [(i, [float(x) for x in centers[i % 6] + 0.05 * rng.normal(size=8)]) for i in range(300)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)

    def no_fallback(*a, **kw):
        raise AssertionError("pruning should have been effective")

    monkeypatch.setattr(similarity, "_top_neighbors_direct", no_fallback)
    ids = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    got = {}
    for r in similarity.top_neighbors(e, "vec_id", "embedding", k=3, pivots=12, block_rows=20).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbor))
    assert {i: [n for _, n in sorted(v)] for i, v in got.items()} == _brute_topk(ids, m, 3)


def test_cosine_pairs_pruned_path_on_clustered_data(spark, monkeypatch):
    # tight, well separated groups: each vector reaches few pivots, so the pivot partitions are used
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(8, 8)) * 5
    rows = [(i, [float(x) for x in centers[i % 8] + 0.05 * rng.normal(size=8)]) for i in range(320)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    seen = []
    real = similarity._counts

    def recording(df, part):
        out = real(df, part)
        seen.append(out)
        return out

    monkeypatch.setattr(similarity, "_counts", recording)
    ids = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = m @ m.T
    t = 0.95
    want = {(int(ids[a]), int(ids[b])) for a in range(len(ids)) for b in range(a + 1, len(ids)) if sims[a, b] >= t}
    got = [(r.i, r.j) for r in similarity.cosine_pairs(e, "vec_id", "embedding", t, pivots=24, block_rows=20).collect()]
    assert seen and sum(c * c for c in seen[0].values()) < len(rows) ** 2  # the pivots pruned
    assert len(got) == len(set(got)) and set(got) == want


def test_tfidf_weights_by_hand(spark):
    import math

    from lectern.operators.vectors import tfidf_weights

    texts = {1: "Été été plage", 2: "plage, PLAGE; mer", 3: "", 4: None, 5: "mer"}
    df = spark.createDataFrame(list(texts.items()), "id long, t string")
    got = {(r.id, r.term): (r.tf, r.weight) for r in tfidf_weights(df, "t", "id").collect()}
    counts = {1: {"été": 2, "plage": 1}, 2: {"plage": 2, "mer": 1}, 5: {"mer": 1}}
    df_of = {"été": 1, "plage": 2, "mer": 2}
    assert set(got) == {(d, t) for d, c in counts.items() for t in c}
    for d, c in counts.items():
        w = {t: n * math.log(6 / (df_of[t] + 1)) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t, n in c.items():
            assert got[d, t][0] == n and got[d, t][1] == pytest.approx(w[t] / norm)


def test_similarity_of_string_ids(spark):
    from lectern.operators.similarity import cosine_pairs, top_neighbors

    e = _emb(spark, SF_SMALL)
    named = e.withColumn("name", F.concat(F.lit("file-"), F.lpad(F.col("vec_id").cast("string"), 6, "0")))
    for rows in (4096, 24):  # one block, and many blocks with pivots
        a = {(f"file-{r.i:06d}", f"file-{r.j:06d}") for r in cosine_pairs(e, "vec_id", "embedding", 0.3, block_rows=rows).collect()}
        assert a and a == {(r.i, r.j) for r in cosine_pairs(named, "name", "embedding", 0.3, block_rows=rows).collect()}
        b = {(f"file-{r.id:06d}", f"file-{r.neighbor:06d}", r["rank"]) for r in top_neighbors(e, "vec_id", "embedding", 2, block_rows=rows).collect()}
        assert b == {(r.id, r.neighbor, r["rank"]) for r in top_neighbors(named, "name", "embedding", 2, block_rows=rows).collect()}


def test_blocks_and_what_is_shuffled_grow_with_the_input():
    assert [similarity.block_count(n, 2048) for n in (0, 1, 2048, 2049, 65_536)] == [1, 1, 1, 2, 32]
    for n in (100_000, 600_000, 2_000_000):  # copies of a row
        assert similarity.block_count(n, 2048) == similarity.MOST_BLOCKS
    assert similarity.block_count(10_000_000, 2048) == -(-10_000_000 // similarity.MOST_ROWS)  # a task's blocks stay bounded


def test_topk_rows_of_strips_takes_equal_ones_by_id(monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(5)
    v = rng.integers(-1, 2, size=(90, 3)).astype(float)  # many equal products
    a = pd.DataFrame({"id": rng.permutation(90), "v": list(v)})
    b = a.iloc[10:].reset_index(drop=True)
    want = []
    for i, x in zip(a["id"], a["v"], strict=True):
        near = sorted((-float(x @ y), j) for j, y in zip(b["id"], b["v"], strict=True) if i != j)
        want.append([(i, j, -s) for s, j in near])
    monkeypatch.setattr(similarity, "STRIP", 7)
    for k in (1, 4, 32, 50, 200):
        got = similarity.topk_rows(a, b, k)
        assert [tuple(r) for r in got.itertuples(index=False)] == [r for near in want for r in near[:k]]
    assert similarity.topk_rows(a, b.iloc[:0], 3) is None
