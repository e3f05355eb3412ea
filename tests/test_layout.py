"""The neighbour layout against dense eigenvectors by numpy, and against PCA."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lectern.operators import layout
from lectern.operators.layout import TOLERANCE, neighbor_graph, neighbor_layout, spectral_layout
from lectern.operators.similarity import top_neighbors
from lectern.operators.vectors import project_2d


def _walk(edges: pd.DataFrame):
    """(ids, S, degrees) of the graph, dense."""
    ids = np.unique(edges["i"])
    a = np.zeros((len(ids), len(ids)))
    a[np.searchsorted(ids, edges["i"]), np.searchsorted(ids, edges["j"])] = 1.0
    d = a.sum(1)
    return ids, a / np.sqrt(np.outer(d, d)), d


def _grouped_vectors(spark, n=240, groups=6, dim=16):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(groups, dim))
    # groups on a ring, overlapping with the next one
    x = np.array([centres[i % groups] + (i / n) * centres[(i + 1) % groups] for i in range(n)]) + 0.4 * rng.normal(size=(n, dim))
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")


def _preserved(xy: np.ndarray, near: set, k: int) -> float:
    d = ((xy[:, None] - xy[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    found = {(i, int(j)) for i in range(len(xy)) for j in np.argsort(d[i], kind="stable")[:k]}
    return len(found & near) / len(near)


def test_equals_dense_eigenvectors(spark):
    x, df = _grouped_vectors(spark)
    near = top_neighbors(df, "id", "v", 6)
    out = neighbor_layout(df, "id", "v", k=6)
    assert out.converged and max(out.residuals) <= TOLERANCE
    edges = neighbor_graph(near).toPandas()
    ids, s, d = _walk(edges)
    values = np.linalg.eigvalsh(s)[::-1]
    np.testing.assert_allclose(out.values, values[1:3], atol=TOLERANCE)
    points = out.points.toPandas().sort_values("id")
    assert points["id"].tolist() == ids.tolist() and points["degree"].tolist() == d.astype(int).tolist()
    for c, value in zip(("x", "y"), out.values, strict=True):
        v = points[c].to_numpy() * np.sqrt(d / d.sum())  # unit vector
        assert abs(v @ v - 1) < 1e-9 and abs(v @ np.sqrt(d)) < 1e-6
        assert np.linalg.norm(s @ v - value * v) <= 2 * TOLERANCE
        assert points[c].iloc[points[c].abs().argmax()] > 0
    assert abs((points["x"] * points["y"] * d).sum()) / d.sum() < 1e-9


def test_keeps_neighbours_of_a_curved_sheet(spark):
    """Points of a rolled-up sheet, which a linear projection lays on top of each other."""
    rng = np.random.default_rng(5)
    turn, across = np.linspace(3, 12, 240), rng.uniform(0, 8, 240)
    x = np.stack([turn * np.cos(turn), across, turn * np.sin(turn)], 1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    pairs = {(i, int(j)) for i in range(len(x)) for j in np.argsort(d[i], kind="stable")[:6]}
    out = neighbor_layout(df, "id", "v", neighbors=spark.createDataFrame(sorted(pairs), "id long, neighbor long"))
    points, pca = out.points.toPandas().sort_values("id"), project_2d(df, "v", ["id"]).toPandas().sort_values("id")
    mine, other = (_preserved(p[["x", "y"]].to_numpy(), pairs, 6) for p in (points, pca))
    print("passes", out.passes, "neighbours kept", mine, "by PCA", other)
    assert out.converged and mine > other


def test_ring_with_small_gaps_needs_restarts(spark, monkeypatch):
    # the eigenvalues of a ring lie close together: many passes, and pairs of equal ones
    monkeypatch.setattr(layout, "SPACE", 41)
    n = 80
    ring = [(i, (i + s) % n) for i in range(n) for s in (1, n - 1)]
    out = spectral_layout(spark.createDataFrame(ring, "i long, j long"))
    assert out.converged and out.passes > 5  # the space is begun anew after five passes, at 41 vectors
    np.testing.assert_allclose(out.values, [np.cos(2 * np.pi / n)] * 2, atol=TOLERANCE)
    p = out.points.toPandas().sort_values("id")
    np.testing.assert_allclose(np.hypot(p["x"], p["y"]), np.sqrt(2), atol=0.2)  # a circle


@pytest.mark.parametrize(("edges", "n"), [([], 0), ([("a", "b")], 2), ([("a", "b"), ("b", "c")], 3), ([("a", "b"), ("c", "d"), ("e", "f")], 6)])
def test_small_graphs(spark, edges, n):
    near = spark.createDataFrame(edges, "id string, neighbor string")
    out = spectral_layout(neighbor_graph(near))
    rows = {r["id"]: r for r in out.points.collect()}
    assert len(rows) == n and out.converged
    assert all(np.isfinite([r["x"], r["y"]]).all() for r in rows.values())
    if n == 2:
        assert abs(rows["a"]["x"] + rows["b"]["x"]) < 1e-9 and rows["a"]["y"] == 0
    if n == 6:  # parts that hang together by nothing: one point each, apart
        at = [np.array([rows[c]["x"], rows[c]["y"]]) for c in "abcdef"]
        assert all(np.allclose(at[i], at[i + 1], atol=1e-6) for i in (0, 2, 4))
        assert min(np.linalg.norm(at[i] - at[j]) for i in (0, 2, 4) for j in (0, 2, 4) if i < j) > 0.1


def test_loops_repeats_and_a_hub(spark):
    # everything is joined to one node, some edges are given twice, one node to itself
    rows = [(0, i) for i in range(1, 60)] + [(1, 2), (1, 2), (2, 1), (3, 3)]
    near = spark.createDataFrame(rows, "id long, neighbor long").withColumn("sim", F.lit(1.0))
    edges = neighbor_graph(near)
    assert edges.count() == 2 * 60
    out = spectral_layout(edges)
    _, s, _ = _walk(edges.toPandas())
    np.testing.assert_allclose(out.values, np.linalg.eigvalsh(s)[::-1][1:3], atol=1e-4)
