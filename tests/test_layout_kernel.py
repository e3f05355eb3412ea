"""Best neighbours by a bound in single precision: the same as from all products; sums of a layout's passes in compiled code."""

import numpy as np
import pandas as pd
import pytest

import lectern.operators.layout as layout
import lectern.operators.similarity as similarity


def table(x, first=0):
    return pd.DataFrame({"id": np.arange(first, first + len(x)), "v": list(x)})


@pytest.mark.parametrize("k", [1, 3, 10])
def test_bounded_neighbours_are_those_of_all_products(monkeypatch, k):
    rng = np.random.default_rng(k)
    x = rng.normal(size=(1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[200:230], x[7], x[300] = x[200], 0.0, x[301] * (1 - 1e-13)  # ties go to the smaller id
    x[400:800] = x[400] + 1e-9 * rng.normal(size=(400, 24))  # nearer to each other than single precision tells
    left, right = table(x[:900]), table(x).sample(frac=1, random_state=2)
    right = pd.concat([right, right.iloc[:3]])  # repeated ids
    taken = []
    monkeypatch.setattr(similarity, "_topk_bounded", lambda *a, f=similarity._topk_bounded: taken.append(1) or f(*a))
    got = similarity.topk_rows(left, right, k)
    b = right.sort_values("id", kind="stable")
    rows, cols, vals = similarity._topk_whole(np.vstack(left["v"]), np.vstack(b["v"]), left["id"].to_numpy(), b["id"].to_numpy(), k)
    assert taken and got["id"].tolist() == left["id"].to_numpy()[rows].tolist() and len(got) == 900 * k
    assert np.abs(got["sim"].to_numpy() - vals).max() <= 2e-12
    other = got["neighbor"].to_numpy() != b["id"].to_numpy()[cols]
    # numbers that rounding puts on either side
    assert other.mean() < 0.35 and not other[(got["id"].to_numpy() < 400)].any()


def test_a_layout_keeps_the_tables_of_one_pass(spark, monkeypatch):
    made, gone = [], []
    monkeypatch.setattr(layout, "cut_lineage", lambda df, name="cut", f=layout.cut_lineage: made.append(name) or f(df, name))
    monkeypatch.setattr(layout, "discard", lambda *t, f=layout.discard: gone.extend(t) or f(*t))
    n = 40
    edges = spark.createDataFrame([(i, j) for i in range(n) for j in ((i + 1) % n, (i - 1) % n)], "i long, j long")
    out = layout.spectral_layout(edges)
    assert out.converged and out.points.count() == n
    assert made.count("pass") - len(gone) <= 1 and len(gone) >= 1
