from __future__ import annotations

import math
from collections import Counter, defaultdict

from lectern.llm.mixing import mix_sources

from .helpers import frames, prose, same_rows, words

COLUMNS = "doc_id long, text string, source string"


def exponent(tokens: list[int], entropy: float, repeats: float, budget: float) -> float:
    """The smallest exponent on a fine grid that meets both limits, 1 if none does."""
    total = sum(tokens)
    for i in range(20_001):
        x = i / 20_000
        w = [(n / total) ** x for n in tokens]
        z = sum(w)
        h = -sum(v / z * math.log(v / z) for v in w)
        if h < entropy * math.log(len(tokens)) and all(budget * v / z / n <= repeats for v, n in zip(w, tokens, strict=True)):
            return x
    return 1.0


def corpus(spark, sizes: dict[str, int]):
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, prose(20 + i % 13, i), s))
            i += 1
    return spark.createDataFrame(rows, COLUMNS).repartition(4), rows


def check(out, rows, entropy, repeats, budget=None):
    n = Counter()
    for _, t, s in rows:
        n[s] += len(words(t))
    total = sum(n.values())
    budget = budget or total
    x = exponent(list(n.values()), entropy, repeats, budget)
    z = sum((v / total) ** x for v in n.values())
    want = {s: (v / total) ** x / z for s, v in n.items()}
    got, weights, epochs = Counter(), {}, defaultdict(Counter)
    for r in out:
        got[r.source] += r.n_tokens * r.n_rows
        weights[r.source] = r.weight
        epochs[r.source, r.epoch][r.doc_id] += 1
    longest = max(len(words(t)) for _, t, _ in rows)
    for s, w in weights.items():
        assert abs(w - want[s]) < 1e-3
        assert got[s] <= round(w * budget) + 1 and got[s] > w * budget - longest - 2
    docs = Counter(s for _, _, s in rows)
    for (s, e), c in epochs.items():
        assert max(c.values()) == 1
        if e < max(k for t, k in epochs if t == s):
            assert len(c) == docs[s]  # whole epochs hold every document
    return x


def test_target_entropy(spark):
    docs, rows = corpus(spark, {"big": 300, "mid": 60, "small": 30, "tiny": 10})
    assert 0 < check(mix_sources(docs, entropy=0.8, repeats=50.0).collect(), rows, 0.8, 50.0) < 1


def test_repetition_limit_binds(spark):
    docs, rows = corpus(spark, {"big": 300, "mid": 60, "small": 30, "tiny": 10})
    loose = exponent([1], 1, 1, 1)
    assert loose == 1.0
    assert check(mix_sources(docs, entropy=0.95, repeats=2.0).collect(), rows, 0.95, 2.0) > 0.5


def test_even_sources_stay_whole(spark):
    docs, rows = corpus(spark, {"a": 50, "b": 50, "c": 50})
    out = mix_sources(docs).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _, _ in rows)


def test_budgets(spark):
    docs, rows = corpus(spark, {"big": 120, "small": 40})
    for budget in (200, 1000, 12_000):
        check(mix_sources(docs, entropy=0.9, repeats=100.0, budget=budget).collect(), rows, 0.9, 100.0, budget)


def test_epochs_are_different_permutations(spark):
    docs, _ = corpus(spark, {"big": 400, "small": 60})
    out = mix_sources(docs, entropy=0.99, repeats=10.0).where("source = 'small'").collect()
    order = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.epoch, r.block_order, r.block, r.row_order)):
        order[r.epoch].append(r.doc_id)
    assert len(order) > 2 and order[0] != order[1] and sorted(order[0]) == sorted(order[1])
    again = mix_sources(docs.repartition(7), entropy=0.99, repeats=10.0).where("source = 'small'").collect()
    assert same_rows(out, again)
    assert not same_rows(out, mix_sources(docs, entropy=0.99, repeats=10.0, seed=1).where("source = 'small'").collect())


def test_awkward_rows(spark):
    docs, clashing, empty = frames(spark)
    out = mix_sources(docs, entropy=0.9).collect()
    assert same_rows(out, mix_sources(clashing, entropy=0.9).collect())
    assert None in {r.source for r in out}
    assert mix_sources(empty).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "x y", "b")], COLUMNS)
    assert [(r.doc_id, r.epoch) for r in mix_sources(blank).collect()] == [(3, 0)]
    twice = spark.createDataFrame([(1, "x y z", "a")] * 2 + [(2, "x y", "b")], COLUMNS)
    assert {(r.doc_id, r.n_rows) for r in mix_sources(twice, entropy=0.5).collect()} == {(1, 2), (2, 1)}
