from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from lectern.llm.periodic_runs import digest, maximal_repetitions, periodic_runs
from lectern.llm.queries import repeated_words

from .helpers import SF, awkward, frames, prose, same_rows, words


def runs(w: list) -> list[tuple[int, int, int]]:
    """By periods: every stretch in which words q apart agree, that no smaller period explains."""
    out = {}
    x = np.unique(np.array(w), return_inverse=True)[1] if w else np.zeros(0)
    for q in range(1, len(w) // 3 + 1):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]]).astype(np.int8)
        for a, z in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1), strict=True):
            if z - a + q >= max(24, 3 * q):
                out.setdefault((int(a), int(z - a + q)), q)
    return sorted(((a, n, q) for (a, n), q in out.items()), key=lambda r: (r[0], r[2]))


def planted(d: int | None, w: list[str]) -> list[str]:
    h = zlib.crc32(str(d).encode()) if d is not None else 1
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def brute(rows: list[tuple], plant: bool = True) -> list[tuple]:
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for d, t in rows:
        w = planted(d, words(t)) if plant else words(t)
        found = runs(w)
        gone = {i for a, n, q in found for i in range(a + q, a + n)}
        best = (None,) * 4
        for a, n, q in found:
            if best[0] is None or n * best[2] > best[1] * q:
                best = (a, n, q, 1000 * n // q)
        out.append((d, len(found), *best, sha("".join(f"{a},{n},{q}\n" for a, n, q in found)),
                    sha(" ".join(x for i, x in enumerate(w) if i not in gone)), len(w)))
    return out


def result(docs, plant: bool = True) -> list[tuple]:
    return [tuple(r) for r in digest(periodic_runs(repeated_words(docs) if plant else docs)).collect()]


def test_awkward_rows(spark):
    docs, clashing, empty = frames(spark)
    rows = [(i, t) for i, t, *_ in awkward() if i != 9]
    want = brute(rows, False)
    assert same_rows(want, result(docs.where("doc_id is null or doc_id <> 9"), False))
    assert same_rows(want, result(clashing.where("doc_id is null or doc_id <> 9"), False))
    assert same_rows(brute(rows), result(docs.where("doc_id is null or doc_id <> 9")))
    assert result(empty) == []
    long = result(docs.where("doc_id = 9"), False)[0]
    assert long[1:6] == (1, 0, 30_000, 1, 30_000_000)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert same_rows(brute([tuple(r) for r in docs.collect()]), result(docs))


def test_nested_and_neighbouring_runs(spark):
    a, b = prose(7, 1), prose(9, 2)
    inner = " ".join(["x"] * 24 + ["y"])
    rows = [
        (1, " ".join([a] * 4)), (2, f"q {' '.join([a] * 5)} {' '.join(a.split()[:3])} r"), (3, " ".join([inner] * 4)), (4, " ".join([a] * 3 + [b] * 3)),
        (5, " ".join(["x y"] * 12)), (6, " ".join(["x y"] * 11 + ["x"])), (7, " ".join([prose(8, 3)] * 3)), (8, " ".join([prose(8, 3)] * 2 + [prose(8, 3).rsplit(" ", 1)[0]])),
        (9, " ".join([" ".join([a] * 4), b] * 3)), (10, " ".join(["x"] * 500)), (11, " ".join(["x y x z"] * 30 + ["x y"] * 30)), (12, f"{a} " * 40),
        (13, " ".join([prose(40, 5)] * 3)), (14, " ".join([prose(40, 5)] * 2)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert same_rows(brute(rows, False), result(docs, False))


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_short_sequences_of_few_letters(letters):
    rng = np.random.default_rng(letters)
    for k in range(150):
        parts = [np.tile(rng.integers(0, letters, rng.integers(1, 12)), rng.integers(1, 9)) for _ in range(rng.integers(1, 6))]
        w = np.concatenate(parts)
        assert sorted(maximal_repetitions(np.append(w + 1, 0)), key=lambda r: (r[0], r[2])) == runs(list(w)), (k, w)


def test_words_that_structured_sums_confuse(spark):
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    words_ = ["".join("ab"[b ^ c] for b in bits) for c in (0, 1)]
    text = " ".join(words_[i % 2] for i in range(30))
    got = [r["runs"] for r in periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()]
    assert [[tuple(r) for r in x] for x in got] == [[(0, 30, 2)]]
