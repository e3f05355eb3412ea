from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa

from lectern.llm.graph import components
from lectern.llm.near_dup import _prefix_pairs, near_duplicates, registers, similarity
from lectern.llm.words import mix, shingles as hashed, text_blocks

from .helpers import LONG, SF, awkward, frames, prose, same_rows, shingles, words


def brute(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n, component, kept) by all pairs that share a shingle; rows without a doc_id stand alone."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    own = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            for g in sets[i]:
                own[g].append(i)
    shared: dict[tuple[int, int], int] = defaultdict(int)
    for at in own.values():
        for x in range(len(at)):
            for y in range(x):
                shared[at[y], at[x]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            parent[root(b)] = root(a)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), None if d is None else least[root(i)], d is None or least[root(i)] == d) for i, (d, _) in enumerate(rows)]


def result(df) -> list[tuple]:
    return [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()]


def test_words_and_blocks():
    texts = [t for _, t, *_ in awkward()] + ["a" * 3_000_000 + " b c " + "d" * 1_200_000, "x " * 700_000, LONG]
    seen = 0
    for lo, hi, w in text_blocks(pa.array(texts)):
        for d in range(hi - lo):
            assert [w.text(i).decode() for i in range(w.first[d], w.first[d + 1])] == words(texts[lo + d])
        seen += hi - lo
    assert seen == len(texts)


def test_awkward_rows(spark):
    docs, clashing, empty = frames(spark)
    want = brute([(i, t) for i, t, *_ in awkward()])
    assert same_rows(want, result(near_duplicates(docs)))
    assert same_rows(want, result(near_duplicates(clashing)))
    assert near_duplicates(empty).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert same_rows(brute([tuple(r) for r in docs.collect()]), result(near_duplicates(docs)))


def test_a_large_group_of_differing_copies(spark):
    """Copies at all distances from a base: many miss the threshold with the base but not with each other."""
    base = prose(150, 40, 5000).split()
    rows = [(1000, " ".join(base))]
    for k in range(160):
        w = list(base)
        for j in range(k % 17):
            w[(k * 31 + j * 9) % 150] = f"new{k % 9}-{j}"
        rows.append((1001 + k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert same_rows(brute(rows), result(near_duplicates(docs)))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    out = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert out == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sketch_merges_and_estimates():
    a, b = mix(np.arange(1, 1001, dtype=np.uint64)), mix(np.arange(251, 1251, dtype=np.uint64))
    first = np.array([0, 1000])
    ra, rb = registers(a, first, 160), registers(b, first, 160)
    both = np.union1d(a, b)
    assert (np.maximum(ra, rb) == registers(both, np.array([0, len(both)]), 160)).all()
    j, lost = similarity(ra, rb, np.array([1000.0]), np.array([1000.0]))
    assert abs(j[0] - 0.6) < 0.12 and lost[0] >= 0
    j, lost = similarity(ra, ra, np.array([1000.0]), np.array([1000.0]))
    assert j[0] > 0.99 and lost[0] == 0


def test_documents_of_few_words():
    w = next(text_blocks(pa.array(["a b c", "a b c d e", "a b c d e f", "", None])))[2]
    h, first = hashed(w, 5)
    assert list(np.diff(first)) == [1, 1, 2, 0, 0]
    assert h[1] == h[2] and h[0] != h[1]


def test_documents_that_repeat_a_number_with_other_texts(spark):
    a, b = prose(200, 21), prose(200, 22)
    rows = [(5, a), (5, b), (7, b + " more"), (8, a + " more"), (9, a), (3, prose(80, 23)), (3, b + " and more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert same_rows(brute(rows), result(near_duplicates(docs)))
    assert {r[0]: r[2] for r in result(near_duplicates(docs)) if r[0] > 6} == {7: 3, 8: 5, 9: 5}


def test_prefix_pairs_of_a_large_group_a_little_below_the_threshold(spark):
    """Copies with two words of 100 replaced each: 10 shingles differ on either side of a pair, and shared ones come early."""
    base = prose(104, 77).split()
    rows = []
    for k in range(150):
        w = list(base)
        w[5 + k % 45], w[55 + (k * 7) % 45] = f"one{k}", f"two{k}"
        rows.append((k, " ".join(w)))
    rows += [(k, f"{t} and more") for k, t in zip((150, 151), (rows[0][1], rows[1][1]))]
    sets = {k: shingles(t) for k, t in rows}
    number = {g: i for i, g in enumerate(sorted(set().union(*sets.values())))}
    df = spark.createDataFrame([(k, k, [number[g] for g in s]) for k, s in sets.items()], "id long, part long, grams array<long>")
    true = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    found = {tuple(r) for r in _prefix_pairs(df).collect()}
    assert {(0, 150), (1, 151)} <= true <= found
    assert len(found) <= 2 * len(true) + 300  # of 11,476 pairs
