from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

from lectern.llm import spelling
from lectern.llm.spelling import near_words, spelling_variants

from .helpers import SF, awkward, frames, lower, same_rows


def near(words) -> dict[str, set[str]]:
    """By what is left when one letter is blotted out or left out."""
    by = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by[w[:i] + "\0" + w[i + 1 :]].add(w)
    out = {w: set() for w in words}
    for group in by.values():
        for w in group:
            out[w] |= group - {w}
    for w in words:
        for i in range(len(w)):
            v = w[:i] + w[i + 1 :]
            if v in out:
                out[w].add(v)
                out[v].add(w)
    return out


def brute(rows: list[tuple], changed: int = 97) -> list[tuple]:
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if changed and h % changed == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 5:
                n[w] += 1
    n = {w: k for w, k in n.items() if k >= 3}
    around = near(n)
    form = {}
    for w in n:
        best = min(around[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return [(w, form[w], root(w), n[w], len(around[w]), n[form[w]] if form[w] else None) for w in n]


def result(docs, **kw) -> list[tuple]:
    return [tuple(r) for r in spelling_variants(docs, **kw).collect()]


def test_awkward_rows(spark):
    docs, clashing, empty = frames(spark)
    extra = [(50 + k, t) for k, t in enumerate(["Straße strasse STRASSE straße Strase École école ecole ×÷×÷× x×x×x"] * 9 + ["colour color colours colouur kolour " * 7] * 3)]
    rows = [(i, t) for i, t, *_ in awkward()] + extra
    more = spark.createDataFrame(extra, "doc_id long, text string")
    want = brute(rows)
    assert len(want) > 10 and any(w[1] for w in want)
    assert same_rows(want, result(docs.select("doc_id", "text").unionByName(more)))
    assert same_rows(want, result(clashing.unionByName(more, allowMissingColumns=True)))
    assert result(empty) == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    assert sum(1 for w in want if w[1]) > 100
    assert same_rows(want, result(docs))


def _pairs(spark, words: list[str]) -> set[tuple[str, str]]:
    return {(r["x"], r["y"]) for r in near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}


def test_leaves_with_many_words(spark):
    # anagrams of one another, their neighbours by each edit, and a very long word
    import itertools

    words = {"".join(p) for p in itertools.product("ab", repeat=11) if p.count("a") in (5, 6)}
    words |= {w[:4] + w[5:] for w in list(words)[:300]} | {w[:7] + "ÿ" + w[7:] for w in list(words)[:50]}
    words |= {w[:3] + c + w[4:] for w in list(words)[:200] for c in "gq"}
    words |= {"xyz" * 2_000, "xyz" * 2_000 + "x"}
    want = {(min(a, b), max(a, b)) for a, around in near(words - {w for w in words if len(w) > 1000}).items() for b in around}
    got = _pairs(spark, sorted(words))
    assert ("xyz" * 2_000, "xyz" * 2_000 + "x") in got
    assert {p for p in got if len(p[0]) < 1000} == want
    assert max(Counter(tuple(w.count(g) for g in "ab") for w in words).values()) > spelling.LEAF


def test_chains_of_forms(spark):
    text = " ".join(["abcdefg"] * 100 + ["abcdef"] * 40 + ["abcde"] * 12 + ["abxde"] * 4 + ["abxdez"] * 3)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert same_rows(brute([(1, text)], 0), result(docs, changed=0))
    assert {r[0]: r[2] for r in result(docs, changed=0)} == {"abcdefg": "abcdefg", "abcdef": "abcdefg", "abcde": "abcdefg", "abxde": "abcdefg", "abxdez": "abxdez"}
