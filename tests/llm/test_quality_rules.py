from __future__ import annotations

import re
from collections import Counter

from lectern.llm.quality_rules import host_rates, quality_rules

from .helpers import SF, awkward, frames, same_rows, words


def brute(text: str | None) -> tuple:
    w = words(text)
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if c[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def result(df) -> list[tuple]:
    return [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()]


def test_awkward_rows(spark):
    docs, clashing, empty = frames(spark)
    want = [(i, *brute(t)) for i, t, *_ in awkward()]
    assert same_rows(want, result(quality_rules(docs)))
    assert same_rows(want, result(quality_rules(clashing)))
    assert quality_rules(empty).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = quality_rules(docs)
    assert same_rows([(r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect()], result(out))
    assert out.where("kept and base_failed").isEmpty()


def test_shrunk_rates_by_hand(spark):
    counts = {"a": (40, 4), "b": (60, 3), "c": (2, 2), "d": (50, 45), None: (5, 5)}
    rows = spark.createDataFrame([(h, i < f) for h, (n, f) in counts.items() for i in range(n)], "host string, failed boolean")
    got = {r.host: r.shrunk for r in host_rates(rows, "host", "failed").collect()}
    real = {h: x for h, x in counts.items() if h}
    n = sum(x[0] for x in real.values())
    m = sum(x[1] for x in real.values()) / n
    v = sum(x[0] * (x[1] / x[0]) ** 2 for x in real.values()) / n - m * m
    k = m * (1 - m) / v - 1
    assert set(got) == set(real)
    assert all(abs(got[h] - (f + m * k) / (c + k)) < 1e-9 for h, (c, f) in real.items())
    assert 0.9 > got["d"] > got["c"] > 0.5 > got["a"] > 0.1


def test_a_bad_host_loses_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, f"{good} {i}", "fine") for i in range(200)] + [(1000 + i, "short", "bad") for i in range(90)] + [(2000, good, "bad"), (2001, good, None), (2002, good, "fine")]
    out = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not out[2000] and out[2001] and out[2002] and out[5] and not out[1000]


def test_hosts_that_fail_wholly_or_not_at_all(spark):
    for bad, good in ((70, 30), (700, 300), (2, 1), (90, 10), (30, 70), (50, 50)):
        rows = spark.createDataFrame([("bad", True)] * bad + [("good", False)] * good, "host string, failed boolean")
        got = {r.host: r.shrunk for r in host_rates(rows, "host", "failed").collect()}
        assert abs(got["bad"] - 1) < 1e-9 and abs(got["good"]) < 1e-9, (bad, good)
    same = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("b", False)], "host string, failed boolean")
    assert {r.shrunk for r in host_rates(same, "host", "failed").collect()} == {0.5}


def test_a_wholly_bad_host_costs_clean_hosts_nothing(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, "short", "bad") for i in range(70)] + [(100 + i, f"{good} {i}", f"fine{i % 3}") for i in range(30)]
    out = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(out[100 + i] for i in range(30)) and not any(out[i] for i in range(70))


def test_triples_that_agree_in_part_of_their_hash_are_no_repeats(spark):
    # the two triples "a b x..." agree in the 47 bits left beside a position in a text of 70,000 words
    filler = [f"f{i}" for i in range(70_000)]
    text = " ".join([*filler[:100], "a b x1716043", *filler[100:200], "r s t", *filler[200:300], "a b x6057582", *filler[300:400], "r s t", *filler[400:]])
    rows = [(1, text, "h"), (2, text + " a b x1716043", "h")]
    got = result(quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert same_rows(got, [(i, *brute(t)) for i, t, _ in rows])
    assert sorted(r[5] for r in got) == [6, 12]
