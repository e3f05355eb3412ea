from __future__ import annotations

import hashlib
from collections import Counter

from lectern.llm import suffix_dedup
from lectern.llm.suffix_dedup import digest, remove_repeated_bytes

from .helpers import SF, awkward, frames, prose, same_rows

W = 200


def brute(rows: list[tuple]) -> list[tuple]:
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + W] for t in texts for i in range(len(t) - W + 1))
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t) + 1)
        upto = 0
        for i in range(len(t) - W + 1):
            if seen[t[i : i + W]] > 1:
                for k in range(max(i, upto), i + W):
                    gone[k] = 1
                upto = i + W
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((d, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(docs) -> list[tuple]:
    return [tuple(r) for r in digest(remove_repeated_bytes(docs)).collect()]


def test_awkward_rows(spark):
    docs, clashing, empty = frames(spark)
    want = brute([(i, t) for i, t, *_ in awkward()])
    assert same_rows(want, result(docs))
    assert same_rows(want, result(clashing))
    assert result(empty) == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert same_rows(brute([tuple(r) for r in docs.collect()]), result(docs))


def test_passages_in_changed_surroundings(spark):
    a, b, c = prose(60, 1), prose(45, 2), prose(200, 3)
    rows = [
        (1, f"{a} {b}"), (2, f"{b} {a}"), (3, f"xx {a} y {b} zz"), (4, f"{a} {a}"), (5, a[7:211]), (6, a[9:209]), (7, a[9:208]), (8, c), (9, c[3:500] + "!" + c[501:]),
        (10, "é" * 99 + c[100:299]), (11, "é" * 100), (12, "é" * 99 + "x"), (13, "ab" * 150), (14, "ba" * 99 + "b"), (15, "x" * 200), (16, "y" * 201),
    ]
    rows += [(100 + k, f"{prose(9, 50 + k)} {c[k : 400 + 7 * k]} {prose(12, 90 + k)}") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert same_rows(brute(rows), result(docs))


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 3000)
    a = prose(2500, 7, 5000)
    rows = [(1, a), (2, a[1000:9000]), (3, "q" + a[4000:4300]), (4, "zz " * 4000), (5, prose(50, 9) + " " + a[5990:6195])]
    # spark workers import the module afresh, so the parts are compared without Spark too
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(range(5)), pa.array([t for _, t in rows])], names=["ha", "hb", "text"])
    small = [r for x in suffix_dedup._first_digit(iter([batch])) for r in x.to_pylist()]
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 19)
    large = [r for x in suffix_dedup._first_digit(iter([batch])) for r in x.to_pylist()]
    flat = lambda rs: Counter((r["ha"], r["core"], r["span"], r["content"], p) for r in rs for p in r["pos"])
    assert flat(small) == flat(large)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert same_rows(brute(rows), result(docs))


def test_other_key_types(spark):
    t = prose(80, 1)
    out = remove_repeated_bytes(spark.createDataFrame([("u-1", t), ("u-2", t), ("u-3", "short")], "doc_id string, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == {"u-1": len(t), "u-2": len(t), "u-3": 0}
