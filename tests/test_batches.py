from __future__ import annotations

import json

import pytest

from lectern.operators.profile import group_records
from lectern.operators.references import group_running


def data(spark):
    sizes = [3, 10, 200, 5, 5, 90, 1, 400, 2, 2, 2, 60, 60, 60, 7]
    rows = [("hot", i, "x" * sizes[i % 15], None if i % 4 else "y") for i in range(900)]
    rows += [("cold", i, "z" * (i % 9), "é" * (i % 3)) for i in range(7)] + [(None, 1, "n", None), (None, 2, "n" * 500, None)]
    return spark.createDataFrame(rows, "c string, o long, t string, u string").repartition(5), rows


@pytest.mark.parametrize("bound", [40, 300, 1000, 10_000_000])
def test_batches_are_bounded_consecutive_and_whole(spark, bound):
    df, rows = data(spark)
    got = group_records(df, "c", "o", ["t", "u"], batch_rows=50, batch_bytes=bound).collect()
    for c in ("hot", "cold", None):
        mine = sorted((r for r in got if r["c"] == c), key=lambda r: r["batch"])
        assert [r["batch"] for r in mine] == list(range(len(mine)))
        assert [x["o"] for r in mine for x in r["records"]] == sorted(r[1] for r in rows if r[0] == c)
        assert {r["size"] for r in mine} == {sum(r[0] == c for r in rows)}
        for r in mine:
            text = json.dumps([{k: v for k, v in x.asDict().items() if v is not None} for x in r["records"]], separators=(",", ":"), ensure_ascii=False)
            assert len(r["records"]) <= 50 and (len(text.encode()) <= bound or len(r["records"]) == 1)
        if bound == 1000:  # and not needlessly small: two neighbours that are not single long records pass half the bound
            sizes = [sum(len(json.dumps({k: v for k, v in x.asDict().items() if v is not None}, separators=(",", ":"))) + 1 for x in r["records"]) for r in mine]
            assert sum(a + b < 499 for a, b in zip(sizes, sizes[1:], strict=False)) <= len(mine) // 5


def test_running_sums(spark):
    df, rows = data(spark)
    got = group_running(df.selectExpr("c", "o", "length(t) AS w", "1L AS one"), ["c"], "o", {"before": "w", "pos": "one"}, partitions=9).collect()
    for c in ("hot", "cold", None):
        total = 0
        for k, r in enumerate(sorted((r for r in got if r["c"] == c), key=lambda r: r["o"])):
            assert (r["before"], r["pos"]) == (total, k)
            total += r["w"]
    assert len(got) == len(rows)
