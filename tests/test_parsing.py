import pytest
import json
import re

from lectern.functions.core import SENTINEL
from lectern.functions.text import clean_json_envelope
from lectern.operators.parsing import merge_fields, merge_fields_grouped, normalize_keys, parse_object, render_value

RESPONSES = [
    'Here you go:\n```json\n{"a": "x", "b": 2}\n```\nThanks',
    "no braces at all",
    "",
    None,
    '{"a":1} tail }',
    '{"a":1}{"a":2}',
    '{"a":1},{"a":2}',
    "{'a': 1}",
    '{"a": 1,}',
    '{"a": ["p", "q"], "n": null}',
    '{"a": {"z": 1}}',
    'prefix {"unknown": "v"}\n',
    '{"a": "1"}\n\n',
]


def py_parse(text):
    """Reference behaviour: strip to the braces, strict json.loads, object only."""
    if text is None:
        return None
    t = re.sub(r"^[^{]*", "", text)
    t = re.sub(r"[^}]*$", "", t)
    try:
        obj = json.loads(t)
    except json.JSONDecodeError:
        return None
    return obj if isinstance(obj, dict) else None


def test_envelope_and_strict_parse(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(RESPONSES)], "i int, r string")
    rows = df.select("i", clean_json_envelope("r").alias("env"), parse_object(clean_json_envelope("r")).alias("obj")).collect()
    for row in rows:
        text = RESPONSES[row.i]
        if text is not None:
            want_env = re.sub(r"[^}]*$", "", re.sub(r"^[^{]*", "", text))
            assert row.env == want_env, text
        want = py_parse(text)
        if want is None:
            assert row.obj is None, text
        else:
            assert row.obj is not None, text
            assert set(row.obj) == set(want)
            for k, v in want.items():
                got = row.obj[k]
                if v is None:
                    assert got is None
                elif isinstance(v, str):
                    assert got == v
                else:
                    assert json.loads(got) == v


def test_render_list_values(spark):
    df = spark.createDataFrame([('["a", "b"]',), ("plain",), ("[not json",)], "v string")
    assert [r[0] for r in df.select(render_value("v")).collect()] == ["a, b", "plain", "[not json"]


def py_merge(values):
    """Sequential fold of the reference with a missing (not sentinel) start value."""
    acc = None
    for v in values:
        if v and v != SENTINEL:
            acc = "; ".join(filter(None, [acc, v])).strip("; ")
    return acc


MERGE_CASES = {
    1: [None, SENTINEL, ""],
    2: ["only"],
    3: ["a", "b", "c"],
    4: ["a;", "b; ", " c"],
    5: ["x", SENTINEL, "y"],
    6: ["; lead", ";;", "tail ;"],
    7: [" ;x", "y"],
}


@pytest.mark.parametrize("run", [1024, 2, 1])
def test_merge_matches_sequential_fold(spark, run):
    # run = 1 or 2 makes every document span several first-level runs
    rows = [(d, i, "f", v) for d, vals in MERGE_CASES.items() for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "d int, idx int, field string, value string")
    got = {r.d: r.f for r in merge_fields(df, "d", "idx", ["f"], run=run).collect()}
    for d, vals in MERGE_CASES.items():
        want = py_merge(vals)
        assert got.get(d) == (want or None), (d, vals)
    long = {(r.d, r.field): r.merged for r in merge_fields_grouped(df, "d", "idx", run=run).collect()}
    for d, vals in MERGE_CASES.items():
        want = py_merge(vals)
        assert long.get((d, "f")) == (want or None)


def test_merge_order_is_chunk_order(spark):
    df = spark.createDataFrame([(1, 3, "f", "c"), (1, 1, "f", "a"), (1, 2, "f", "b")], "d int, idx int, field string, value string")
    assert merge_fields(df, "d", "idx", ["f"]).first()["f"] == "a; b; c"


def test_normalize_keys(spark):
    df = spark.createDataFrame([("Datasets Used",), ("Dataset(s) Used",), ("other",)], "field string")
    from lectern.plans.extract import FIELD_ALIASES

    got = [r[0] for r in normalize_keys(df, FIELD_ALIASES).collect()]
    assert got == ["datasets", "datasets", "other"]
