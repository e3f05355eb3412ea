from __future__ import annotations

import os
import uuid

import counting
import pytest
from counting import CountingModel, DyingModel
from pyspark import cloudpickle

from lectern.operators.answers import AnswerStore, infer_stored
from lectern.operators.inference import EchoModel, infer
from lectern.plans.extract import extract_records

cloudpickle.register_pickle_by_value(counting)  # tasks cannot import test modules
FREE = dict(retries=2, multiplier=0.0, cap=0.0, pause=0.0)


def rows(df):
    return sorted(map(str, df.collect()))


def prompts(spark, n=60):
    data = [(i, f"prompt {i % 40} " + "x" * (i % 7)) for i in range(n)] + [(1000, None), (1001, "")]
    return spark.createDataFrame(data, "id long, prompt string").repartition(4)


def test_same_rows_as_infer_and_no_call_twice(spark, tmp_dir):
    df = prompts(spark)
    calls = os.path.join(tmp_dir, "calls")
    store = AnswerStore(spark, os.path.join(tmp_dir, "store"), "echo 1")
    model = CountingModel(calls)
    got = infer_stored(df, "prompt", model, ["id"], store, wave_calls=7, **FREE)
    want = infer(df, "prompt", EchoModel(flaky_every=0), ["id"], **FREE)
    assert rows(got) == rows(want)
    distinct = {r["prompt"] for r in df.collect()} - {None}
    failing = {p for p in distinct if len(p) % 11 == 0}
    assert model.calls() == len(distinct) + len(failing)  # a failing prompt is tried twice
    again = infer_stored(df, "prompt", model, ["id"], store, **FREE)
    assert rows(again) == rows(want)
    assert model.calls() == len(distinct) + 3 * len(failing)
    # another model's answers are not this one's
    other = AnswerStore(spark, store.path, "echo 2")
    assert other.read().join(df.select(other.key("prompt").alias("prompt_key")), "prompt_key").count() == 0
    assert store.read().count() == len(distinct) - len(failing)


def test_a_run_that_died_is_taken_up_where_it_stopped(spark, tmp_dir):
    df = prompts(spark)
    calls = os.path.join(tmp_dir, "calls")
    store = AnswerStore(spark, os.path.join(tmp_dir, "store"), "echo")
    with pytest.raises(Exception, match="died|Died|aborted"):
        infer_stored(df, "prompt", DyingModel(calls, after=25), ["id"], store, wave_calls=5, partitions=1, **FREE).collect()
    kept = store.read().count()
    assert 10 <= kept < 30
    distinct = {r["prompt"] for r in df.collect()} - {None}
    failing = {p for p in distinct if len(p) % 11 == 0}
    model = CountingModel(os.path.join(tmp_dir, "calls2"))
    got = infer_stored(df, "prompt", model, ["id"], store, wave_calls=5, **FREE)
    assert rows(got) == rows(infer(df, "prompt", EchoModel(flaky_every=0), ["id"], **FREE))
    assert model.calls() == len(distinct) - kept + len(failing)


def test_answers_bought_twice_are_read_once(spark, tmp_dir):
    store = AnswerStore(spark, tmp_dir + "/" + uuid.uuid4().hex, "m")
    one = spark.createDataFrame([("p",)], "p string").select(store.key("p").alias("prompt_key"))
    for attempts in (2, 1):
        store.add(one.selectExpr("prompt_key", "'answer' AS response", f"{attempts} AS attempts"))
    assert [(r.response, r.attempts) for r in store.read().collect()] == [("answer", 1)]


def test_records_from_a_store(spark, tmp_dir):
    docs = spark.createDataFrame([(f"f{i}", " ".join(f"word{(i * k) % 17}" for k in range(40 + i))) for i in range(12)] + [("none", "")], "filename string, text string")
    calls = os.path.join(tmp_dir, "calls")
    store = AnswerStore(spark, os.path.join(tmp_dir, "store"), "records")
    from lectern.operators.inference import RecordModel

    plain = extract_records(docs, RecordModel(), multiplier=0.0, cap=0.0, pause=0.0)
    model = CountingModel(calls, RecordModel())
    first = extract_records(docs, model, multiplier=0.0, cap=0.0, pause=0.0, store=store, wave_calls=4)
    assert rows(first) == rows(plain)
    spent = model.calls()
    second = extract_records(docs, model, retries=1, multiplier=0.0, cap=0.0, pause=0.0, store=store)
    assert rows(second) == rows(plain)
    failed = plain.where("extraction_status = 'error'").count()
    assert model.calls() - spent <= failed + 1  # only what failed is asked again
