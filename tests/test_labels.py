from __future__ import annotations

import math
import os
from collections import Counter

import counting
import pytest
from counting import CountingModel
from pyspark import cloudpickle

from lectern.operators.answers import AnswerStore
from lectern.operators.inference import RecordModel
from lectern.streaming.labels import fit_model, incremental_labels, label_batch, label_texts, labelled_records, load_model, store_model

cloudpickle.register_pickle_by_value(counting)
FREE = {"multiplier": 0.0, "cap": 0.0, "pause": 0.0}
TRAIN = [(0, "cats and dogs and cats"), (1, "dogs chase cats"), (2, "stocks and bonds"), (3, "bonds and rates rise"), (4, None)]


def model(spark, version, swap=False):
    labels = spark.createDataFrame([(i, int((i in (2, 3)) != swap)) for i in range(5)], "id long, cluster int")
    return fit_model(spark.createDataFrame(TRAIN, "id long, t string"), labels, "id", "t", version)


def test_labels_by_hand(spark):
    texts = [(10, "a cat and dogs"), (11, "bonds, stocks, new words"), (12, None), (13, "unknown"), (14, "rates of dogs")]
    got = {r["id"]: r["cluster"] for r in label_texts(spark.createDataFrame(texts, "id long, t string"), "id", "t", model(spark, 1)).collect()}
    n, df = len(TRAIN), Counter(w for _, t in TRAIN for w in set((t or "").split()))

    def vector(t):
        tf = Counter((t or "").replace(",", "").lower().split())
        v = {w: k * math.log((n + 1) / (df[w] + 1)) for w, k in tf.items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1
        return {w: x / size for w, x in v.items()}

    centres = []
    for group in ((0, 1, 4), (2, 3)):
        c = Counter()
        for i in group:
            for w, x in vector(TRAIN[i][1]).items():
                c[w] += x / len(group)
        centres.append(c)
    far = lambda v, c: sum((v.get(w, 0) - c.get(w, 0)) ** 2 for w in {*v, *c})
    assert got == {i: min((0, 1), key=lambda k: (far(vector(t), centres[k]), k)) for i, t in texts}


def test_versions(spark, tmp_dir):
    with pytest.raises(ValueError):
        load_model(spark, os.path.join(tmp_dir, "none"))
    store_model(model(spark, 1), tmp_dir)
    store_model(model(spark, 3, swap=True), tmp_dir)
    with pytest.raises(ValueError):
        store_model(model(spark, 3), tmp_dir)
    assert load_model(spark, tmp_dir).version == 3 and load_model(spark, tmp_dir, 1).n == 5
    with pytest.raises(ValueError):
        load_model(spark, tmp_dir, 2)


def test_a_batch_tried_again_changes_nothing(spark, tmp_dir):
    models, sink, source, log = (os.path.join(tmp_dir, x) for x in ("models", "sink", "source", "log"))
    store_model(model(spark, 1), models)
    docs = [(f"f{i}", " ".join([("cats dogs", "stocks bonds")[i % 2]] * (4 + i))) for i in range(9)] + [("blank", "")]
    schema = "filename string, text string"
    spark.createDataFrame(docs[:5], schema).coalesce(1).write.mode("append").parquet(source)
    spark.createDataFrame(docs[5:], schema).coalesce(1).write.mode("append").parquet(source)
    store = AnswerStore(spark, os.path.join(tmp_dir, "store"), "records")
    fn = CountingModel(os.path.join(tmp_dir, "calls"), RecordModel(fail_every=0))
    calls = {**FREE, "store": store}
    run = lambda: incremental_labels(spark, source, spark.createDataFrame([], schema).schema, sink, log, models, fn, calls=calls, max_files_per_trigger=1)
    run()
    first = sorted(map(str, labelled_records(spark, sink).collect()))
    assert len(first) == 9 and {r["model_version"] for r in labelled_records(spark, sink).collect()} == {1}
    spent = fn.calls()
    # a newer model, and a batch that is tried again: same version, same rows, no call
    store_model(model(spark, 2, swap=True), models)
    one = [d for d in docs[:5]] if spark.read.parquet(os.path.join(sink, "records", "batch_id=0")).where("filename = 'f0'").count() else docs[5:]
    label_batch(spark.createDataFrame(one, schema), 0, sink, models, fn, "filename", "text", calls)
    assert sorted(map(str, labelled_records(spark, sink).collect())) == first and fn.calls() == spent
    # new files only, by the new model
    spark.createDataFrame([("new", "cats dogs cats dogs cats")], schema).coalesce(1).write.mode("append").parquet(source)
    run()
    after = labelled_records(spark, sink).collect()
    assert len(after) == 10 and {r["filename"]: r["model_version"] for r in after}["new"] == 2
