"""Python tasks hold a bounded number of pages and answers, whatever a file or an Arrow batch holds."""

import pyarrow as pa

import lectern.operators.inference as inference
import lectern.sources.records as records


def test_pages_leave_the_task_before_the_file_is_decoded(spark):
    def decoder(content):
        def pages():
            for i in range(int(content)):
                yield f"page {i}"
            if content == b"7":
                raise ValueError("broken at its end")
        return pages()

    files = spark.createDataFrame([("a", b"1000"), ("b", b"7"), ("c", b"0"), ("d", b"no number"), ("e", None)], "filename string, content binary")
    got = sorted(map(tuple, records.decode_pages(files, decoder).collect()))
    assert got == sorted([("a", i, f"page {i}") for i in range(1000)] + [(f, 0, "") for f in "bcde"])


def test_answers_leave_the_task_in_slices(spark, monkeypatch):
    prompts = spark.range(5000).selectExpr("id", "concat('p', id) AS prompt")
    monkeypatch.setattr(type(prompts), "mapInArrow", lambda self, run, schema: run)
    run = inference.infer(prompts, "prompt", lambda p: p + "!", ["id"], pause=0.0)
    batch = pa.RecordBatch.from_pydict({"id": list(range(5000)), "prompt": [f"p{i}" for i in range(5000)]})
    sizes = [b.num_rows for b in run(iter([batch]))]
    assert sum(sizes) == 5000 and max(sizes) <= inference.SLICE_ROWS


def test_answers_are_whole(spark):
    prompts = spark.range(3000).selectExpr("id", "if(id % 10 = 0, null, concat('p', id)) AS prompt")
    got = {r["id"]: (r["response"], r["error"], r["attempts"]) for r in inference.infer(prompts, "prompt", lambda p: p + "!", ["id"], pause=0.0).collect()}
    assert got == {i: (None, "no prompt", 0) if i % 10 == 0 else (f"p{i}!", None, 1) for i in range(3000)}
