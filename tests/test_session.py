import os

from pyspark.sql import functions as F

from lectern.operators.joins import join_small
from lectern.session import cut_lineage, scratch_dir, spread
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_only_when_under_split(spark):
    slots = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000).coalesce(1)
    spread_one = spread(one, "id")
    assert spread_one.rdd.getNumPartitions() == slots
    assert sorted(r.id for r in spread_one.collect()) == list(range(1000))
    many = spark.range(0, 1000, numPartitions=slots * 2)
    assert spread(many, "id") is many  # already split: no shuffle added


def test_cut_lineage_is_a_written_table(spark):
    df = spark.range(0, 500).withColumn("x", F.col("id") * 3)
    cut = cut_lineage(df, "t")
    plan = _plan(cut)
    assert "FileScan parquet" in plan
    folder = scratch_dir(spark).rstrip("/").split("/")[-1]
    assert cut.inputFiles() and all(f"/{folder}/t-" in f for f in cut.inputFiles())
    assert "Range" not in plan  # the upstream plan is gone
    assert sorted((r.id, r.x) for r in cut.collect()) == [(i, 3 * i) for i in range(500)]


def test_join_small_broadcasts_only_what_it_measured(spark):
    big = spark.range(0, 1000).withColumn("k", F.col("id") % 5)
    small = spark.range(0, 5).withColumnRenamed("id", "k").withColumn("name", F.concat(F.lit("c"), F.col("k")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = join_small(big, small, "k")
        assert "BroadcastHashJoin" in _plan(hinted) and "hashpartitioning" not in _plan(hinted)
        assert hinted.count() == 1000
        too_big = join_small(big, small, "k", limit_bytes=10)
        assert "SortMergeJoin" in _plan(too_big) and too_big.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_clusters_are_not_shuffled(spark):
    """With automatic broadcasts off, the rows themselves never move on the cluster key."""
    from lectern.operators import profile, vectors

    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hashpartitioning(label" not in _plan(vectors.centroid_similarity(emb, "label", "embedding"))
        desc = emb.groupBy("label").agg(F.max(F.lit("d")).alias("description"))
        assert "hashpartitioning(label" not in _plan(profile.attach_description(emb, desc, "label"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_does_not_run_its_input(spark):
    acc = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b

    df = spark.range(0, 100).repartition(2, "id").mapInArrow(count, "id long")
    spread(df, "id")
    assert acc.value == 0


def test_scratch_must_be_shared_on_a_cluster(spark):
    from types import SimpleNamespace

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077", getConf=lambda: {})
    import pytest

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(SimpleNamespace(sparkContext=sc, conf={}))


def test_extraction_calls_each_request_once(spark):
    from lectern.operators.inference import RecordModel
    from lectern.plans.extract import extract_records

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("filename"), "text")
    acc = spark.sparkContext.accumulator(0)
    model = RecordModel(fail_every=0)

    def counted(prompt):
        acc.add(1)
        return model(prompt)

    recs = extract_records(docs, counted, "filename", multiplier=0.0, cap=0.0, pause=0.0)
    n = recs.count()
    recs.select("summary").collect()  # a second action must not call the model for stored answers
    n_docs = docs.where(F.length("text") > 0).count()
    n_chunks = docs.select(F.sum(F.ceil(F.length("text") / 15000))).first()[0]
    assert n == n_docs
    # head, chunks and summaries are each asked for once
    assert acc.value == n_docs + n_chunks + n_docs


def test_failed_documents_stop_there(spark):
    """No request follows a failed head; a failed summary leaves no citation."""
    from lectern.plans.extract import extract_records

    asked = spark.sparkContext.accumulator(0)

    def model(prompt):
        asked.add(1)
        if "bad head" in prompt or ("summarise" in prompt and "bad summary" in prompt):
            raise RuntimeError("down")
        if prompt.startswith("From the start"):
            return '{"Paper Title": "T", "Authors": "A, B", "Year of Publication": "2001"}'
        if prompt.startswith("From this part"):
            return '{"Limitations": "bad summary"}' if "sour" in prompt else '{"Limitations": "few"}'
        return "S"

    docs = spark.createDataFrame([("a", "bad head"), ("b", "sour"), ("c", "fine")], "filename string, text string")
    got = {r.filename: r for r in extract_records(docs, model, "filename", retries=1, multiplier=0.0, cap=0.0, pause=0.0).collect()}
    assert asked.value == 1 + 3 + 3
    a, b, c = (got[k] for k in "abc")
    assert (a.title, a.limitations, a.summary, a.citation, a.extraction_status, a.error_message) == (None, None, None, None, "error", "RuntimeError: down")
    assert (b.title, b.limitations, b.summary, b.citation, b.extraction_status) == ("T", "bad summary", None, None, "error")
    assert (c.summary, c.extraction_status, c.error_message) == ("S", "success", None) and c.citation.startswith('A, B, "T", ')


def test_scratch_tables_of_a_scope_are_deleted_with_it(spark):
    from lectern.session import scratch_scope

    outside = cut_lineage(spark.range(3), "outside")
    with scratch_scope(spark):
        inside = cut_lineage(spark.range(4), "inside")
        kept = inside.count()
        files = inside.inputFiles()
    assert kept == 4 and files and not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in files)
    assert outside.count() == 3


def test_pages_of_many_batches_are_merged(spark, tmp_dir):
    from lectern.streaming.ingest import incremental_documents, latest_documents, merge_pages, page_generation

    source, sink, log = (os.path.join(tmp_dir, x) for x in ("in", "sink", "log"))
    schema = spark.createDataFrame([], "d long, p long, t string").schema
    want = {}
    for b in range(9):
        rows = [(d, b * 10 + k, f"{d}.{b}.{k} ") for d in (b % 3, 7) for k in range(2)]
        for d, _, t in rows:
            want[d] = want.get(d, "") + t
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        if b % 2 == 0 or b == 8:
            incremental_documents(spark, source, schema, sink, log, "d", "p", "t", buckets=4, max_files_per_trigger=1, merge_after=3)
            got = {r["d"]: r["text"] for r in latest_documents(spark, sink, "d").collect()}
            assert got == {d: t.strip() for d, t in want.items()}
    assert page_generation(spark, sink) >= 3
    folders = os.listdir(os.path.join(sink, "pages"))
    assert len([f for f in folders if f.startswith("batch_id=")]) <= 4
    assert len([f for f in os.listdir(sink) if f.startswith("pages-upto-")]) == 1
    # merged once more by hand, the same again
    merge_pages(spark, sink, 9)
    merge_pages(spark, sink, 9)
    assert page_generation(spark, sink) == 8
    spark.createDataFrame([(7, 1000, "end")], schema).coalesce(1).write.mode("append").parquet(source)
    incremental_documents(spark, source, schema, sink, log, "d", "p", "t", buckets=4, merge_after=3)
    assert {r["d"]: r["text"] for r in latest_documents(spark, sink, "d").collect()}[7] == want[7] + "end"
