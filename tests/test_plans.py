import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from lectern.plans.queries import QUERIES
from lectern.operators.inference import RecordModel
from lectern.plans.corpus import cluster_table, review
from lectern.plans.extract import extract_records
from lectern.sources.records import REQUIRED_FIELDS, write_report
from tests.conftest import SF_MID, SF_SMALL


def _records(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("filename"), "text")
    return extract_records(docs, RecordModel(), "filename", multiplier=0.0, cap=0.0, pause=0.0)


def test_extract_records_statuses_and_aliases(spark):
    recs = _records(spark).cache()
    n_docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert recs.count() == n_docs
    st = {r.extraction_status: r["count"] for r in recs.groupBy("extraction_status").count().collect()}
    assert set(st) <= {"success", "error"} and st.get("success", 0) > 0
    ok = recs.where("extraction_status = 'success'")
    # detail fields answered under display names land in their columns (no dropped keys)
    assert ok.where(F.col("method").isNotNull()).count() > 0
    assert ok.where(F.col("datasets").isNotNull()).count() > 0
    # list answers are rendered as text, never as JSON
    assert ok.where(F.col("datasets").startswith("[")).count() == 0
    # errors carry a message; successes do not
    assert recs.where("extraction_status = 'error' AND error_message IS NULL").count() == 0
    assert ok.where(F.col("error_message").isNotNull()).count() == 0
    # citation present only when title, authors and year are present
    bad = recs.where(F.col("citation").isNotNull() & (F.col("authors").isNull() | F.col("title").isNull()))
    assert bad.count() == 0


def test_cluster_table_and_review(spark, tmp_dir):
    recs = _records(spark)
    for c in REQUIRED_FIELDS:
        if c not in recs.columns:
            recs = recs.withColumn(c, F.lit(None).cast("string"))
    out = cluster_table(recs, k=4, restarts=2)
    rows = out.records.select("row_id", "cluster", "cluster_description").collect()
    assert len(rows) == recs.count()
    assert all(r.cluster_description.startswith("Cluster with ") for r in rows)
    prof = out.profile.collect()
    assert sum(r["size"] for r in prof) == len(rows)
    assert all(len(r.representative_papers) <= 3 for r in prof)
    lines = review(out.records, lambda p: "Narrative.", "Intro text", "Closing text", batch_rows=5, fan_in=2,
                   pause=0.0)
    path = os.path.join(tmp_dir, "review")
    write_report(lines, path, partitions=4)
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    text = "".join(open(os.path.join(path, p)).read() for p in parts)
    assert text.startswith("# ")
    assert text.index("Intro text") < text.index("## Cluster") < text.index("Closing text") < text.index("## References")


def test_descriptions_are_stored_once_for_a_cluster(spark, monkeypatch):
    from lectern.plans import corpus

    written = {}
    cut = corpus.cut_lineage
    monkeypatch.setattr(corpus, "cut_lineage", lambda df, name="cut": written.setdefault(name, cut(df, name)))
    rows = [(i, f"title{i} {'red' if i % 3 else 'blue'}", f"method{i}" + "x" * 200) for i in range(300)]
    recs = spark.createDataFrame(rows, "row_id long, title string, method string")
    for c in REQUIRED_FIELDS:
        if c not in recs.columns:
            recs = recs.withColumn(c, F.lit(None).cast("string"))
    out = cluster_table(recs, k=2, restarts=1)
    # a description has every method of its cluster: with each record it would grow with the square of the records
    assert not {"description", "cluster_description"} & set(written["clustered"].columns)
    assert written["clustered"].count() == len(rows)
    assert written["descriptions"].count() == out.profile.count() == 2
    # the records have their clusters' descriptions all the same
    said = {r["cluster"]: (r["size"], r["description"]) for r in out.profile.collect()}
    got = out.records.collect()
    assert sorted(r["row_id"] for r in got) == list(range(300))
    assert all(r["cluster_description"] == said[r["cluster"]][1] for r in got)
    for c, (size, text) in said.items():
        mine = sorted(r["method"] for r in got if r["cluster"] == c)
        assert len(mine) == size and text.startswith(f"Cluster with {size} papers focusing on {', '.join(mine)}. Key papers: ")


def test_cluster_table_fallback_label(spark):
    recs = _records(spark)
    for c in REQUIRED_FIELDS:
        if c not in recs.columns:
            recs = recs.withColumn(c, F.lit(None).cast("string"))

    def broken(df, col, ids):
        raise RuntimeError("no model")

    out = cluster_table(recs, embedder=broken, on_error="label")
    vals = out.records.select("cluster", "cluster_description").distinct().collect()
    assert [(r.cluster, r.cluster_description) for r in vals] == [(0, "Clustering failed")]
    (row,) = out.profile.collect()
    assert row.size == out.records.count() and row.description == "Clustering failed: no model"
    good = cluster_table(recs, restarts=1).profile
    assert out.profile.columns == good.columns


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cartesian_product(spark):
    qs = entry.queries()
    for name in ["cosine_pairs", "top_neighbors", "assign_nearest", "representatives", "format_citation",
                 "attach_description", "cluster_description", "merge_fields"]:
        plan = _plan(qs[name](spark, SF_MID))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scans_prune_columns(spark):
    plan = entry.queries()["drop_empty"](spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,n_chars:bigint>" in plan
    plan = entry.queries()["cluster_slice"](spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,3)]" in plan


# Queries whose work is a user function (model, similarity kernel) and may run Python stages.
PYTHON_STAGES = {"infer_stub", "extract_records", "durable_answers", "decode_pages", "cosine_pairs", "top_neighbors", "indexed_neighbors", "cluster_narrative"}
# Queries with a single-partition step: ordering k + 2 report sections, totals of partial sums.
SINGLE_PARTITION = {"report_sections", "cluster_analysis", "decode_pages"}


def test_every_registered_plan(spark):
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name  # never a row-at-a-time Python UDF
        if name not in PYTHON_STAGES:
            assert "InPandas" not in plan and "ArrowEvalPython" not in plan, name
        if name not in SINGLE_PARTITION:
            assert "SinglePartition" not in plan, name
