"""A clustered table as CSV: a description is stored once for its cluster and read back on every record."""

import os

from pyspark.sql import functions as F

from lectern.sources.records import from_display, read_clustered, write_clustered


def test_descriptions_are_written_once_and_read_on_every_record(spark, tmp_dir):
    texts = {0: 'Cluster with 40 papers, "quoted"\nand ' + "long " * 4000, 1: "Cluster with 20 papers " + "more " * 4000}
    rows = [(f"f{i}", f"title {i}" if i % 7 else None, i // 40, texts[i // 40]) for i in range(60)] + [("none", "t", None, None)]
    table = spark.createDataFrame(rows, "filename string, title string, cluster int, cluster_description string")
    descriptions = spark.createDataFrame(list(texts.items()), "cluster int, cluster_description string")
    write_clustered(table, descriptions, f"{tmp_dir}/t", ["title"])
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{tmp_dir}/t") for f in fs)
    assert size < 2 * sum(map(len, texts.values()))
    back = from_display(read_clustered(spark, f"{tmp_dir}/t"))
    assert back.columns == table.columns
    got = {r["filename"]: (r["cluster"], r["cluster_description"]) for r in back.collect()}
    assert got == {f: (None if c is None else str(c), d) for f, _, c, d in rows}


def test_build_table_keeps_its_disk_in_proportion(spark, tmp_dir):
    import __spark_entry__
    from lectern.session import scratch_dir

    docs = spark.range(120).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.concat(F.lit("method" * 200), F.col("id").cast("string")), F.lit("b c d e f g"), F.md5(F.col("id").cast("string"))).alias("text"))
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    at = scratch_dir(spark).removeprefix("file:")
    before = set(os.listdir(at))
    rows = __spark_entry__.queries()["build_table"](spark, tmp_dir).collect()
    assert sum(r["n"] for r in rows) == sum(r["n_described"] for r in rows) == sum(r["n_cluster"] for r in rows) == 120
    assert all(r["n_misplaced"] == 0 for r in rows)
    table = [os.path.join(d, f) for x in set(os.listdir(at)) - before if x.startswith("table-") for d, _, fs in os.walk(os.path.join(at, x)) for f in fs]
    # 120 methods of 1,200 characters are in the records once, and in the descriptions once
    assert table and sum(map(os.path.getsize, table)) < 1_000_000
