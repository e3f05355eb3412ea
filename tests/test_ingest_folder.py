"""The conversations table is ingested whole, be it one file or a folder of files."""

import os

from lectern.streaming.ingest import incremental_assemble

ROWS = [(c, t, "user", f"c{c}t{t}") for c in range(5) for t in range(3)]


def _docs(spark, sf):
    return sorted(map(tuple, incremental_assemble(spark, sf).select("conv_id", "text").collect()))


def test_folder_of_files_and_single_file_give_the_same_documents(spark, tmp_dir):
    rows = spark.createDataFrame(ROWS, "conv_id long, turn int, role string, text string")
    many, one = os.path.join(tmp_dir, "many"), os.path.join(tmp_dir, "one")
    rows.repartition(3).write.parquet(os.path.join(many, "conversations.parquet"))
    os.makedirs(one)
    rows.toPandas().to_parquet(os.path.join(one, "conversations.parquet"), index=False)
    got = _docs(spark, many)
    assert [c for c, _ in got] == list(range(5))
    assert all(f"c{c}t{t}" in text for c, text in got for t in range(3))
    assert got == _docs(spark, one)
