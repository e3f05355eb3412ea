from __future__ import annotations

import os
import random

import pytest

from lectern.sources.csv_split import block_starts, csv_lines
from lectern.sources.records import read_records, write_records


def cell(rng: random.Random) -> str | None:
    kind = rng.randrange(9)
    if kind == 0:
        return None
    words = ["plain", "with, comma", 'a "quoted" word', "line\nbreak", "two\n\nbreaks", '"', '""', "\n", '\n"\n', "é 😀", " outer ", "cr\r\nlf", ",", "'"]
    return " ".join(rng.choice(words) for _ in range(rng.randrange(1, 6)))


@pytest.fixture()
def small_ranges(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("size", [64, 331, 5000, 1 << 20])
def test_the_same_as_one_task_reading_all(spark, tmp_dir, small_ranges, size):
    rng = random.Random(size)
    data = [(f"k{i}", cell(rng), cell(rng), cell(rng)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, a string, b string, c string")
    write_records(df.coalesce(1), tmp_dir)
    small_ranges(1 << 30)
    want = rows(read_records(spark, tmp_dir))
    assert len(want) == 400
    small_ranges(size)
    assert rows(read_records(spark, tmp_dir, split=True)) == want
    lines = csv_lines(spark, tmp_dir)
    ranges = lines.select("file", "block").distinct().count()
    assert ranges >= min(40, sum(os.path.getsize(os.path.join(tmp_dir, f)) for f in os.listdir(tmp_dir) if f.endswith("csv")) // size // 3)
    starts = block_starts(lines).collect()
    assert len(starts) == ranges and (size > 331 or {r["inside"] for r in starts} == {0, 1})


def test_several_files_headers_blank_lines_and_carriage_returns(spark, tmp_dir, small_ranges):
    with open(os.path.join(tmp_dir, "one.csv"), "w", newline="") as f:
        f.write('k,"a ""x"""\r\n1,"two\r\nlines"\r\n\r\n2,plain\r\n')
    with open(os.path.join(tmp_dir, "two.csv"), "w", newline="") as f:
        f.write('k,"a ""x"""\n3,"""q"", and\nmore"\n\n4,')
    small_ranges(7)
    out = read_records(spark, tmp_dir, split=True)
    assert out.columns == ["k", 'a "x"']
    assert sorted(tuple(r) for r in out.collect()) == [("1", "two\r\nlines"), ("2", "plain"), ("3", '"q", and\nmore'), ("4", None)]


def test_rows_with_another_number_of_cells_are_an_error(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "x.csv"), "w") as f:
        f.write("k,a\n1,2\n3,4,5\n")
    with pytest.raises(Exception):
        read_records(spark, tmp_dir, split=True).collect()


def test_schema_by_name_and_header_only(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x\ny")], "n long, t string")
    write_records(df.select("t", "n"), tmp_dir)
    assert [tuple(r) for r in read_records(spark, tmp_dir, df.schema, split=True).collect()] == [(1, "x\ny")]
    empty = os.path.join(tmp_dir, "sub")
    os.makedirs(empty)
    with open(os.path.join(empty, "x.csv"), "w") as f:
        f.write("k,a\n")
    assert read_records(spark, empty, split=True).collect() == []
