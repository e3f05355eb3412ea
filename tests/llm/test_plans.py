"""Plans and wiring of the registered operator queries."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lectern.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_query_per_operator():
    assert [re.match(r"op(\d+)_", q)[1] for q in QUERIES] == [str(i) for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text
    native = name.split("_")[0] in ("op1", "op2", "op7", "op8", "op10")
    if native:
        assert not re.search("Arrow|Pandas|Python", text), name
